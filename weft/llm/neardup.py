"""Near-duplicate classes by ProbMinHash, banding and exact verification (operator 5).

Texts are multisets of five-word shingles (a shorter text is one shingle). Each shingle sends
exponential arrivals to registers, without replacement and in increasing order, at a rate equal to
its count; it stops as soon as its next arrival is later than every register of the text. A register
keeps the shingle that came first, so two texts agree in a register with probability equal to the
probability Jaccard similarity of their weighted shingles. Bands of registers give buckets. A text that
repeats a shingle has a second set of bands with all counts 1, where registers agree with the probability
of the set Jaccard similarity; without repeats both sets are the same, so they share their buckets.

Equal texts are one vertex. In each bucket the most central member (the one whose buckets hold most
vertices) meets all others; a pair is a link if the exact Jaccard similarity of the shingle sets is
0.8 or more. Whatever a bucket still holds in different components is settled exactly by prefix
filtering: with shingles ordered rare first, linked sets share one within their first
n - ceil(0.8 n) + 1, at positions that leave enough overlap. No group is enumerated in pairs and
no link between vertices of one bucket is lost. Classes are connected components; the id of a class
is its smallest doc_id.

Cases: null texts are classes of their own; equal texts, empty ones included, share a class; rows
that share an id share a class; a null id has class null unless its text has another id, and texts without
any id meet only equal ones; ties go to the smaller id; other columns are not read. Text identity is a
128-bit hash, shingle identity 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import OWN, bounded_batches, stored
from weft.llm.textbatch import Texts, U, lean, mix, slices, windows
from weft.operators import prefix as shared_tokens
from weft.operators.graph import components

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 24, 4
#: A prime above BANDS * ROWS, so that affine steps visit every register once.
REGISTERS = 97
_GOLD = U(0x9E3779B97F4A7C15)


def shingles(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, count, text; ordered by text."""
    _, _, first = t.words
    owner, words = t.owner(first), np.diff(first)
    keys, at = windows(t.word_hash, first, WORDS)
    text = owner[at]
    short = np.flatnonzero((words > 0) & (words < WORDS))
    if len(short):
        extra = [windows(t.word_hash[first[k] : first[k + 1]], np.array([0, words[k]]), int(words[k]))[0] for k in short]
        keys, text = np.concatenate([keys, *extra]), np.concatenate([text, short])
    order = np.argsort(mix(keys + text.astype(U) * _GOLD))
    keys, text = keys[order], text[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, len(keys)))
    keys, text = keys[at], text[at]
    order = np.argsort(text, kind="stable")
    return keys[order], count[order], text[order]


def signatures(keys: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The winning shingle of each register (n x REGISTERS); 0 for texts without shingles."""
    first = np.full(n * REGISTERS, np.inf)
    winner = np.zeros(n * REGISTERS, U)
    seed = mix(keys ^ U(0x5851F42D4C957F2D))
    start = (seed % U(REGISTERS)).astype(np.int64)
    step = ((seed >> U(32)) % U(REGISTERS - 1)).astype(np.int64) + 1
    time = np.zeros(len(keys))
    limit = np.full(n, np.inf)
    for i in range(REGISTERS):
        u = mix(seed + np.array([i + 1], U) * _GOLD)
        gap = -np.log(((u >> U(11)).astype(np.float64) + 0.5) * 2.0**-53)
        time = time + gap / weight * (REGISTERS / (REGISTERS - i))
        live = np.flatnonzero(time < limit[text])
        if not len(live):
            break
        keys, weight, text, seed, start, step, time = (x[live] for x in (keys, weight, text, seed, start, step, time))
        slot = text * REGISTERS + (start + i * step) % REGISTERS
        np.minimum.at(first, slot, time)
        hit = first[slot] == time
        winner[slot[hit]] = keys[hit]
        limit = first.reshape(n, REGISTERS).max(1)
    return winner.reshape(n, REGISTERS)


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each band (n x BANDS)."""
    rows = signature[:, : BANDS * ROWS].reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U) * _GOLD, rows.shape[:2]).copy()
    for k in range(ROWS):
        out = mix(out ^ rows[:, :, k]) + _GOLD
    return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values))


def identity() -> list[Column]:
    """Two hashes of a text; null texts differ by id."""
    lone = F.col("text").isNull()
    return [F.when(lone, F.xxhash64(F.lit(3), F.col("doc_id").cast("long"))).otherwise(F.xxhash64("text")), F.when(lone, F.xxhash64(F.lit(5), F.col("doc_id").cast("long"))).otherwise(F.xxhash64(F.lit(7), F.col("text")))]


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text identity (k1, k2) and bucket keys of every row."""
    k1, k2 = identity()
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", k1.alias("k1"), k2.alias("k2"))

    @lean
    def run(batches):
        for b in batches:
            keys, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, t in slices(b.column(1)):
                k, w, owner = shingles(t)
                some = np.bincount(owner, minlength=t.n) > 0
                again = np.bincount(owner, w > 1, t.n) > 0
                even = again[owner]
                both = np.concatenate([bands(signatures(k, w.astype(float), owner, t.n)), bands(signatures(k[even], np.ones(even.sum()), owner[even], t.n))], 1)
                held = np.repeat(np.stack([some, again], 1), BANDS, axis=1)
                keys.append(both[held].view(np.int64))
                sizes.append(held.sum(1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), _lists(np.concatenate(keys), np.concatenate(sizes))], ["doc_id", "k1", "k2", "bands"])

    return ids.mapInArrow(run, "doc_id long, k1 long, k2 long, bands array<long>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(v, s): the sorted distinct shingle hashes of each text, as bytes."""

    @lean
    def run(batches):
        for b in batches:
            sets = []
            for _, _, t in slices(b.column(1)):
                k, _, owner = shingles(t)
                cut = np.searchsorted(owner, np.arange(t.n + 1))
                sets += [np.sort(k[cut[i] : cut[i + 1]]).tobytes() for i in range(t.n)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["v", "s"])

    return texts.mapInArrow(run, "v long, s binary")


def verified(spark: SparkSession, pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Those of the distinct pairs (a, b) whose shingle sets have the Jaccard similarity or more."""

    @lean
    def run(batches):
        for b in batches:
            good = np.zeros(b.num_rows, bool)
            seen, mine = None, None
            for i, (a, x, y) in enumerate(zip(b.column(0).to_pylist(), b.column(2), b.column(3))):
                if a != seen:
                    seen, mine = a, np.frombuffer(x.as_buffer(), U)
                other = np.frombuffer(y.as_buffer(), U)
                at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                both = int((mine[at] == other).sum())
                good[i] = both >= similar * (len(mine) + len(other) - both)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(good))

    right = sets.select(F.col("v").alias("b"), F.col("s").alias("sb")).hint("merge")
    left = sets.select(F.col("v").alias("a"), F.col("s").alias("sa")).hint("merge")
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")
    return stored(spark, joined.mapInArrow(run, "a long, b long").distinct(), "links")


def _central_pairs(spark: SparkSession, members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most central one."""
    sizes = stored(spark, members.groupBy("key").agg(F.count("*").alias("n")), "sizes")
    score = stored(spark, members.join(sizes.hint("merge"), "key").groupBy("v").agg(F.sum("n").alias("score")), "scores")
    scored = stored(spark, members.join(score.hint("merge"), "v"), "scored")
    leaders = stored(spark, scored.groupBy("key").agg((-F.max(F.struct("score", (-F.col("v")).alias("m")))["m"]).alias("leader")), "leaders")
    return members.join(leaders.hint("merge"), "key").filter("v <> leader").select(F.col("leader").alias("a"), F.col("v").alias("b")).distinct()


def _rest_pairs(spark: SparkSession, members: DataFrame, labels: DataFrame, sets: DataFrame, similar: float) -> DataFrame | None:
    """Pairs that can be links among vertices whose bucket spans several components."""
    known = stored(spark, members.join(labels.hint("merge"), "v", "left").select("key", "v", F.coalesce("c", "v").alias("c")), "known")
    mixed = stored(spark, known.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key"), "mixed")
    rest = stored(spark, known.join(mixed.hint("merge"), "key").select("v", "c").distinct(), "rest")
    if not rest.limit(1).count():
        return None

    @lean
    def tokens(batches):
        for b in batches:
            sets_ = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column(1)]
            sizes = np.array([len(x) for x in sets_], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), sizes)), pa.array(np.concatenate([np.zeros(0, np.int64), *sets_]))], ["v", "t"])

    rows = stored(spark, sets.join(rest.select("v").hint("merge"), "v").select("v", "s").mapInArrow(tokens, "v long, t long"), "tokens")
    common = stored(spark, rows.groupBy("t").agg(F.count("*").alias("df")).filter("df > 1"), "common")
    # a shingle of one text only can't be shared: only how many precede the shared ones matters
    totals = rows.groupBy("v").agg(F.count("*").cast("long").alias("n"))
    shared = rows.join(common.hint("merge"), "t").groupBy("v").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("ts"))
    held = totals.join(shared.hint("merge"), "v").join(rest.hint("merge"), "v").withColumn("lone", F.col("n") - F.size("ts"))
    reach = F.col("n") - F.ceil(F.lit(similar) * F.col("n") - 1e-9) + 1 - F.col("lone")
    prefix = held.filter(reach > 0).select("v", "c", "n", "lone", F.posexplode(F.slice("ts", 1, reach.cast("int"))).alias("i", "x"))
    placed = prefix.select("v", "c", "n", (F.col("lone") + F.col("i")).alias("i"), F.col("x.t").alias("t"))
    placed = stored(spark, placed, "shared")
    return shared_tokens.pairs(spark, shared_tokens.counted(placed), similar)


def classified(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, text identity (k1, k2), class_id and n_links of every row."""
    bounded_batches(spark)
    rows = stored(spark, sketched(docs), "sketches")
    texts = stored(spark, rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("v"), F.first("bands").alias("bands")), "texts")
    buckets = texts.filter("v is not null").select("v", F.explode("bands").alias("key"))
    several = stored(spark, buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "buckets")
    members = stored(spark, buckets.join(several.hint("merge"), "key").distinct(), "members")
    wanted = stored(spark, members.select(F.col("v").alias("doc_id")).distinct(), "wanted")
    sets = stored(spark, shingle_sets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id", "left_semi")), "sets")
    links = verified(spark, _central_pairs(spark, members), sets, similar)
    labels = components(spark, links)
    rest = _rest_pairs(spark, members, labels, sets, similar)
    if rest is not None:
        more = verified(spark, rest, sets, similar)
        if more.limit(1).count():
            links = links.union(more)
            labels = components(spark, links)
    ends = links.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("n_links"))
    labels = labels.join(ends.hint("merge"), "v", "left")
    named = texts.select("k1", "k2", "v").join(labels.hint("merge"), "v", "left").select("k1", "k2", F.coalesce("c", "v").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    named = stored(spark, named, "classes")
    return rows.select("doc_id", "k1", "k2").join(named.hint("merge"), ["k1", "k2"])


def classes(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id and n_links of every row: to how many other texts its own has a verified link.

    The links hold each class together; they aren't all pairs of similar texts.
    """
    return classified(spark, docs, similar).select("doc_id", "class_id", "n_links")


def keep_one(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with exactly one row of each class: that of the smallest id, of several such that with the smaller text hash.

    Where the class is null, each text is a class: of rows without an id, one stays for each text that no
    row with an id has, and one of those without id and text.
    """
    k1, k2 = identity()
    of = [F.col("class_id"), *(F.when(F.col("class_id").isNull(), F.col(k)).alias(f"own_{k}") for k in ("k1", "k2"))]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2"))
    kept = classified(spark, docs, similar).groupBy(*of).agg(first.alias("x"))
    kept = stored(spark, kept.select(*(F.col(f"x.{c}").alias(OWN + c) for c in ("doc_id", "k1", "k2"))), "kept")
    rows = docs.withColumns({OWN + "h1": k1, OWN + "h2": k2})
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(OWN + "doc_id")) & (F.col(OWN + "h1") == F.col(OWN + "k1")) & (F.col(OWN + "h2") == F.col(OWN + "k2"))
    rows = rows.join(kept.hint("merge"), same, "left_semi")
    return rows.dropDuplicates(["doc_id", OWN + "h1", OWN + "h2"]).select(*docs.columns)
