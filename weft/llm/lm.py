"""Language-model scoring by prediction by partial matching over bytes (operator 7).

Texts are lower-cased (A-Z) bytes and one end symbol. Training counts every (context, symbol) of the
longest order in all training texts; shorter orders are its marginals, so the levels of the context
trie nest. The probability of a symbol seen n times among T in the longest known context is
(n - 1/2) / T; else the escape estimate (half the distinct symbols over T) times its probability in
the next shorter context, where symbols of the longer one are excluded; below all contexts, unseen
symbols are equal. The model is pretrained: scoring a text doesn't change it.

The model keeps every count of the corpus and is never on one machine. One scan makes groups of
neighbouring rows, about GROUP_BYTES of text: the compressed texts as one row, and the group's distinct
(context, symbol) codes, dealt into shards by the last BASE symbols of the context. All levels from BASE
up that a code needs lie in its shard, the shorter ones (at most 257 ** BASE nodes) are broadcast, so a
shard builds its part of the trie and rates the codes of all groups exactly as the whole trie would. Only
the logs go back, in the order of the codes, and meet the texts of their group, which add them up. A shard
holds a code of its contexts at most once for each group, however often texts repeat it. A shard of more than
SLICE_GROUPS groups is rated by several tasks, each of some groups beside the sums of all, which a tree adds up.

The word unigram beside it is exact: the most frequent words are looked up in a bounded table,
all others are joined with the stored counts of all training words.

Cases: a null or empty text is one end symbol (one token); a null id is in no fold and is learnt
from; repeated rows count and are scored each; without training rows the model is uniform; only doc_id
and text are read. Words are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import bounded_batches, fold, stored
from weft.llm.textbatch import Texts, U, lean, mix, slices, strings, tight_heap, trim

ORDER = 5
END, PAD, SYMBOLS = 256, 257, 257
BITS = 9
#: Levels below this one are broadcast; the last BASE symbols of a context choose its shard.
BASE = 3
#: Neighbouring rows of so many bytes are a group (a longer text is one alone); a shard is made for so many bytes of text.
GROUP_BYTES = 12 << 20
SHARD_BYTES = 4 << 20
#: What the rows of a group hold beside its shards: texts, counts of the longest level that is broadcast, counts of words.
TEXTS, LEVEL, WORD_COUNTS = -3, -1, -2
MOST_TASKS = 20_000
#: Groups of a shard that one task rates (3 GB of text), and tables of counts that one task adds up.
SLICE_GROUPS, FAN = 256, 32
#: The compressed texts of a group are rows of so many bytes.
PIECE_BYTES = 1 << 20
#: Pages and row groups for large values: a page is looked at after every value.
PAGES = {"parquet__page__size__row__check__min": "1", "parquet__page__size__check__estimate": "false", "parquet__block__size": str(16 << 20)}
#: Counts of slices that are held before they are added up.
HELD_CODES = 500_000
MOST_WORDS = 262_144
#: The end token's hash; the hash of a word is never made for an empty span.
END_WORD = 1


def grams(t: Texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of each symbol with its ``order`` predecessors, and the first code of each text."""
    size = np.diff(t.offs)
    begin = np.append(0, np.cumsum(size + order + 1))
    total = int(begin[-1])
    symbols = np.full(total + order, PAD, np.int64)
    text = np.repeat(np.arange(t.n), size)
    symbols[np.arange(len(t.data)) + text * (order + 1) + order] = t.data
    symbols[begin[1:] - 1] = END
    code = symbols[order:total].copy() if total else np.zeros(0, np.int64)
    for j in range(1, order + 1):
        code |= symbols[order - j : total - j] << (BITS * j)
    predicted = np.ones(total - order if total else 0, bool)
    # the places of pads between texts predict nothing
    for j in range(order):
        pads = begin[1:-1] + j - order
        predicted[pads[(pads >= 0) & (pads < len(predicted))]] = False
    first = np.append(0, np.cumsum(size + 1))[:-1]
    return code[predicted], first


def _tally(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    code, unique = pd.factorize(keys)
    return unique, np.bincount(code, n, len(unique)).astype(np.int64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, unique = pd.factorize(keys)
    return unique, np.bincount(code, minlength=len(unique))


def bounded_threshold(counts: DataFrame, most: int) -> int:
    """The smallest power of two so that at most ``most`` rows have so large an n."""
    sizes = {int(r[0]): r[1] for r in counts.groupBy(F.floor(F.log2(F.col("n") + 0.5)).alias("p")).count().collect()}
    t, left = 0, sum(sizes.values())
    while left > most:
        left -= sizes.get(t, 0)
        t += 1
    return 1 << t


class Level:
    """The nodes of one order: sorted codes of (context, symbol), and their contexts."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.n = codes[order], n[order]
        context = self.codes >> BITS
        self.contexts, at = np.unique(context, return_index=True)
        self.at = np.append(at, len(context))
        self.at = self.at.astype(np.int32)
        self.total = np.add.reduceat(self.n, at) if len(at) else np.zeros(0, np.int64)
        self.distinct = np.diff(self.at)
        self.below = np.zeros(len(self.contexts), np.int64)

    def link(self, lower: "Level", keep_bits: int) -> None:
        """How often the symbols of each context occur in the next shorter context."""
        spot = np.searchsorted(lower.codes, self.codes & ((1 << keep_bits) - 1))
        self.below = np.add.reduceat(lower.n[spot], self.at[:-1]) if len(self.contexts) else self.below


class Trie:
    def __init__(self, levels: list[Level]):
        """``levels`` from order 0 up."""
        self.levels = levels
        for k in range(1, len(levels)):
            levels[k].link(levels[k - 1], BITS * k)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each code after the others."""
        out = np.zeros(len(codes))
        seen_n, seen_d = np.zeros(len(codes)), np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            if not len(open_) or not len(level.codes):
                continue
            code = codes[open_] & ((1 << (BITS * (k + 1))) - 1)
            ctx = np.minimum(np.searchsorted(level.contexts, code >> BITS), len(level.contexts) - 1)
            known = level.contexts[ctx] == code >> BITS
            node = np.minimum(np.searchsorted(level.codes, code), len(level.codes) - 1)
            hit = level.codes[node] == code
            rest_n, rest_d = level.total[ctx] - seen_n[open_], level.distinct[ctx] - seen_d[open_]
            with np.errstate(divide="ignore", invalid="ignore"):
                out[open_[hit]] += np.log10((level.n[node[hit]] - 0.5) / rest_n[hit])
                escape = known & ~hit & (rest_d > 0)
                out[open_[escape]] += np.log10(0.5 * rest_d[escape] / rest_n[escape])
            seen_n[open_], seen_d[open_] = np.where(known, level.below[ctx], 0), np.where(known, level.distinct[ctx], 0)
            open_ = open_[~hit]
        if len(open_):
            base = self.levels[0].distinct[0] if len(self.levels[0].codes) else 0
            out[open_] -= np.log10(SYMBOLS - base)
        return out


def marginals(codes: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of ``order`` (that of the symbol and so many predecessors) with their summed counts."""
    low = codes & ((1 << (BITS * (order + 1))) - 1)
    sort = np.argsort(low)
    low, n = low[sort], n[sort]
    at = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, int)
    return low[at], np.add.reduceat(n, at) if len(at) else n


def _zipped(numbers: np.ndarray) -> bytes:
    return len(numbers).to_bytes(8, "little") + pa.compress(pa.py_buffer(np.ascontiguousarray(numbers, np.int64)), "zstd", asbytes=True)


def _unzipped(value: pa.Scalar) -> np.ndarray:
    data = value.as_buffer()
    size = 8 * int.from_bytes(data[:8].to_pybytes(), "little")
    return np.frombuffer(pa.decompress(data[8:], size, "zstd"), np.int64) if size else np.zeros(0, np.int64)


def _packed(codes: np.ndarray) -> bytes:
    return _zipped(np.diff(codes, prepend=np.int64(0)))


def _unpacked(value: pa.Scalar) -> np.ndarray:
    return np.cumsum(_unzipped(value))


def _by_shard(codes: np.ndarray, base: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each of the distinct ``codes``, and the order of the codes by shard and value."""
    shard = (mix(((codes >> BITS) & ((1 << (BITS * base)) - 1)).view(U)) % U(shards)).astype(np.int64)
    return shard, np.lexsort((codes, shard))


class Group:
    """Texts gathered until they are enough for a group."""

    def __init__(self, order: int, shards: int):
        self.order, self.shards = order, shards
        self.learnt, self.ids, self.sizes, self.data, self.held = [], [], [], [], 0

    def add(self, ids: pa.Array, learnt: np.ndarray, column: pa.Array) -> None:
        data, offs = strings(column)
        self.ids.append(ids)
        self.learnt.append(learnt)
        self.sizes.append(np.diff(offs))
        self.data.append(data.copy())
        self.held += len(data) + len(ids)

    def rows(self, group: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Rows (group, shard, codes, n, part, size, sizes, ids): the texts in shard TEXTS, then counts, packed."""
        names = ["group", "shard", "codes", "n", "part", "size", "sizes", "ids"]

        def batch(out: list[tuple], size: list, sizes: list, ids: pa.Array) -> pa.RecordBatch:
            columns = [pa.array([group] * len(out), pa.int64()), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary()), pa.array(np.arange(len(out)))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(size, pa.int64()), pa.array(sizes, pa.list_(pa.int64())), ids], names)

        data, sizes, learnt, base = np.concatenate(self.data), np.concatenate(self.sizes), np.concatenate(self.learnt), min(BASE, self.order)
        self.data = []
        blob = pa.compress(pa.py_buffer(data), "zstd", asbytes=True)
        pieces = [(TEXTS, blob[i : i + PIECE_BYTES], None) for i in range(0, len(blob), PIECE_BYTES)]
        none = [None] * (len(pieces) - 1)
        one = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(self.ids))
        yield batch(pieces, [len(data), *none], [sizes, *none], pa.concat_arrays([one, pa.nulls(len(none), pa.list_(kind))]))
        del blob, pieces
        parts, words, held = [], [], 0
        for row, to, t in slices(_column(data, sizes)):
            t, mine = t.lowered(), learnt[row:to]
            code, unique = pd.factorize(grams(t, self.order)[0])
            weight = np.repeat(mine, np.diff(t.offs) + 1).astype(float)
            parts.append((unique, np.bincount(code, weight, len(unique)).astype(np.int64)))
            if mine.any():
                words.append(_counted(t.word_hash.view(np.int64)[mine[t.owner(t.words[2])]]))
            held += len(unique)
            if held > HELD_CODES:
                parts, words, held = [_tally(parts)], [_tally(words)] if words else [], 0
        del data
        codes, n = _tally(parts)
        del parts
        shard, order = _by_shard(codes, base, self.shards)
        codes, n, shard = codes[order], n[order], shard[order]
        cut = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
        out = [(int(shard[a]), _packed(codes[a:z]), _zipped(n[a:z])) for a, z in zip(cut[:-1], cut[1:])]
        seen = n > 0
        if base and seen.any():
            low, m = marginals(codes[seen], n[seen], base - 1)
            out.append((LEVEL, _packed(low), _zipped(m)))
        if words:
            keys, m = _tally(words)
            out.append((WORD_COUNTS, _packed(keys), _zipped(m)))
        del codes, n, shard
        yield batch(out, [None] * len(out), [None] * len(out), pa.nulls(len(out), pa.list_(kind)))


def _column(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Texts side by side as a column of bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def group_counts(docs: DataFrame, order: int, shards: int, most: int) -> DataFrame:
    """The rows of all groups: neighbouring rows of about ``most`` bytes."""
    learnt = F.coalesce(fold("doc_id") != 1, F.lit(True)).alias("learnt")

    @lean
    def run(batches):
        number = TaskContext.get().partitionId() << 33
        group, kind = Group(order, shards), None
        for b in batches:
            kind = b.schema.field("doc_id").type
            flags, ends = b.column(1).to_numpy(zero_copy_only=False).astype(bool), np.cumsum(np.diff(strings(b.column(2))[1]) + 1)
            at = 0
            while at < b.num_rows:
                before = ends[at - 1] if at else 0
                to = int(np.searchsorted(ends, before + most - group.held, side="right"))
                to = max(to, at + (not group.held))
                if to > at:
                    group.add(b.column(0).slice(at, to - at), flags[at:to], b.column(2).slice(at, to - at))
                if to < b.num_rows:
                    yield from group.rows(number, kind)
                    number, group = number + 1, Group(order, shards)
                at = to
        if group.ids:
            yield from group.rows(number, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", learnt, "text").mapInArrow(run, f"group long, shard long, codes binary, n binary, part long, size long, sizes array<long>, ids array<{kind}>")


def unpacked(packed: DataFrame) -> DataFrame:
    """(key, n): the sums of packed counts."""

    @lean
    def run(batches):
        for b in batches:
            for codes, n in zip(b.column(0), b.column(1)):
                keys, m = _unpacked(codes), _unzipped(n)
                for i in range(0, len(keys), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 100_000]), pa.array(m[i : i + 100_000])], ["key", "n"])

    return packed.select("codes", "n").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def rated_codes(spark: SparkSession, pairs: DataFrame, order: int, shards: int, slice_groups: int = SLICE_GROUPS) -> DataFrame:
    """(group, shard, logs): log10 probability (float32) of each code of each group, by the counts of all groups.

    A shard of up to ``slice_groups`` groups is one task; of more, each slice of its groups is one, beside their sums.
    """
    base = min(BASE, order)
    low = unpacked(pairs.filter(F.col("shard") == LEVEL)).toArrow()
    shared = spark.sparkContext.broadcast((low["key"].to_numpy(), low["n"].to_numpy()))

    def rated(table: pa.Table, parts: list, codes: np.ndarray, n: np.ndarray) -> pa.Table:
        keys, counts = shared.value
        below = [marginals(keys, counts, k) for k in range(base)]
        seen = n > 0
        levels = [Level(*x) for x in below] + [Level(*marginals(codes[seen], n[seen], k)) for k in range(base, order + 1)]
        sort = np.argsort(codes)
        codes = codes[sort]
        logs = Trie(levels).log10(codes).astype(np.float32)
        values = pa.array([logs[np.searchsorted(codes, c)].tobytes() for c, _ in parts], pa.binary())
        del parts, codes, n, levels, logs
        trim()
        return pa.table({"group": table["group"], "shard": table["shard"], "logs": values})

    def whole(table: pa.Table) -> pa.Table:
        tight_heap()
        parts = [(_unpacked(c), _unzipped(n)) for c, n in zip(table["codes"], table["n"])]
        return rated(table, parts, *_tally(parts))

    def beside(table: pa.Table, sums: pa.Table) -> pa.Table:
        """The same for some groups of a shard, beside the sums of all its groups."""
        tight_heap()
        parts = [(_unpacked(c), _unzipped(n)) for c, n in zip(table["codes"], table["n"])]
        own = [(c, np.zeros(len(c), np.int64)) for c, _ in parts]
        return rated(table, parts, *_tally([*own, *((_unpacked(c), _unzipped(n)) for c, n in zip(sums["codes"], sums["n"]))]))

    mine = pairs.filter("shard >= 0").select("group", "shard", "codes", "n")
    slices_ = -(-pairs.filter((F.col("shard") == TEXTS) & (F.col("part") == 0)).count() // slice_groups)
    out = "group long, shard long, logs binary"
    if slices_ <= 1:
        return mine.repartition(min(MOST_TASKS, shards), "shard").groupBy("shard").applyInArrow(whole, out)
    mine = mine.withColumn("slice", F.pmod(F.xxhash64("group"), F.lit(slices_)))
    sums = summed(spark, mine.select("shard", "slice", "codes", "n"), slices_).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices_ - 1).cast("long"))))
    tasks = min(MOST_TASKS, shards * slices_)
    left, right = (x.repartition(tasks, "shard", "slice").groupBy("shard", "slice") for x in (mine, sums))
    return left.cogroup(right).applyInArrow(beside, out)


def summed(spark: SparkSession, rows: DataFrame, slices_: int, fan: int = FAN) -> DataFrame:
    """(shard, codes, n): the counts of all groups of a shard, added up in a tree of ``fan`` slices to a task.

    No task holds more than ``fan`` tables of the codes that were learnt, however many groups there are.
    """

    def add(table: pa.Table) -> pa.Table:
        tight_heap()
        codes, n = _tally([(_unpacked(c), _unzipped(m)) for c, m in zip(table["codes"], table["n"])])
        seen = n > 0
        codes, n = np.sort(codes[seen]), n[seen][np.argsort(codes[seen])]
        out = pa.table({"shard": table["shard"].slice(0, 1), "slice": table["slice"].slice(0, 1), "codes": pa.array([_packed(codes)], pa.binary()), "n": pa.array([_zipped(n)], pa.binary())})
        trim()
        return out

    kind = "shard long, slice long, codes binary, n binary"
    while True:
        rows = stored(spark, rows.groupBy("shard", "slice").applyInArrow(add, kind), "sums")
        if slices_ == 1:
            return rows.drop("slice")
        slices_ = -(-slices_ // fan)
        rows = rows.withColumn("slice", F.floor(F.col("slice") / fan))


def score(spark: SparkSession, docs: DataFrame, order: int = ORDER, most_words: int = MOST_WORDS, group_bytes: int = GROUP_BYTES, slice_groups: int = SLICE_GROUPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    bounded_batches(spark)
    seen = docs.agg(F.count_if(F.coalesce(fold("doc_id") != 1, F.lit(True))).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n_texts, shards, depth = seen["n"], 1 + seen["bytes"] // SHARD_BYTES, min(BASE, order)
    pairs = stored(spark, group_counts(docs, order, shards, group_bytes), "pairs", **PAGES)
    words = stored(spark, unpacked(pairs.filter(F.col("shard") == WORD_COUNTS)), "words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"] + n_texts, sums["v"] + (n_texts > 0)
    scale = float(np.log10(total + 0.5 * (distinct + 1)))
    least = bounded_threshold(words, most_words)
    frequent = words.filter(F.col("n") >= least).toArrow()
    sort = np.argsort(frequent["key"].to_numpy())
    keys = frequent["key"].to_numpy()[sort]
    logs = np.log10(frequent["n"].to_numpy().astype(float)[sort] + 0.5) - scale
    end_log = float(np.log10(n_texts + 0.5) - scale)
    shared = spark.sparkContext.broadcast((keys, logs))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rate(rows: pa.Table, rated: pa.Table) -> pa.Table:
        tight_heap()
        keys, logs = shared.value
        rows = rows.sort_by("part")
        size, sizes, blob = rows["size"][0].as_py(), rows["sizes"][0].values.to_numpy(), b"".join(rows["codes"].to_pylist())
        ids, number = rows["ids"][0].values, rows["group"][0].as_py() << 24
        texts = _column(np.frombuffer(pa.decompress(blob, size, "zstd"), np.uint8), sizes)
        parts, held = [], 0
        for _, _, t in slices(texts):
            parts.append(pd.unique(grams(t.lowered(), order)[0]))
            held += len(parts[-1])
            if held > HELD_CODES:
                parts, held = [pd.unique(np.concatenate(parts))], 0
        known_codes = pd.unique(np.concatenate(parts))
        known_codes = known_codes[_by_shard(known_codes, depth, shards)[1]]
        rated = rated.sort_by("shard")
        values = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in rated["logs"]])
        if len(values) != len(known_codes):
            raise ValueError(f"group {number >> 24}: {len(values)} rated codes of {len(known_codes)}")
        place, outs = pd.Index(known_codes), []
        del parts, known_codes
        for row, to, t in slices(texts):
            t = t.lowered()
            codes, first = grams(t, order)
            ppm = np.add.reduceat(values[place.get_indexer(codes)].astype(np.float64), first)
            h = t.word_hash.view(np.int64)
            begin = t.words[2]
            code, unique = pd.factorize(h)
            at = np.minimum(np.searchsorted(keys, unique), max(len(keys) - 1, 0))
            hit = keys[at] == unique if len(keys) else np.zeros(len(unique), bool)
            value = np.where(hit, logs[at] if len(keys) else 0.0, 0.0)[code]
            common = hit[code]
            owner = t.owner(begin)
            base = np.bincount(owner, value, t.n) + end_log
            known = np.bincount(owner, common, t.n).astype(np.int64)
            rare = np.bincount(owner, ~common, t.n).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(rare)).astype(np.int32)), pa.array(h[~common]))
            outs.append(pa.RecordBatch.from_arrays([pa.array(np.arange(row, to) + number), ids.slice(row, to - row), pa.array(np.diff(begin) + 1), pa.array(known + (n_texts > 0)), pa.array(base), pa.array(ppm), lists], ["row", "doc_id", "n_tokens", "known", "base", "score", "rare"]))
        del place, values
        trim()
        return pa.Table.from_batches(outs)

    # a group or two for each task
    tasks = min(MOST_TASKS, 1 + 4 * seen["bytes"] // group_bytes)
    texts = pairs.filter(F.col("shard") == TEXTS).select("group", "codes", "part", "size", "sizes", "ids").repartition(tasks, "group")
    rated = rated_codes(spark, pairs, order, shards, slice_groups).repartition(tasks, "group")
    first = texts.groupBy("group").cogroup(rated.groupBy("group")).applyInArrow(rate, f"row long, doc_id {kind}, n_tokens long, known long, base double, score double, rare array<long>")
    first = stored(spark, first, "scored")
    rare = first.select("row", F.explode("rare").alias("key"))
    rated = rare.join(words.hint("merge"), "key", "left").select("row", F.coalesce("n", F.lit(0)).alias("n"))
    rated = rated.groupBy("row").agg(F.count_if(F.col("n") > 0).alias("known_rare"), F.sum(F.log10(F.col("n") + 0.5) - scale).alias("base_rare"))
    rated = stored(spark, rated, "rare")
    joined = first.drop("rare").join(rated.hint("merge"), "row", "left")
    return joined.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"),
        "score",
    )
