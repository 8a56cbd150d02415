"""Benchmark decontamination by a broadcast set of normalised n-grams (operator 13).

A text is its words after A-Z become lower case: runs of digits, letters a-z and bytes above 0x7F. A window is WIDTH
consecutive words of a benchmark item; an item of fewer words, but not none, is one window. The windows' hashes, their
words and the items that hold them are broadcast; a task hashes all windows of its documents at once, looks them up,
and compares the words of every hit byte by byte, so a collision of hashes never counts. Words inside verified windows
are hit. Items that share a window are kept once as a list, and a list of items is joined and hashed once a task.

The set is broadcast only if the benchmark's texts have BROADCAST_BYTES or fewer, which one aggregate tells first.
A larger benchmark meets the documents in an equi-join on the words of the window, after a bitmap of fixed size has
left out nearly all windows that no item has; both ways give the same rows, and AQE can split a window of many documents.

Cases: a null text has no words; a null item text has no windows; a row of the benchmark without item_id makes
words hit, but counts as no item; rows that repeat an item_id are one item; without benchmark windows nothing is hit;
no item gives the hash of the empty string; repeated rows get the same result each; other columns of the documents
pass through ``scanned``, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from weft.llm.common import OWN, bounded_batches, stored
from weft.llm.textbatch import WORDY, Texts, U, lean, slices, windows

WIDTH = 10
#: Bytes of benchmark text whose windows are broadcast; about ten times as many bytes of an executor's worker.
BROADCAST_BYTES = 4 << 20
#: Bits of the map that thins the windows of documents for a larger benchmark (8 MB).
MAP_BITS = 1 << 26
NO_ITEMS = hashlib.sha256(b"").hexdigest()


def _words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first word of each text; ``t`` is lower case."""
    return t.runs(WORDY[t.data])


def _plain(t: Texts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one after the other with a blank behind each: bytes, and where each word begins."""
    size = end - start
    at = np.append(0, np.cumsum(size + 1))
    out = np.full(int(at[-1]), 32, np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[inner + np.repeat(at[:-1], size)] = t.data[inner + np.repeat(start, size)]
    return out, at


def _windows_of(t: Texts, hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window of ``width`` words."""
    return windows(hashes, first, width) if len(first) > 1 and len(hashes) >= width else (np.zeros(0, U), np.zeros(0, np.int64))


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, k, h, window): the windows of every item: how many words, their hash and the words with blanks between."""

    @lean
    def run(batches):
        for b in batches:
            for row, _, t in slices(b.column(1)):
                t = t.lowered()
                start, end, first = _words(t)
                hashes, (plain, at) = t.span_hash(start, end), _plain(t, start, end)
                counts = np.diff(first)
                k = np.minimum(counts, width)
                n = np.maximum(counts - width + 1, (counts > 0).astype(np.int64))
                owner = np.repeat(np.arange(t.n), n)
                begin = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner]
                long = k[owner]
                h = np.zeros(len(owner), U)
                for some in np.unique(long):
                    of, where = _windows_of(t, hashes, first, int(some))
                    mine = np.flatnonzero(long == some)
                    h[mine] = of[np.searchsorted(where, begin[mine])]
                raw = plain.tobytes()
                texts = [raw[at[i] : at[i + c] - 1] for i, c in zip(begin, long)]
                ids = b.column(0).take(pa.array(owner + row))
                yield pa.RecordBatch.from_arrays([ids, pa.array(long, pa.int32()), pa.array(h.view(np.int64)), pa.array(texts, pa.binary())], ["item", "k", "h", "window"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(run, "item string, k int, h long, window binary")


class WindowSet:
    """Distinct windows by hash, their words, and the items of each as a number into ``lists``."""

    def __init__(self, rows: pa.Table):
        held: dict[tuple[int, int, bytes], set[str]] = {}
        for item, k, h, window in zip(*(rows.column(c).to_pylist() for c in ("item", "k", "h", "window"))):
            held.setdefault((k, h, window), set()).update([] if item is None else [item])
        numbers: dict[tuple[str, ...], int] = {}
        keys = sorted(held)
        self.of = np.array([numbers.setdefault(tuple(sorted(held[x])), len(numbers)) for x in keys], np.int64)
        self.lists = list(numbers)
        self.size = np.array([len(w) for _, _, w in keys], np.int64)
        self.at = np.append(0, np.cumsum(self.size))[:-1]
        self.words = np.frombuffer(b"".join(w for _, _, w in keys), np.uint8)
        k = np.array([x[0] for x in keys], np.int64)
        # the keys are in order, so those of a width are one stretch with ascending hashes
        self.widths = {int(x): (int(np.searchsorted(k, x)), np.array([h for c, h, _ in keys if c == x], np.int64)) for x in np.unique(k)}

    def hits(self, t: Texts, start: np.ndarray, end: np.ndarray, first: np.ndarray):
        """(first word, words, window) of every verified occurrence in the lower-case ``t``."""
        hashes, plain, at = t.span_hash(start, end), None, None
        for width, (base, known) in self.widths.items():
            h, begin = _windows_of(t, hashes, first, width)
            h = h.view(np.int64)
            lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            some = np.flatnonzero(hi > lo)
            if not len(some):
                continue
            n = (hi - lo)[some]
            begin = np.repeat(begin[some], n)
            window = base + np.repeat(lo[some], n) + np.arange(len(begin)) - np.repeat(np.cumsum(n) - n, n)
            if plain is None:
                plain, at = _plain(t, start, end)
            same = self.size[window] == at[begin + width] - at[begin] - 1
            begin, window = begin[same], window[same]
            for a in range(0, len(begin), 65536):  # as many at a time, which bounds the bytes compared at once
                x, w = begin[a : a + 65536], window[a : a + 65536]
                size = self.size[w]
                inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                differ = plain[np.repeat(at[x], size) + inner] != self.words[np.repeat(self.at[w], size) + inner]
                good = ~np.logical_or.reduceat(differ, np.cumsum(size) - size)
                yield x[good], width, w[good]


def _covered(n: int, begin: np.ndarray, width: int, depth: np.ndarray) -> None:
    """Adds windows of ``width`` words to the counts of openings and closings of ``n`` words."""
    depth += np.bincount(begin, minlength=n + 1)
    depth -= np.bincount(begin + width, minlength=n + 1)


def _spans(hit: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, offs: np.ndarray) -> list[list[dict]]:
    """For each text the byte ranges of its runs of hit words."""
    out = []
    for i in np.flatnonzero(np.diff(first)):
        a, b = first[i], first[i + 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit[a:b], [False]]).astype(np.int8)))
        if len(edge):
            out.append((int(i), [{"start": int(s), "end": int(e)} for s, e in zip(start[a + edge[::2]] - offs[i], end[a + edge[1::2] - 1] - offs[i])]))
    spans: list[list[dict]] = [[] for _ in range(len(first) - 1)]
    for i, x in out:
        spans[i] = x
    return spans


SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FOUND = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("spans", SPAN), ("contaminated", pa.bool_())]
_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_FOUND = [StructField(OWN + c, t) for c, t in zip([c for c, _ in FOUND], [LongType(), LongType(), LongType(), StringType(), ArrayType(_SPAN), BooleanType()])]


def _digest(items: list[str]) -> tuple[int, str]:
    return len(items), hashlib.sha256(",".join(items).encode()).hexdigest()


def _scan_small(spark: SparkSession, docs: DataFrame, rows: pa.Table) -> DataFrame:
    known = spark.sparkContext.broadcast(WindowSet(rows))
    place = docs.columns.index("text")

    @lean
    def run(batches):
        windows_ = known.value

        @lru_cache(4096)
        def digest(numbers: tuple[int, ...]) -> tuple[int, str]:
            return _digest(sorted(set(chain.from_iterable(windows_.lists[x] for x in numbers))))

        for b in batches:
            found = []
            for _, _, t in slices(b.column(place)):
                t = t.lowered()
                start, end, first = _words(t)
                n = len(start)
                depth, lists = np.zeros(n + 1, np.int64), [np.zeros((0, 2), np.int64)]
                for begin, width, window in windows_.hits(t, start, end, first):
                    _covered(n, begin, width, depth)
                    text = np.searchsorted(first, begin, side="right") - 1
                    lists.append(np.unique(np.stack([text, windows_.of[window]], 1), axis=0))
                hit = np.cumsum(depth)[:n] > 0
                total = np.append(0, np.cumsum(hit))
                n_hit = total[first[1:]] - total[first[:-1]]
                pairs = np.unique(np.concatenate(lists), axis=0)
                cut = np.searchsorted(pairs[:, 0], np.arange(t.n + 1))
                spans = _spans(hit, start, end, first, t.offs) if n_hit.any() else [[]] * t.n
                for i in range(t.n):
                    items = digest(tuple(pairs[cut[i] : cut[i + 1], 1].tolist())) if n_hit[i] else (0, NO_ITEMS)
                    found.append((int(first[i + 1] - first[i]), int(n_hit[i]), *items, spans[i], bool(n_hit[i])))
            columns = list(zip(*found)) if found else [[]] * len(FOUND)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, kind) for x, (_, kind) in zip(columns, FOUND))], [*b.schema.names, *(OWN + c for c, _ in FOUND)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *_FOUND]))


def _scan_large(spark: SparkSession, docs: DataFrame, rows: DataFrame) -> DataFrame:
    """As ``_scan_small`` for a benchmark of any size: windows that pass the bitmap meet the items' by a join."""
    rows = stored(spark, rows, "items")
    bit = F.pmod(F.col("h"), F.lit(MAP_BITS))
    words = rows.select(F.shiftright(bit, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    bits = np.zeros(MAP_BITS // 64, np.int64)
    for part in words.toLocalIterator():  # at most MAP_BITS / 64 rows, put into an array of fixed size one by one
        bits[part["w"]] = part["b"]
    widths = sorted(r["k"] for r in rows.select("k").distinct().collect())
    known = spark.sparkContext.broadcast(bits)
    ident = [F.xxhash64(F.lit(13), F.col("text")), F.xxhash64(F.lit(17), F.col("text"))]

    @lean
    def candidates(batches):
        bits = known.value
        for b in batches:
            for row, _, t in slices(b.column(2)):
                t = t.lowered()
                start, end, first = _words(t)
                hashes, (plain, at) = t.span_hash(start, end), _plain(t, start, end)
                raw = plain.tobytes()
                for k in widths:
                    h, begin = _windows_of(t, hashes, first, k)
                    bit = (h.view(np.int64) % MAP_BITS).astype(np.int64)
                    begin = begin[(bits[bit >> 6] >> (bit & 63)) & 1 == 1]
                    text = np.searchsorted(first, begin, side="right") - 1
                    take = pa.array(text + row)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(take), b.column(1).take(take), pa.array(np.full(len(begin), k, np.int32)), pa.array(begin - first[text]), pa.array([raw[at[i] : at[i + k] - 1] for i in begin], pa.binary())],
                        ["k1", "k2", "k", "begin", "window"],
                    )

    texts = docs.select(ident[0].alias("k1"), ident[1].alias("k2"), F.col("text").cast("string").alias("text")).filter("text is not null")
    met = texts.mapInArrow(candidates, "k1 long, k2 long, k int, begin long, window binary").distinct()
    # a window's own number stands for it, so that its items are met only once for each document
    numbered = stored(spark, rows.groupBy("k", "window").agg(F.min(F.xxhash64("h", "window")).alias("id")), "windows")
    hits = stored(spark, met.join(numbered.hint("merge"), ["k", "window"]).select("k1", "k2", "k", "begin", "id"), "hits")
    held = rows.filter("item is not null").join(numbered.hint("merge"), ["k", "window"]).select("id", "item").distinct()
    items = hits.select("k1", "k2", "id").distinct().join(held.hint("merge"), "id").groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    places = hits.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("begin", "k"))).alias("places"))
    found = stored(spark, places.join(items.hint("merge"), ["k1", "k2"], "left").select(*(F.col(c).alias(OWN + c) for c in ("k1", "k2", "places", "items"))), "found")
    joined = docs.withColumns({OWN + "h1": ident[0], OWN + "h2": ident[1]})
    same = (F.col(OWN + "h1") == F.col(OWN + "k1")) & (F.col(OWN + "h2") == F.col(OWN + "k2"))
    joined = joined.join(found.hint("merge"), same, "left").select(*docs.columns, OWN + "places", OWN + "items")
    place = docs.columns.index("text")

    @lean
    def finish(batches):
        for b in batches:
            out = []
            at, items = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            for row, _, t in slices(b.column(place)):
                t = t.lowered()
                start, end, first = _words(t)
                hit = np.zeros(len(start), bool)
                for i in range(t.n):
                    for x in at[row + i] or ():
                        hit[first[i] + x["begin"] : first[i] + x["begin"] + x["k"]] = True
                spans = _spans(hit, start, end, first, t.offs)
                for i in range(t.n):
                    n_hit = int(hit[first[i] : first[i + 1]].sum())
                    out.append((int(first[i + 1] - first[i]), n_hit, *_digest(items[row + i] or []), spans[i], n_hit > 0))
            columns = list(zip(*out)) if out else [[]] * len(FOUND)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *(pa.array(x, kind) for x, (_, kind) in zip(columns, FOUND))], [*b.schema.names[:-2], *(OWN + c for c, _ in FOUND)])

    return joined.mapInArrow(finish, StructType([*docs.schema.fields, *_FOUND]))


def scanned(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with OWN + n_words, n_hit, n_items, items_sha256, spans (byte ranges of hit words) and contaminated."""
    bounded_batches(spark)
    rows = item_windows(benchmark, width)
    size = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return _scan_small(spark, docs, rows.toArrow()) if size <= most else _scan_large(spark, docs, rows)


def without_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, share: float = 0.0, **options) -> DataFrame:
    """``docs`` without those of whose words more than ``share`` are hit."""
    n = F.col(OWN + "n_words")
    good = (F.col(OWN + "n_hit") == 0) | (F.col(OWN + "n_hit") <= share * n)
    return scanned(spark, docs, benchmark, **options).filter(good).select(*docs.columns)


def without_spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` whose texts have lost every run of hit words, from its first word to its last; a blank stands for it."""
    rows = scanned(spark, docs, benchmark, **options)
    spans, raw = F.col(OWN + "spans"), F.encode("text", "utf-8")
    # what stands before each run, and what is left behind the last
    edge = lambda i: F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"])
    part = lambda i: F.substring(raw, (edge(i) + 1).cast("int"), (F.coalesce(F.get(spans, i)["start"], F.octet_length("text").cast("long")) - edge(i)).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.decode(part(i), "utf-8"))
    text = F.when(F.size(spans) > 0, F.array_join(parts, " ")).otherwise(F.col("text"))
    return rows.select(*(text.alias(c) if c == "text" else F.col(c) for c in docs.columns))


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id and what ``scanned`` found, without texts."""
    rows = scanned(spark, docs.select("doc_id", "text"), benchmark, **options)
    return rows.select("doc_id", *(F.col(OWN + c).alias(c) for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")))
