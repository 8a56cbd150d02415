"""Quality rules: gradient-boosted trees over document statistics (operator 6).

Statistics are counted from the bytes of whole texts. A small boosted ensemble is fitted to a bounded
sample of labelled rows, with monotonic constraints (more symbols, repeated lines, repeated windows
or shouting never make a text better), flattened into numpy node arrays and applied to all rows.

Cases: a null or empty text has zero statistics and fails the base rule; repeated rows are scored
each; an empty table gives an empty result; without labels of both kinds only the base rule decides;
other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import bounded_batches
from weft.llm.textbatch import SPACE, U, lean, mix, repeated, slices, windows

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features of the trees and the direction in which each may move the score (0: free).
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "shouting": -1, "capitals": 0, "digits": 0, "accents": 0, "line_words": 0, "bars": -1}
#: At most so many labelled rows fit the trees; they are those with the smallest hash of the id.
SAMPLE_ROWS = 20_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts (int64, rows x COUNTS) and features (float64, rows x FEATURES) of whole texts."""
    counts, features = [np.zeros((0, len(COUNTS)), np.int64)], [np.zeros((0, len(FEATURES)))]
    for _, _, t in slices(column):
        start, end, first = t.words
        owner = t.owner(first)
        n_words = np.diff(first)
        letters = ~SPACE[t.data] & ((t.data & 0xC0) != 0x80)
        word_chars, symbols = t.per_text(letters), t.per_text(_SYMBOL[t.data])

        lo, hi, line_text = t.lines
        keys = mix(t.span_hash(lo, hi) + line_text.astype(U) * U(0x9FB21C651E98DF25))
        n_lines = np.bincount(line_text, minlength=t.n)
        distinct = np.bincount(line_text[np.unique(keys, return_index=True)[1]], minlength=t.n)

        window, at = windows(t.word_hash, first, 5)
        again = at[repeated(mix(window + owner[at].astype(U) * U(0x9FB21C651E98DF25)))]
        covered = np.zeros(len(start), bool)
        for j in range(5):
            covered[again + j] = True
        n_repeat = np.bincount(owner[covered], minlength=t.n)

        counts.append(np.stack([n_words, word_chars, symbols, n_lines - distinct, n_repeat], 1))
        chars, words, lines = np.maximum(word_chars, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
        d = t.data
        ratios = [t.per_text((d == 33) | (d == 63)) / words, t.per_text((d >= 65) & (d <= 90)) / chars, t.per_text((d >= 48) & (d <= 57)) / chars, t.per_text(d >= 0xC0) / chars]
        features.append(np.stack([np.log1p(n_words), word_chars / words, symbols / words, (n_lines - distinct) / lines, n_repeat / words, *ratios, n_words / lines, t.per_text(d == 124) / words], 1))
    return np.concatenate(counts), np.concatenate(features)


@dataclass
class Trees:
    """An ensemble as flat node arrays; a leaf points to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                down = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(down, self.left[node], self.right[node])
            raw += self.value[node]
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: int = 10) -> Trees:
    """Second-order boosting of the logistic loss over quantile bins.

    A split on a constrained feature must order its children's values, and each child is then
    bounded by their middle, so the whole ensemble is monotonic in that feature.
    """
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(base / (1 - base)))
    raw = np.full(len(y), bias)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def grow(rows, g, h, level, low, high) -> int:
        me = len(feature)
        for a, v in ((feature, 0), (cut, np.inf), (left, me), (right, me)):
            a.append(v)
        value.append(float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high)) * rate)
        if level == depth or len(rows) < 2 * least:
            return me
        best = (1e-6, None)
        G, H = g[rows].sum(), h[rows].sum()
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
            vl, vr = np.clip(-gl / (hl + l2), low, high), np.clip(-(G - gl) / (H - hl + l2), low, high)
            gain = gl**2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G**2 / (H + l2)
            fine = (nl >= least) & (len(rows) - nl >= least) & ((vr - vl) * signs[f] >= 0)
            gain = np.where(fine, gain, -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, k, float(vl[k]), float(vr[k])))
        if best[1] is None:
            return me
        f, k, vl, vr = best[1]
        mid, down = (vl + vr) / 2, binned[rows, f] <= k
        bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[signs[f]]
        feature[me], cut[me] = f, float(cuts[f][k])
        left[me] = grow(rows[down], g, h, level + 1, *bounds[0])
        right[me] = grow(rows[~down], g, h, level + 1, *bounds[1])
        return me

    arrays = lambda: [np.array(a) for a in (feature, cut, left, right, value)]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        one = Trees(*arrays(), np.array(roots[-1:]), depth, 0.0)
        raw += np.log((q := np.clip(one.probability(x), 1e-12, 1 - 1e-12)) / (1 - q))
    return Trees(*arrays(), np.array(roots), depth, bias)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the features (an array) of the rows that pass the base rule."""

    @lean
    def run(batches):
        for b in batches:
            counts, features = statistics(b.column(1))
            good = ~fails_base(counts)
            features = features[good]
            offs = pa.array(np.arange(0, features.size + 1, len(FEATURES), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(good)), pa.ListArray.from_arrays(offs, pa.array(features.ravel()))], ["doc_id", "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, features array<double>")


def fails_base(counts: np.ndarray) -> np.ndarray:
    """Fewer than ten words, or over a fifth of the words in repeated five-word windows."""
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees for labels.quality from at most ``sample_rows`` labelled ids; None without two classes."""
    labels = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    known = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    rows = document_statistics(known).groupBy("doc_id").agg(F.max("features").alias("features")).join(F.broadcast(chosen), "doc_id").toPandas()
    if not len(rows) or rows["quality"].nunique() < 2:
        return None
    rows = rows.sort_values("doc_id", kind="stable")
    return fit(np.stack(rows["features"].to_numpy()), rows["quality"].to_numpy().astype(float), list(FEATURES.values()))


def _verdict(trees: Trees | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts, features = statistics(column)
    return counts, fails_base(counts), np.ones(len(counts)) if trees is None else trees.probability(features)


def assess(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, COUNTS, base_failed, quality (the trees' probability) and kept for every row, in one scan."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(train(docs, labels, sample_rows))

    @lean
    def run(batches):
        for b in batches:
            counts, failed, p = _verdict(shared.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(p), pa.array(~failed & (p >= threshold))], ["doc_id", *COUNTS, "base_failed", "quality", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, quality double, kept boolean")


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(train(docs, labels, sample_rows))
    at = docs.columns.index("text")

    @lean
    def run(batches):
        for b in batches:
            _, failed, p = _verdict(shared.value, b.column(at))
            yield b.filter(pa.array(~failed & (p >= threshold)))

    return docs.mapInArrow(run, docs.schema)
