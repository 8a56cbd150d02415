"""Toxicity: maximum-scoring segments of token log-odds (operator 9).

Token log-odds between toxic and other labelled texts are smoothed by a Dirichlet prior with the
shares of both classes together; a token counts only if its z-score is significant, and every token
costs a drift, so scores of clean text fall. In one pass a linear scan finds all maximal segments of
each text. A segment with score S in n tokens has about K n exp(-lambda S) equals by chance. lambda is the
root of E exp(lambda s) = 1 over clean tokens; K is the maximum-likelihood value of the extreme-value
distribution of the best segments of token sequences drawn with the shares of clean text. The evidence
of a text is the sum of lambda S - ln(K n) over its significant segments, mapped to 0..1 by a
two-parameter logistic fit to evidence out of fold: labelled texts fall in four parts, each rated by the
tokens of the other three. passages() gives the segments themselves, with their places in the text.

The tokens come from a bounded sample of labelled texts (``sample_rows``), which bounds the model.

Cases: null and empty texts have no segment and get the score of no evidence; repeated rows are
scored each; without labels of both kinds all scores are 0, and if three parts lack a kind the logistic is fitted
to the texts that gave the tokens; only doc_id, text and toxic are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import bounded_batches, fold, stored
from weft.llm.textbatch import WORDY, U, lean, mix, slices

#: At most so many labelled ids are learnt from; those with the smallest hash of the id.
SAMPLE_ROWS = 60_000
STEM = 4
DRIFT = 0.4
#: Sequences drawn for K, and their tokens.
DRAWN, DRAWN_TOKENS = 32, 32_768
_STEM_TAG = U(0xA24BAED4963EE407)


def tokens(t) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased runs of letters and digits: hash, hash of the first STEM characters, first of each text, start and end bytes."""
    low = t.lowered()
    start, end, first = low.runs(WORDY[low.data])
    signs = np.append(np.flatnonzero((low.data & 0xC0) != 0x80), np.full(STEM, len(low.data)))
    stem = np.minimum(end, signs[np.searchsorted(signs[: len(signs) - STEM], start) + STEM])
    return low.span_hash(start, end), low.span_hash(start, stem) ^ _STEM_TAG, first, start, end


def _counts(docs: DataFrame) -> DataFrame:
    """Per part, token or stem: how often in toxic and other texts, and in how many toxic texts; from (text, toxic, part)."""
    by = ["part", "kind", "token"]

    @lean
    def run(batches):
        for b in batches:
            out = []
            toxic, part = b.column(1).to_numpy(zero_copy_only=False).astype(bool), b.column(2).to_numpy()
            for row, to, t in slices(b.column(0)):
                word, stem, first, _, _ = tokens(t)
                owner = t.owner(first)
                bad = toxic[row:to][owner]
                for kind, keys in ((0, word), (1, stem)):
                    text = mix(keys + owner.astype(U))
                    fresh = np.zeros(len(keys), bool)
                    fresh[np.unique(text, return_index=True)[1]] = True
                    frame = pd.DataFrame({"part": part[row:to][owner].astype(np.int64), "kind": kind, "token": keys.view(np.int64), "toxic": bad.astype(np.int64), "clean": (~bad).astype(np.int64), "texts": (bad & fresh).astype(np.int64)})
                    out.append(frame.groupby(by, as_index=False, sort=False).sum())
            if out:
                yield pa.RecordBatch.from_pandas(pd.concat(out).groupby(by, as_index=False, sort=False).sum(), preserve_index=False)

    per_task = docs.mapInArrow(run, "part long, kind long, token long, toxic long, clean long, texts long")
    return per_task.groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "texts")))


class Model:
    """Significant tokens (sorted hashes) with log-odds, and the calibration of segments."""

    def __init__(self, keys, odds, decay, factor):
        self.keys, self.odds, self.decay, self.factor = keys, odds, decay, factor
        self.weights = (0.0, 1.0)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.odds[at], 0.0)

    def scores(self, t) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Score of each token (its own log-odds, else its stem's) less the drift; first token of each text; start and end bytes."""
        word, stem, first, start, end = tokens(t)
        odds = self.lookup(word)
        none = np.flatnonzero(odds == 0)
        odds[none] = self.lookup(stem[none])
        return odds - DRIFT, first, start, end

    def passages(self, t) -> list[tuple[int, int, int, float, float]]:
        """Text, start and end byte in it, score and significance of every significant segment."""
        s, first, start, end = self.scores(t)
        out = []
        n = np.diff(first)
        total = np.concatenate([[0.0], np.cumsum(s)])
        hot = np.flatnonzero(s > 0)
        bounds = np.searchsorted(hot, first)
        for k in np.flatnonzero(np.diff(bounds)):
            at = hot[bounds[k] : bounds[k + 1]]
            found = segments(total[at] - total[first[k]], total[at + 1] - total[first[k]])
            chance = np.log(max(1.0, self.factor * n[k]))
            out += [(int(k), int(start[at[a]] - t.offs[k]), int(end[at[b]] - t.offs[k]), x, self.decay * x - chance) for x, a, b in found if self.decay * x > chance]
        return out

    def evidence(self, column: pa.Array) -> np.ndarray:
        """Summed significance of the passages of each text."""
        out = [np.zeros(0)]
        for _, _, t in slices(column):
            found = self.passages(t)
            out.append(np.bincount([x[0] for x in found], [x[4] for x in found], t.n) if found else np.zeros(t.n))
        return np.concatenate(out)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        a, b = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * evidence, -40, 40)))


def segments(before: np.ndarray, after: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments, from the running sums before and after each positive token.

    Only positive tokens can start or end a segment. The list of candidates keeps, for each, the sum
    before it, the sum after it and the last earlier candidate with a smaller left sum, which makes
    the scan linear. Returns (score, first, last) with indices of positive tokens.
    """
    left: list[float] = []
    right: list[float] = []
    span: list[tuple[int, int]] = []
    back: list[int] = []
    for i, (lo, hi) in enumerate(zip(before.tolist(), after.tolist())):
        begin = i
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = back[j]
            if j < 0 or right[j] >= hi:
                left.append(lo)
                right.append(hi)
                span.append((begin, i))
                back.append(j)
                break
            lo, begin = left[j], span[j][0]
            del left[j:], right[j:], span[j:], back[j:]
    return [(h - l, a, b) for l, h, (a, b) in zip(left, right, span)]


def decay_of(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(shares * exp(x * values)) = 1; the mean of ``values`` is negative."""
    if not (values > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    f = lambda x: float((shares * np.exp(np.minimum(x * values, 600))).sum())
    while f(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 1 else (low, mid)
    return max(high, 1e-3)


def chance_factor(values: np.ndarray, shares: np.ndarray, decay: float, seed: int = 5) -> float:
    """K of the extreme-value distribution: best segments of drawn sequences follow exp(-K n exp(-decay S))."""
    draws = np.random.default_rng(seed).random((DRAWN, DRAWN_TOKENS))
    s = values[np.minimum(np.searchsorted(np.cumsum(shares), draws), len(values) - 1)]
    total = np.concatenate([np.zeros((DRAWN, 1)), np.cumsum(s, axis=1)], 1)
    best = (total - np.minimum.accumulate(total, axis=1)).max(1)
    return float(DRAWN / (DRAWN_TOKENS * np.exp(-decay * best).sum()))


def fitted(rates: DataFrame, least_z: float, least_texts: int) -> Model | None:
    """The significant tokens of stored ``rates`` and the calibration of their segments; None without both kinds."""
    rates = rates.groupBy("kind", "token").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "texts")))
    sums = rates.filter("kind = 0").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    n_toxic, n_clean = sums["t"] or 0, sums["c"] or 0
    if not n_toxic or not n_clean:
        return None
    # the prior has the weight of a hundredth of the toxic tokens, spread by the shares of both classes together
    prior = 0.01 * n_toxic
    a = (F.col("toxic") + F.col("clean")) * F.lit(prior / (n_toxic + n_clean)) + F.lit(0.01)
    odds = F.log((F.col("toxic") + a) / F.lit(n_toxic + prior)) - F.log((F.col("clean") + a) / F.lit(n_clean + prior))
    rated = rates.select("*", odds.alias("odds"), (odds / F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a))).alias("z"))
    # bounded by the labelled sample
    top = rated.filter((F.col("z") >= least_z) & (F.col("texts") >= least_texts)).select("token", "odds", "clean").toPandas()
    keys = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    values, clean = top["odds"].to_numpy(float)[order], top["clean"].to_numpy(float)[order]
    shares = np.append(clean + 0.5, max(1.0, n_clean - clean.sum())) / (n_clean + 0.5 * len(clean) + 1)
    steps, shares = np.append(values, 0.0) - DRIFT, shares / shares.sum()
    decay = decay_of(steps, shares)
    return Model(keys[order], values, decay, chance_factor(steps, shares, decay))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, least_z: float = 4.0, least_texts: int = 4) -> Model | None:
    bounded_batches(spark)
    labels = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold("doc_id") != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"), fold("doc_id").cast("int").alias("part"))
    rates = stored(spark, _counts(known), "rates")
    model = fitted(rates, least_z, least_texts)
    if model is None:
        return None
    judges = [fitted(rates.filter(f"part <> {k}"), least_z, least_texts) for k in range(1, 5)]
    shared = spark.sparkContext.broadcast(judges if all(judges) else [model] * 4)

    @lean
    def run(batches):
        for b in batches:
            part = b.column(2).to_numpy()
            for k, judge in enumerate(shared.value, 1):
                mine = b.filter(pa.array(part == k))
                yield pa.RecordBatch.from_arrays([pa.array(judge.evidence(mine.column(0))), mine.column(1)], ["evidence", "toxic"])

    seen = known.mapInArrow(run, "evidence double, toxic int").groupBy(F.round("evidence", 2).alias("e"), "toxic").count().toPandas()
    model.weights = logistic(np.log1p(seen["e"].to_numpy()), seen["toxic"].to_numpy().astype(float), seen["count"].to_numpy().astype(float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted Newton fit of two parameters with a small ridge; the slope is never negative."""
    beta, design = np.zeros(2), np.stack([np.ones(len(x)), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (y - p)) - 1e-3 * beta
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, evidence, score and predicted of every row."""
    shared = spark.sparkContext.broadcast(train(spark, docs, labels, **options))

    @lean
    def run(batches):
        for b in batches:
            model = shared.value
            e = np.zeros(b.num_rows) if model is None else model.evidence(b.column(1))
            p = np.zeros(b.num_rows) if model is None else model.probability(np.log1p(e))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(e), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "evidence", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, evidence double, score double, predicted int")
    return out.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted", "evidence")


def passages(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, start, end, score and significance of every significant segment; places are bytes of the UTF-8 text, end excluded.

    The evidence that score() gives a row is the sum of the significance of its passages.
    """
    shared = spark.sparkContext.broadcast(train(spark, docs, labels, **options))

    @lean
    def run(batches):
        for b in batches:
            for row, to, t in slices(b.column(1)):
                found = shared.value.passages(t) if shared.value is not None else []
                if found:
                    text, *columns = zip(*found)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(row, to - row).take(pa.array(text)), *map(pa.array, columns)], ["doc_id", "start", "end", "score", "significance"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, end long, score double, significance double")
