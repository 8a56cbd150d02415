"""Language identification: byte n-grams in a naive Bayes model trained here, or a fastText file.

A model is any object with ``predict(texts) -> (labels, probabilities)`` that can be pickled; labels are ISO
639-3 codes (or whatever the training rows call their languages), the empty label with 0.0 where none is known.

Cases: null and empty texts get the empty label; rows of training without text or language are left out;
a model of no language says nothing about any text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from weft.log import logger
from weft.storage import bounded_batches, stored

SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 15
#: Languages of a block of the model (33 MB); a model of more is applied block by block, in passes over the texts.
BLOCK = 256
#: Shares of buckets that are added up at once (32 MB), and bytes of text whose n-grams are counted at once.
SHARES, TEXTS = 4 << 20, 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: np.ndarray) -> list[np.ndarray]:
    """The bucket of the n-gram of each size that begins at each byte."""
    out, data = [], data.astype(np.uint64) + np.uint64(1)
    for size in SIZES:
        if len(data) >= size:
            h = np.full(len(data) - size + 1, size, np.uint64)
            for j in range(size):
                h = (h ^ data[j : len(data) - size + 1 + j]) * _STEP
                h ^= h >> np.uint64(29)
            out.append(((h >> np.uint64(17)) % np.uint64(BUCKETS)).astype(np.int64))
    return out


def _plain(text: str | None) -> bytes:
    """Lower-cased bytes, blanks collapsed; nothing of a text without any."""
    words = text.lower().split() if text else None
    return f" {' '.join(words)} ".encode() if words else b""


def buckets(text: str) -> np.ndarray:
    """Hashed n-grams of the lower-cased bytes of a text, blanks collapsed."""
    found = _grams(np.frombuffer(_plain(text) or b"  ", np.uint8))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def counted(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, text, bucket, count) of some texts at a time: the distinct buckets of each, in order of text."""
    row = 0
    while row < len(texts):
        held, size, first = [], 0, row
        while row < len(texts) and (not held or size < TEXTS):
            held.append(_plain(texts[row]))
            size += len(held[-1])
            row += 1
        ends = np.cumsum([len(x) for x in held])
        data, keys = np.frombuffer(b"".join(held), np.uint8), [np.zeros(0, np.int64)]
        owner = np.repeat(np.arange(len(held)), np.diff(np.append(0, ends)))
        for n, found in zip(SIZES, _grams(data)):
            inside = owner[: len(found)] == owner[n - 1 :]
            keys.append(owner[: len(found)][inside] * BUCKETS + found[inside])
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        yield first, key // BUCKETS, key % BUCKETS, count


class NgramModel:
    """Log-shares of buckets for each language (languages x BUCKETS)."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs

    def blocks(self) -> list[NgramModel]:
        return [NgramModel(self.languages[i : i + BLOCK], self.logs[i : i + BLOCK]) for i in range(0, len(self.languages), BLOCK)]

    @cached_property
    def _columns(self) -> np.ndarray:
        return np.ascontiguousarray(self.logs.T)

    def __getstate__(self):
        return {"languages": self.languages, "logs": self.logs}

    def best(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the number of the best language (-1: none), its log-score, and the log of the sum of all scores.

        Counts of distinct buckets times rows of the model: a product of a sparse matrix, some rows at a time.
        """
        out = np.full(len(texts), -1), np.full(len(texts), -np.inf), np.full(len(texts), -np.inf)
        if not self.languages:
            return out
        most = max(1, SHARES // len(self.languages))
        for first, text, bucket, count in counted(texts):
            if not len(text):
                continue
            score = np.zeros((int(text[-1]) + 1, len(self.languages)))
            for a in range(0, len(text), most):
                t, part = text[a : a + most], self._columns[bucket[a : a + most]] * count[a : a + most, None]
                cut = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
                score[t[cut]] += np.add.reduceat(part, cut, axis=0)
            have = np.unique(text)
            score = score[have]
            top = score.max(1)
            out[0][first + have] = score.argmax(1)
            out[1][first + have] = top
            out[2][first + have] = top + np.log(np.exp(score - top[:, None]).sum(1))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        best, top, total = self.best(texts)
        return [self.languages[i] if i >= 0 else "" for i in best], [float(np.exp(a - b)) if i >= 0 else 0.0 for i, a, b in zip(best, top, total)]


@lru_cache(maxsize=2)
def _opened(path: str):
    import fasttext

    return fasttext.load_model(path)


class FastTextModel:
    """A fastText file; opened once in each worker. Labels lose their prefix and what follows the language code."""

    def __init__(self, path: str):
        self.path = path

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, probs = [], []
        for t in texts:
            found, share = _opened(self.path).predict((t or "").replace("\n", " "), k=1)
            labels.append(found[0].removeprefix("__label__").split("_")[0] if len(found) else "")
            probs.append(float(share[0]) if len(found) else 0.0)
        return labels, probs


def opened(path: str | None):
    """The fastText model of a file, or None (with a word in the log) where the file or the library is missing."""
    try:
        import os

        import fasttext  # noqa: F401

        if path and os.path.isfile(path):
            return FastTextModel(path)
        logger("langid").warning("no language model at %s; texts are not filtered by language", path)
    except ImportError:
        logger("langid").warning("fasttext is not installed; texts are not filtered by language")
    return None


def train(docs: DataFrame) -> NgramModel:
    """The model of rows (text, lang): smoothed shares of hashed n-grams, counted over all rows.

    Counts are added up by Spark and come to the driver for BLOCK languages at a time; the model has BUCKETS numbers for each language.
    """

    def run(batches):
        for b in batches:
            lang = b.column(1).dictionary_encode()
            code, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
            for first, text, bucket, count in counted(b.column(0).to_pylist()):
                key, at = np.unique(code[first + text].astype(np.int64) * BUCKETS + bucket, return_inverse=True)
                total = np.bincount(at, count).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(key // BUCKETS)), pa.array(key % BUCKETS), pa.array(total)], ["lang", "bucket", "n"])

    bounded_batches(docs.sparkSession)
    rows = docs.select("text", "lang").filter("text <> '' and lang <> ''")
    counts = stored(docs.sparkSession, rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "counts")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    tables = [np.zeros((0, BUCKETS), np.float32)]
    for i in range(0, len(languages), BLOCK):
        some = languages[i : i + BLOCK]
        got = counts.filter((F.col("lang") >= some[0]) & (F.col("lang") <= some[-1])).toArrow()
        table, place = np.full((len(some), BUCKETS), 0.5), {x: k for k, x in enumerate(some)}
        table[[place[x] for x in got.column("lang").to_pylist()], got.column("bucket").to_numpy()] += got.column("n").to_numpy()
        tables.append(np.log(table / table.sum(1, keepdims=True)).astype(np.float32))
    return NgramModel(languages, np.concatenate(tables))


def identified(docs: DataFrame, model, text: str = "text", label: str = "lang", prob: str = "prob") -> DataFrame:
    """``docs`` with the label and probability of each text; columns of these names are replaced.

    A model of more languages than a block is broadcast block by block, with rows and their best so far stored
    between, so a worker never holds more than one block.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rest = [c for c in docs.columns if c not in (label, prob)]
    blocks = model.blocks() if isinstance(model, NgramModel) and len(model.languages) > BLOCK else [model]
    rows = docs.select(*rest)
    if len(blocks) == 1:
        return _applied(rows, spark.sparkContext.broadcast(model), rest.index(text), label, prob)
    own = ["__label", "__top", "__total"]
    rows = rows.select("*", F.lit("").alias(own[0]), F.lit(float("-inf")).alias(own[1]), F.lit(float("-inf")).alias(own[2]))
    for i, block in enumerate(blocks):
        if i:
            rows = stored(spark, rows, "languages")
        rows = _merged(rows, spark.sparkContext.broadcast(block), rest.index(text))
    share = F.when(F.col(own[0]) == "", 0.0).otherwise(F.exp(F.col(own[1]) - F.col(own[2])))
    return rows.select(*rest, F.col(own[0]).alias(label), share.alias(prob))


def _applied(rows: DataFrame, shared, at: int, label: str, prob: str) -> DataFrame:
    def run(batches):
        for b in batches:
            labels, probs = shared.value.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(labels, pa.string()), pa.array(probs, pa.float64())], [*b.schema.names, label, prob])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(label, StringType()), StructField(prob, DoubleType())]))


def _merged(rows: DataFrame, shared, at: int) -> DataFrame:
    """``rows`` whose last three columns (label, top, total) also know the languages of one block."""

    def run(batches):
        for b in batches:
            model = shared.value
            best, top, total = model.best(b.column(at).to_pylist())
            names, old, sums = b.column(b.num_columns - 3).to_pylist(), b.column(b.num_columns - 2).to_numpy(), b.column(b.num_columns - 1).to_numpy()
            better = top > old  # the first of equals stays, as blocks are in order of language
            names = [model.languages[i] if x else n for i, x, n in zip(best, better, names)]
            new = [pa.array(names, pa.string()), pa.array(np.maximum(top, old)), pa.array(np.logaddexp(total, sums))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-3], *new], b.schema.names)

    return rows.mapInArrow(run, StructType([StructField(f.name, f.dataType, True) for f in rows.schema.fields]))


def accuracy(docs: DataFrame, model, language: str = "lang") -> DataFrame:
    """(lang, n, right): how many texts of each language there are, and of how many the model says so."""
    told = identified(docs.select("text", F.col(language).alias("__true")), model)
    return told.groupBy(F.col("__true").alias("lang")).agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("__true")).alias("right"))
