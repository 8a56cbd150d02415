"""Line dedup over overlapping three-line windows (operator 10), DataFrame functions only.

The non-blank lines of a text form overlapping windows of three. A window is hashed to 128 bits; of
all its occurrences, ordered by (doc_id, text hash, position), the first stays and every other marks
its three lines. Marked positions of a text are merged and those lines removed; blank lines stay.

Plan: one scan hashes lines and emits windows (hashes, no text); a partial aggregate finds repeated
windows, which are stored; the windows then meet only the repeated ones in an equi-join whose sides
are plain exchanges, so AQE splits a window that a third of all rows share; marked positions are
gathered per text (bounded by its own lines) and joined to the texts. Both joins are always sort-merge
joins, so the plan is the same at every size and nothing that grows is broadcast.

Cases: a null text stays null, an empty one stays empty; texts of fewer than three non-blank lines
are never changed; rows that repeat an id and a text are one occurrence and get the same result; a
null doc_id sorts first; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import OWN, stored

WIDTH = 3


def _identity():
    """A text and its id as a key of 128 bits; equal for repeated rows only."""
    return F.struct(*(F.xxhash64(F.lit(s), F.col("doc_id"), F.col("text")).alias(c) for s, c in ((11, "p"), (23, "q"))))


def _lines():
    """(position, hash, second hash) of each line that holds a word."""
    line = lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(29), x).alias("b"), x.rlike("[^\\x20\\x09-\\x0D]").alias("w"))
    return F.filter(F.transform(F.split("text", "\n", -1), line), lambda s: s["w"])


def window_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key, position of the window among the non-blank lines, two hashes, line positions."""
    lines = docs.filter(F.col("text").contains("\n")).select("doc_id", _identity().alias("key"), _lines().alias("lines")).filter(F.size("lines") >= WIDTH)
    at = lambda i, k: F.get("lines", i + k)
    window = lambda i: F.struct(
        i.cast("int").alias("at"),
        F.xxhash64(*(at(i, k)["a"] for k in range(WIDTH))).alias("a"),
        F.xxhash64(*(at(i, k)["b"] for k in range(WIDTH))).alias("b"),
        F.array(*(at(i, k)["i"] for k in range(WIDTH))).alias("covers"),
    )
    return lines.select("doc_id", "key", F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - WIDTH), window)).alias("w")).select("doc_id", "key", "w.*")


def dedup_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with later repeats removed from text, and OWN+removed: how many lines went."""
    seen = window_rows(docs)
    place = F.struct("doc_id", "key", "at")
    repeated = seen.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeated = stored(spark, repeated.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "first"), "windows")
    later = seen.join(repeated.hint("merge"), (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb"))).filter(~place.eqNullSafe(F.col("first")))
    marks = later.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_set("covers"))).alias(OWN + "marks"))
    marks = stored(spark, marks.withColumnRenamed("key", OWN + "mark_key"), "marks")
    joined = docs.withColumn(OWN + "key", _identity()).join(marks.hint("merge"), F.col(OWN + "key") == F.col(OWN + "mark_key"), "left")
    # the kept positions by a hash set, so a text of very many removed lines costs no more than its length;
    # the lines are used twice, which keeps their split out of the function over positions
    marked, lines = F.col(OWN + "marks"), F.col(OWN + "lines")
    joined = joined.withColumn(OWN + "lines", F.when(marked.isNotNull(), F.split("text", "\n", -1)))
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), marked)
    text = F.when(marked.isNull(), F.col("text")).otherwise(F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n"))
    removed = F.when(marked.isNull(), 0).otherwise(F.size(marked))
    return joined.select(*(text.alias(c) if c == "text" else F.col(c) for c in docs.columns), removed.cast("long").alias(OWN + "removed"))
