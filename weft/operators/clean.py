"""Corpus cleaning: drop reasons, exact duplicates, personal data, budgets and counts.

Documents need doc_id (their order), text, source and lang. Drop reasons are settled before any shuffle, and exact
duplicates are told by digests and ids, so texts stay where they were read.

Cases: a null text is normalized to the empty one and dropped as such; ids must differ and not be null where
duplicates are told (``with_duplicates`` meets them by id: of rows that repeat an id all have its fate, and a row
without id is never the first of its text); running totals give rows of equal order one after the other, nulls
first; empty tables give empty results and a card of zeros; columns of other names pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from weft.functions import text as X
from weft.functions.langid import identified
from weft.storage import bounded_batches, nullable, stored

#: So many ids, 16 MB of them, are broadcast at most.
BROADCAST_IDS = 2_000_000
REASONS = ("empty_after_normalize", "wrong_language", "too_short_chars", "too_few_words", "symbol_heavy", "repetitive", "low_quality", "duplicate")


def normalized(docs: DataFrame, **rules) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.withColumn("text", X.normalize(F.col("text"), **rules))


def features(docs: DataFrame) -> DataFrame:
    """n_chars, n_words, symbol_ratio, repetition and score of normalized texts."""
    t = F.col("text")
    out = docs.withColumns({"n_chars": F.length(t).cast("long"), "n_words": X.words(t), "symbol_ratio": X.symbol_ratio(t), "repetition": X.repetition_ratio(t)})
    return out.withColumn("score", X.quality_score(F.col("symbol_ratio"), F.col("repetition")))


def reason(min_quality: float = X.MIN_QUALITY, language: str | None = None, min_prob: float = 0.5) -> Column:
    """The first failing rule over ``features``, null if none; with ``language`` over columns lang and prob too."""
    c = F.col
    out = F.when(c("text") == "", REASONS[0])
    if language:
        out = out.when((c("lang") != "") & (c("lang") != language) & (c("prob") >= min_prob), REASONS[1])
    tests = [c("n_chars") < X.MIN_CHARS, c("n_words") < X.MIN_WORDS, c("symbol_ratio") > X.MAX_SYMBOLS, c("repetition") > X.MAX_REPETITION, c("score") < min_quality]
    for test, name in zip(tests, REASONS[2:]):
        out = out.when(test, name)
    return out


def judged(docs: DataFrame, min_quality: float = X.MIN_QUALITY, language: str | None = None, min_prob: float = 0.5, model=None, **rules) -> DataFrame:
    """Normalized documents with features and reason, exact duplicates not yet told.

    With ``language`` rows of another one (lang, of probability prob or more) are dropped; a ``model`` tells both
    from the normalized text, else they are columns of ``docs``.
    """
    rows = normalized(docs, **rules)
    rows = identified(rows, model) if model is not None else rows
    return features(rows).withColumn("reason", reason(min_quality, language, min_prob))


def first_of_each(rows: DataFrame, keys: list[str], order: str = "doc_id") -> DataFrame:
    """The first ``order`` of each key: an aggregate with map-side combining, so a hot key is many partial minima."""
    return rows.groupBy(*keys).agg(F.min(order).alias(order))


def flagged(spark: SparkSession, rows: DataFrame, ids: DataFrame, flag: str, most: int = BROADCAST_IDS) -> DataFrame:
    """``rows`` with a boolean column that says whether their doc_id is among ``ids`` (doc_id).

    Up to ``most`` ids are broadcast, so that rows and their texts stay where they are; more meet them in a merge join.
    """
    ids = stored(spark, ids.select("doc_id").distinct(), "ids")
    few = ids.limit(most + 1).count() <= most
    named = ids.select(F.col("doc_id").alias("__id"))
    met = rows.join(F.broadcast(named) if few else named.hint("merge"), F.col("doc_id") == F.col("__id"), "left")
    return met.withColumn(flag, F.col("__id").isNotNull()).drop("__id")


def with_duplicates(spark: SparkSession, docs: DataFrame, keep: list[str] | None = None, most: int = BROADCAST_IDS) -> DataFrame:
    """``judged`` documents whose later equal canonical texts get the reason duplicate.

    Only texts that passed all rules take part. The columns in ``keep`` (all, if None), the reason and the
    digest are stored once, so no rule is computed twice. A partial aggregate over digests finds those of several rows
    and their first ids; their rows meet them as (doc_id, digest), and the ids of later copies flag the stored rows. A text
    that a third of all rows share never gathers in one task, and texts are never shuffled unless the later
    copies are too many to broadcast.
    """
    keep = keep or [c for c in docs.columns if c != "reason"]
    digested = docs.withColumn("digest", F.when(F.col("reason").isNull(), F.sha1(X.canonical(F.col("text")))))
    digested = stored(spark, digested.select(*keep, "reason", "digest"), "judged")
    mine = digested.filter("digest is not null").select("doc_id", "digest")
    several = mine.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("digest", "first_id")
    # a row without id is never the first of its text, and has no id by which it could be flagged
    later = mine.join(several, "digest").filter("doc_id <> first_id").select("doc_id")
    met = flagged(spark, digested, later, "__again", most)
    again = F.col("__again") | (F.col("digest").isNotNull() & F.col("doc_id").isNull())
    return met.withColumn("reason", F.when(again, F.lit("duplicate")).otherwise(F.col("reason"))).drop("__again", "digest")


def cleaned(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Documents kept by all rules and exact dedup, before personal data is replaced."""
    return with_duplicates(spark, judged(docs, **options)).filter("reason is null")


def scrubbed(docs: DataFrame) -> DataFrame:
    text, n_email, n_url, n_num = X.scrub(F.col("text"))
    return docs.withColumns({"n_email": n_email, "n_url": n_url, "n_num": n_num, "text": text})


def data_card(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row: documents in and out, tokens and characters after scrubbing, replacements and drops by reason."""
    # measured in the one scan of texts, for those that pass the rules; sums then take what dedup leaves
    passed = F.col("reason").isNull()
    text, n_email, n_url, n_num = X.scrub(F.col("text"))
    measures = {"tokens": F.size(X.blank_words(text)), "chars": F.length(text), "pii": n_email + n_url + n_num}
    rows = judged(docs, **options).withColumns({c: F.when(passed, m) for c, m in measures.items()})
    rows = with_duplicates(spark, rows, ["doc_id", *measures])
    kept = F.col("reason").isNull()
    total = lambda c: F.coalesce(F.sum(F.when(kept, F.col(c))), F.lit(0)).cast("long")
    drops = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return rows.agg(
        F.count("*").alias("docs_in"),
        F.count_if(kept).alias("docs_out"),
        total("tokens").alias("tokens_out"),
        total("chars").alias("chars_out"),
        total("pii").alias("pii_redactions"),
        *drops,
    )


def running_total(spark: SparkSession, rows: DataFrame, order: str, value: str | list[str], out: str | list[str] = "before") -> DataFrame:
    """``rows`` with the sum of ``value`` over all earlier rows, without one task that sees all rows.

    Rows are range-partitioned by ``order``, summed up in order within their partition while they are stored, and sums of
    partitions (one row each) give offsets: rows are shuffled once. Several values share this.
    """
    values, outs = ([x] if isinstance(x, str) else x for x in (value, out))
    bounded_batches(spark)
    given = rows.withColumns({f"__value{i}": F.coalesce(F.col(v).cast("long"), F.lit(0)) for i, v in enumerate(values)})
    n = len(values)

    def run(batches):
        part, sums = TaskContext.get().partitionId(), [0] * n
        for b in batches:
            new = []
            for i in range(n):
                own = b.column(b.num_columns - n + i).to_numpy()
                ends = sums[i] + np.cumsum(own)
                new.append(pa.array(ends - own))
                sums[i] = int(ends[-1]) if len(ends) else sums[i]
            ids = pa.array(np.full(b.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, *new, ids], schema.names)

    schema = StructType([*nullable(given.schema).fields, *(StructField(f"__before{i}", LongType()) for i in range(n)), StructField("__part", IntegerType())])
    parts = stored(spark, given.repartitionByRange(F.col(order)).sortWithinPartitions(order).mapInArrow(run, schema), "ranges")
    sums = parts.groupBy("__part").agg(*(F.sum(f"__value{i}").alias(f"__sum{i}") for i in range(n)))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__part", *(F.coalesce(F.sum(f"__sum{i}").over(earlier), F.lit(0)).alias(f"__offset{i}") for i in range(n)))
    # one row for each partition: bounded by their number
    met = parts.join(F.broadcast(offsets), "__part")
    totals = {o: F.col(f"__before{i}") + F.col(f"__offset{i}") for i, o in enumerate(outs)}
    return met.withColumns(totals).drop("__part", *(f"__{x}{i}" for i in range(n) for x in ("value", "before", "offset")))


def byte_budget(spark: SparkSession, docs: DataFrame, most_bytes: int) -> DataFrame:
    """Rows in order until the budget is crossed; the crossing row stays. 0: no limit."""
    sized = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    if not most_bytes:
        return sized
    return running_total(spark, sized, "doc_id", "n_bytes").filter(F.col("before") < most_bytes).drop("before")


def first_per_source(docs: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each source (Catalyst cuts each partition to as many before it shuffles)."""
    n = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    return docs.withColumn("__n", n).filter(F.col("__n") <= most).drop("__n")
