"""The cleaning plan end to end: documents in, shards and a data card out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weft.functions import text as X
from weft.operators import clean, similarity
from weft.sources.files import write_shards
from weft.storage import stored


def clean_corpus(spark: SparkSession, docs: DataFrame, out: str, near: bool = False, exact: bool = True, scrub: bool = True, **options) -> dict:
    """Writes the kept documents to ``out`` and returns the data card with counts by source.

    ``options`` are those of ``clean.judged``: with ``language`` and a ``model`` of language identification, texts of
    other languages are dropped. ``exact`` drops later equal canonical texts, ``near`` also those similar to an earlier kept one, and
    ``scrub`` replaces personal data; counts of tokens and characters are of what is written.
    """
    rows = clean.judged(docs, **options)
    if exact or near:
        rows = clean.with_duplicates(spark, rows, ["doc_id", "text", "source"])
    else:
        rows = stored(spark, rows.select("doc_id", "text", "source", "reason"), "decided")
    if near:
        gone = similarity.near_drops(spark, similarity.word_sets(rows.filter("reason is null")))
        rows = clean.flagged(spark, rows, gone, "gone").withColumn("reason", F.coalesce("reason", F.when(F.col("gone"), F.lit("duplicate")))).drop("gone")
    # what the card says is observed while the shards are written, which is the one scan of texts
    decided, written = Observation(), Observation()
    seen = rows.observe(decided, F.count("*").alias("docs_in"), *(F.count_if(F.col("reason") == r).alias(r) for r in clean.REASONS))
    kept = seen.filter("reason is null")
    kept = clean.scrubbed(kept) if scrub else kept.withColumns({c: F.lit(0) for c in ("n_email", "n_url", "n_num")})
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    kept = kept.observe(
        written,
        F.count("*").alias("docs_out"),
        total(F.size(X.blank_words(F.col("text")))).alias("tokens_out"),
        total(F.length("text")).alias("chars_out"),
        total(F.col("n_email") + F.col("n_url") + F.col("n_num")).alias("pii_redactions"),
    )
    write_shards(kept.select("text", "source", F.create_map(F.lit("doc_id"), F.col("doc_id").cast("string")).alias("meta")), out)
    by_source = rows.filter("reason is null").groupBy("source").count().collect()  # a row for each source; reads no text
    ins, outs = decided.get, written.get
    return {"docs_in": ins.pop("docs_in")} | outs | ins | {"per_source": {r["source"]: r["count"] for r in by_source}}
