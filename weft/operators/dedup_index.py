"""Near-duplicates of a corpus that grows: what earlier increments kept is met by its buckets, not by its texts.

An index is two tables below one URI, with a folder for each increment: ``digests`` of the canonical texts that were seen
and ``buckets`` of the rows that were kept. An increment is decided as if its rows came after all earlier ones, in order
of doc_id: a text seen before is dropped, else a row that shares a bucket with an earlier kept row is dropped,
without verification. So increments give what one run over all of them gives, and an increment's plan scans its own
texts and the two narrow tables. An increment that is added again under its name replaces what it gave before, so
a run that was broken off can be repeated; only its own folders are written.

Cases: rows without id are left out; rows that repeat an id count as one; a text without words is told by its digest
only; an empty increment adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft import uris
from weft.functions import text as X
from weft.operators.clean import first_of_each
from weft.operators.similarity import bucket_key, dropped_by_bucket, minhash_bands
from weft.storage import shared_dir, stored

TABLES = {"digests": "digest string, increment string", "buckets": "key long, increment string"}


@dataclass
class DedupIndex:
    spark: SparkSession
    uri: str

    def __post_init__(self):
        if not self.uri.startswith(f"{shared_dir(self.spark)}/"):
            self.uri = uris.located(self.spark, self.uri)

    def _folder(self, table: str, increment: str) -> str:
        return uris.join(self.uri, table, f"increment={increment}")

    def table(self, name: str, without: str | None = None) -> DataFrame:
        """A table of the index, without one increment; empty before the first one."""
        try:
            rows = self.spark.read.schema(TABLES[name]).parquet(uris.join(self.uri, name))
        except AnalysisException as gone:
            if gone.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], TABLES[name])
        return rows if without is None else rows.filter(F.col("increment") != without)

    def add(self, docs: DataFrame, increment: str) -> DataFrame:
        """(doc_id, why): each id of the increment, and null, duplicate or near_duplicate. The index has it afterwards."""
        if not increment or not all(c.isalnum() or c in "-_." for c in increment):
            raise ValueError("an increment is named by letters, digits, and -_.")
        spark, docs = self.spark, docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
        digest = F.sha1(X.canonical(F.coalesce("text", F.lit(""))))
        rows = stored(spark, docs.select("doc_id", digest.alias("digest")), "digests")
        # the narrow side of the new rows goes to the index; Spark broadcasts it if it is small enough
        seen = self.table("digests", increment).join(rows.select("digest").distinct(), "digest", "left_semi").select("digest").distinct()
        first = first_of_each(rows, ["digest"]).join(seen, "digest", "left_anti").select("doc_id")
        first = stored(spark, first, "first")
        bands = minhash_bands(docs.select("doc_id", "text")).select("doc_id", bucket_key(F.col("band"), F.col("bucket")).alias("key"))
        members = stored(spark, bands.join(first, "doc_id", "left_semi"), "bands")
        taken = self.table("buckets", increment).join(members.select("key").distinct(), "key", "left_semi").select("key").distinct()
        old = stored(spark, members.join(taken, "key", "left_semi").select("doc_id").distinct(), "near")
        left = members.join(old.hint("merge"), "doc_id", "left_anti")
        new = dropped_by_bucket(spark, left)
        near = stored(spark, old.union(new), "near")
        kept = members.join(near.hint("merge"), "doc_id", "left_anti").select("key").distinct()
        rows.select("digest").distinct().write.mode("overwrite").parquet(self._folder("digests", increment))
        kept.write.mode("overwrite").parquet(self._folder("buckets", increment))
        told = rows.select("doc_id").join(first.withColumn("one", F.lit(True)), "doc_id", "left").join(near.withColumn("near", F.lit(True)), "doc_id", "left")
        return told.select("doc_id", F.when(F.col("one").isNull(), "duplicate").when(F.col("near"), "near_duplicate").alias("why"))

    def forget(self, increment: str) -> None:
        """What an increment gave goes; texts like its own can be kept again."""
        for name, schema in TABLES.items():
            self.spark.createDataFrame([], schema).drop("increment").write.mode("overwrite").parquet(self._folder(name, increment))
