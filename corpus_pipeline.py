"""Training-data pipeline: STAGES in order, each written as Parquet and read again as the next one's docs.

Cases, beside those that the operators state: every stage takes an empty table and gives an empty one, and all but
the last keep all columns whatever their names.
quality_rules: null, empty and short texts fail the base rule and go; repeated rows share their fate; without
labels of both kinds only the base rule decides.
line_dedup: null texts stay null, a text may become empty; repeated rows stay equal.
near_dedup: exactly one row of each class stays, so repeated rows go; texts without id are told apart by text.
mix_sources: no row goes; a null source is a source of its own; ties are settled by hash and id.
sentencepiece: a null text has null ids; repeated rows are encoded each, at places of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import linededup, mixing, neardup, quality, tokens
from weft.llm.common import OWN, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(spark, docs).drop(OWN + "removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with source, slot and position in the mix: those of the mixing stage, which keeps the docs' columns."""
    places = [F.col(OWN + c).alias(c) for c in ("slot", "position")]
    placed = mixing.scheduled(spark, docs.select("doc_id", "source", "text")).select(F.struct("doc_id", "source", *places).alias("doc_id"), "text")
    rows = tokens.encoded(spark, stored(spark, placed, "placed"))
    return rows.select("doc_id.doc_id", "doc_id.source", "n_tokens", "token_ids", "round_trip", "doc_id.slot", "doc_id.position")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("sentencepiece", encode)]
#: Trees, sketches and schedules can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    # a scan packs files by size, so the mixed order is made again
    return docs.sort("position")
