"""Cleaning as a stream (an extension): the batch rules, with state only for digests already seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.functions import text as X
from weft.operators.clean import judged, scrubbed


def clean_stream(docs: DataFrame, event_time: str | None = None, delay: str = "1 hour", **options) -> DataFrame:
    """Kept and scrubbed documents of a stream; of equal canonical texts the first to arrive stays.

    With ``event_time`` digests are forgotten after the watermark, which bounds the state; without it
    every digest is kept.
    """
    rows = judged(docs, **options).filter("reason is null").withColumn("digest", F.sha1(X.canonical(F.col("text"))))
    if event_time:
        rows = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["digest"])
    else:
        rows = rows.dropDuplicates(["digest"])
    return scrubbed(rows)
