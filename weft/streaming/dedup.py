"""Near-duplicates of streams: over all rows by a persistent index, or within a key by state that expires.

``index_stream`` hands every micro-batch to a ``DedupIndex`` as an increment named by its batch, so a batch that is run
again after a failure replaces itself, and the stream gives what one run over all its rows in order of arrival gives.

``near_dedup_stream`` keeps its state in Spark: each key (a source, say) has the digests and the buckets of the rows that it
kept, as map state with a time to live, so state is bounded by what arrives within that time; it is for keys of
bounded traffic. With a time to live by the clock Spark runs empty batches too, so such a query is stopped, it
doesn't end by itself. A row is dropped if its digest was seen, or if it shares a bucket with an earlier kept row of its key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.readwriter import DataStreamWriter

from weft.functions import text as X
from weft.operators.dedup_index import DedupIndex
from weft.operators.similarity import bucket_keys

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def index_stream(docs: DataFrame, index: DedupIndex, sink: Callable[[DataFrame, int], None], name: str = "stream") -> DataStreamWriter:
    """A writer that gives ``sink`` the kept rows of each batch of (doc_id, text, ...) and the number of the batch."""

    def batch(rows: DataFrame, number: int) -> None:
        why = index.add(rows.select("doc_id", "text"), f"{name}-{number:012d}").filter("why is null").select("doc_id")
        sink(rows.join(why, "doc_id", "left_semi").dropDuplicates(["doc_id"]), number)

    return docs.writeStream.foreachBatch(batch)


class _Kept(StatefulProcessor):
    def __init__(self, live_ms: int):
        self.live_ms = live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.digests = handle.getMapState("digests", "digest string", "n long", self.live_ms)
        self.buckets = handle.getMapState("buckets", "key long", "n long", self.live_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # as many rows as the key has in one batch, in the order in which they came
        batch = pd.concat(list(rows)).sort_values("doc_id", kind="stable")
        out = []
        for doc, digest, keys in zip(batch["doc_id"], batch["digest"], batch["keys"]):
            if self.digests.containsKey((digest,)):
                continue
            self.digests.updateValue((digest,), (1,))
            if any(self.buckets.containsKey((int(k),)) for k in keys):
                continue
            for k in keys:
                self.buckets.updateValue((int(k),), (1,))
            out.append(int(doc))
        yield pd.DataFrame({"key": pd.Series([key[0]] * len(out), dtype=object), "doc_id": pd.Series(out, dtype="int64")})

    def close(self) -> None:
        pass


def near_dedup_stream(docs: DataFrame, key: str = "source", live_ms: int = 86_400_000) -> DataFrame:
    """(key, doc_id) of the kept rows of a stream (doc_id, text, ``key``); the session must use the RocksDB state store."""
    docs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    digest = F.sha1(X.canonical(F.coalesce("text", F.lit(""))))
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), "doc_id", "text", digest.alias("digest"))
    rows = bucket_keys(rows, ["key", "digest"])
    return rows.groupBy("key").transformWithStateInPandas(_Kept(live_ms), outputStructType="key string, doc_id long", outputMode="Append", timeMode="ProcessingTime")
