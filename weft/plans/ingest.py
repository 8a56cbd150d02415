"""Ingest: sources one after the other, each written as it is read, until the byte budget is full.

A source is stored part by part before anything else is done with it, so an error while it is planned or while its
tasks run ends that source alone; what its parts gave before stays, and the error stands in its provenance. Parts are
asked for only while the budget has room, and a full budget ends all later sources, parallel ones too. Counts
are observed on the writes, so nothing is read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weft import uris
from weft.log import logger
from weft.operators import clean
from weft.plans.profiles import Source
from weft.sources.files import write_shards
from weft.sources.registry import CONNECTORS, Connector, SourceUnavailable
from weft.storage import stored

#: Where documents of each kind go.
FOLDERS = {"mono": "corpus", "parallel": "parallel"}
#: What a note says before the reason, by the kind of error.
SKIPS = ((PermissionError, "gated"), (SourceUnavailable, "not available"), (Exception, "failed"))


@dataclass
class Ingest:
    """Writes the documents of sources below ``out``; ``most_bytes`` of monolingual text are enough."""

    spark: SparkSession
    out: str
    most_bytes: int | None = None
    most_docs: int | None = None
    token: str | None = None
    fetch: dict[str, Callable[..., DataFrame]] = field(default_factory=dict)

    def __post_init__(self):
        self.docs, self.bytes = dict.fromkeys(FOLDERS, 0), dict.fromkeys(FOLDERS, 0)
        self.per_source: dict[str, dict] = {}
        self.skipped: dict[str, str] = {}
        self.full = False

    def run(self, sources: list[Source]) -> list[dict]:
        """A record of provenance for each source that is known, with n_docs and notes; a full budget ends the list."""
        records = []
        for folder in FOLDERS.values():
            uris.delete(uris.join(self.out, folder))  # of an earlier run
        for i, source in enumerate(sources):
            reader = CONNECTORS.get(source.connector)
            if reader is None:
                self.skipped[source.connector] = "unknown connector"
                continue
            # a source that fails is still named with its licence
            record = reader.provenance(source.params) | {"n_docs": 0, "notes": None}
            records.append(record)
            try:
                self._source(i, source, reader, record)
            except Exception as why:
                said = next(word for kind, word in SKIPS if isinstance(why, kind))
                self._note(record, f"{said}: {type(why).__name__}: {_first_line(why)}")
            if self.full:
                break
        return records

    def _note(self, record: dict, why: str) -> None:
        record["notes"] = "; ".join(filter(None, [record["notes"], why]))
        self.skipped[record["source"]] = record["notes"]
        logger("ingest").warning("%s: %s", record["source"], why)

    def _left(self, kind: str) -> int | None:
        return self.most_bytes - self.bytes["mono"] if self.most_bytes and kind == "mono" else None

    def _source(self, i: int, source: Source, reader: Connector, record: dict) -> None:
        params = {k: v for k, v in source.params.items() if k not in ("license", "url")}
        parts = reader.parts(self.spark, params, self.most_docs, self.token, self.fetch.get(source.connector), self._left(reader.kind))
        try:
            part = next(parts, None)
            while part is not None and not self.full:
                read = self._part(i, reader.kind, part, record)
                part = None if self.full else parts.send(read)
        except StopIteration:
            pass

    def _part(self, i: int, kind: str, part: DataFrame, record: dict) -> int:
        """Stores a part, then writes what of it fits; gives the bytes of text that it had."""
        read = Observation()
        size = F.octet_length("text").cast("long")
        rows = placed(part, i).withColumn("n_bytes", size)
        seen = [F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("error").isNull()).alias("docs"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.max("error").alias("error")]
        rows = stored(self.spark, rows.observe(read, *seen), "source")
        if read.get["errors"]:
            self._note(record, f"{read.get['errors']} requests failed, such as {read.get['error']}")
        if not read.get["docs"]:
            return 0
        left = self._left(kind)
        rows = clean.running_total(self.spark, rows.filter("error is null").withColumn("one", F.lit(1)), "place", ["one", "n_bytes"], ["nth", "before"])
        if left is not None and read.get["bytes"] >= left:
            # the document that reaches the budget is the last
            rows, self.full = rows.filter(F.col("before") < left), True
        doc_id = (F.col("nth") + self.docs[kind]).cast("string")
        meta = F.map_concat(F.coalesce("meta", F.create_map().cast("map<string,string>")), F.create_map(F.lit("doc_id"), doc_id))
        written = Observation()
        docs = rows.observe(written, F.count("*").alias("docs"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes"))
        write_shards(docs.select("text", "source", meta.alias("meta")), uris.join(self.out, FOLDERS[kind]), mode="append")
        got = written.get
        self.docs[kind] += got["docs"]
        self.bytes[kind] += got["bytes"]
        record["n_docs"] += got["docs"]
        mine = self.per_source.setdefault(record["source"], {"docs": 0, "bytes": 0})
        mine["docs"] += got["docs"]
        mine["bytes"] += got["bytes"]
        return read.get["bytes"]


def placed(docs: DataFrame, i: int) -> DataFrame:
    """text, source, meta, error and the place of each document: source, then path and line where there are any."""
    path = F.col("path") if "path" in docs.columns else F.lit("")
    line = F.col("line") if "line" in docs.columns else F.monotonically_increasing_id()
    error = F.col("error") if "error" in docs.columns else F.lit(None).cast("string")
    return docs.select("text", "source", "meta", error.alias("error"), F.struct(F.lit(i).alias("source"), path.alias("path"), line.alias("line")).alias("place"))


def _first_line(why: Exception) -> str:
    lines = [x for x in str(why).strip().splitlines() if x.strip()]
    # of an error in a task the last line of its own trace says most
    own = [x.strip() for x in lines if _names_error(x)]
    return (own[-1] if own else lines[0] if lines else "")[:300]


def _names_error(line: str) -> bool:
    """Whether a line of a trace names an error: a dotted name that ends so, and a colon."""
    name, colon, _ = line.strip().partition(":")
    return bool(colon) and " " not in name and name.endswith(("Error", "Exception", "Unavailable"))
