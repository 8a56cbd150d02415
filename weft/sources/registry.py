"""Connectors by name. Network connectors state what they would read and refuse to run without a fetcher.

A ``rows`` connector takes ``fetch(spark, **coordinates)`` and gives the rows of a data set; a ``get`` connector
takes ``fetch(url, params, headers)`` and gives (status, bytes), called in tasks. ``fetch.names(path)`` may list
what a data set holds (configurations, files); without it they are taken as given in params.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.sources import planned, remote
from weft.sources.files import KINDS, read_local
from weft.sources.needs import SourceUnavailable, need  # noqa: F401


@dataclass(frozen=True)
class Connector:
    name: str
    kind: str = "mono"
    gated: bool = False
    #: How it reads: a file system path, rows of a data set, or requests.
    by: str = "rows"

    def documents(self, spark: SparkSession, params: dict, max_docs: int | None = None, token: str | None = None, fetch: Callable | None = None) -> DataFrame:
        """Documents of the source, the first ``max_docs`` if given; ``fetch`` stands in for the network."""
        docs = self._read(spark, params, max_docs, token, fetch)
        return docs.filter("error is null").drop("error") if "error" in docs.columns else docs

    def parts(self, spark: SparkSession, params: dict, max_docs: int | None = None, token: str | None = None, fetch: Callable | None = None, wanted: int | None = None) -> Iterator[DataFrame]:
        """The same documents part by part, in order; rows with an error instead of a text say what failed.

        With ``wanted`` bytes of text, files are read in waves: send each part's bytes of text back to the iterator,
        and no part begins once they are enough. Sources that list no files are one part.
        """
        if wanted is not None and max_docs is None and self.by == "path" and params.get("path"):
            waves = planned.Waves(planned.listed(spark, params["path"], tuple(e for kind in KINDS.values() for e in kind)), wanted)
            for paths in waves:
                waves.gave((yield read_local(spark, [planned.literal(p) for p in paths], None, params.get("text_field", "text"))) or 0)
            return
        files = self._files(params, fetch) if wanted is not None and max_docs is None else None
        if files is None:
            yield self._read(spark, params, max_docs, token, fetch)
            return
        had, at, n = 0, 0, 1
        while at < len(files) and had < wanted:
            had += (yield self._read(spark, params, None, token, fetch, files[at : at + n])) or 0
            at, n = at + n, 2 * n

    def _files(self, params: dict, fetch) -> list[str] | None:
        names = getattr(fetch, "names", None)
        if self.name != "madlad400" or not names:
            return None
        return remote.chosen_shards(names(remote.coordinates(self.name, params)["path"]), params.get("variant", "clean"))

    def _read(self, spark: SparkSession, params: dict, max_docs: int | None, token: str | None, fetch: Callable | None, files: list[str] | None = None) -> DataFrame:
        if self.by == "path":
            return read_local(spark, params.get("path"), max_docs, params.get("text_field", "text"))
        if self.by == "rows":
            where = remote.coordinates(self.name, params)
        if self.gated and not token:
            raise PermissionError(f"{self.name} is gated: a token is needed")
        if fetch is None:
            raise SourceUnavailable(f"{self.name} is read over the network; pass fetch=")
        if self.name == "commoncrawl":
            return remote.crawl_documents(spark, fetch, params, max_docs)
        if self.name == "opus":
            return remote.opus_documents(spark, fetch, params, max_docs)
        files = files or self._files(params, fetch)
        if files is not None:
            where["files"] = files
        if self.name == "smol":
            names = getattr(fetch, "names", None)
            known = names(where["path"]) if names else [params["config"]] if params.get("config") else []
            where["name"] = remote.smol_config(known, params.get("variant", "gatitos"), params.get("src", "en"), params["tgt"])
        rows = remote.asked(fetch, spark, self.name, where)
        docs = remote.smol_documents(rows, params) if self.name == "smol" else remote.hub_documents(rows, self.name, params)
        if max_docs is None:
            return docs
        # the first in the order of the stream, the same on every run
        return docs.withColumn("__at", F.monotonically_increasing_id()).orderBy("__at").limit(max_docs).drop("__at")

    def provenance(self, params: dict) -> dict:
        return {"source": self.name, "license": params.get("license"), "url": params.get("url")}


CONNECTORS = {
    c.name: c
    for c in (
        Connector("local", by="path"),
        Connector("wikipedia"),
        Connector("glot500"),
        Connector("culturax", gated=True),
        Connector("oscar", gated=True),
        Connector("fineweb2"),
        Connector("madlad400"),
        Connector("commoncrawl", by="get"),
        Connector("opus", kind="parallel", by="get"),
        Connector("smol", kind="parallel"),
        Connector("flores", kind="parallel", gated=True),
    )
}


def connector(name: str) -> Connector:
    if name not in CONNECTORS:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(sorted(CONNECTORS))}")
    return CONNECTORS[name]
