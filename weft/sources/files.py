"""Document sources over files, and sharded sinks. All reads declare their schema.

Cases: blank texts and lines are no documents; a field that a line lacks is empty; a page without visible text is
no document; a PDF file that can't be read is a row with an error; files are taken in order of path. PDF pages are
a document each and need the pypdf library.
"""

from __future__ import annotations

from html.parser import HTMLParser
from importlib.util import find_spec

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.sources.needs import need

DOCUMENT = "text string, source string, meta map<string,string>"
#: File endings of each reader; other files are left out.
KINDS = {"text": ("txt", "md"), "json": ("jsonl", "jsonl.gz"), "html": ("html", "htm"), "pdf": ("pdf",)}
DOCS_PER_SHARD = 50_000

_SKIPPED = {"script", "style", "nav", "header", "footer", "aside", "form", "noscript", "template", "svg", "head"}
_BLOCKS = {"p", "div", "br", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "article", "section", "blockquote", "pre", "td", "ul", "ol", "table"}
#: Hidden elements that break no line.
_INLINE = {"script", "style", "noscript", "template", "svg"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden: list[str] = []
        self.kept = 0  # how many elements around keep their line breaks

    def handle_starttag(self, tag, attrs):
        classes = dict(attrs).get("class") or ""
        if tag not in _VOID and (self.hidden or tag in _SKIPPED or {"ad", "ads", "advert", "sidebar"} & set(classes.split())):
            if not self.hidden and tag not in _INLINE:
                self.parts.append("\n")
            self.hidden.append(tag)
        elif tag in _BLOCKS:
            self.parts.append("\n")
            self.kept += tag == "pre"

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
        elif tag in _BLOCKS:
            self.parts.append("\n")
            self.kept = max(0, self.kept - (tag == "pre"))

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data if self.kept else data.replace("\n", " "))


def main_text(html: str | None) -> str:
    """Visible text of the main part of a page, a line for each block; empty if there is none, the markup if it can't be parsed."""
    p = _Text()
    try:
        p.feed(html or "")
        p.close()
    except AssertionError:  # the parser says so of declarations that it can't read
        return html or ""
    lines = [" ".join(x.split()) for x in "".join(p.parts).split("\n")]
    return "\n".join(x for x in lines if x)


def extract(html: Column) -> Column:
    """``main_text`` as a column, by an Arrow UDF."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(main_text)

    return run(html)


def pdf_pages(data: bytes) -> list[str]:
    """The text of each page."""
    import io

    return [page.extract_text() or "" for page in need("pypdf").PdfReader(io.BytesIO(data)).pages]


def read_pdf(spark: SparkSession, path: str | list[str], pages=pdf_pages) -> DataFrame:
    """(path, line, text, error) of PDF files: a row for each page with a text, numbered in line, or one with an error.

    ``pages`` gives the texts of a file's pages (or one text of it all) from its bytes.
    """
    from weft.functions.tables import with_pages

    def listed(data: bytes) -> list[str]:
        found = pages(data)
        return [found] if isinstance(found, str) else found

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(path)
    rows = with_pages(spark, files, listed)
    return rows.select("path", F.coalesce("page", F.lit(0)).cast("long").alias("line"), F.coalesce("text", F.lit("")).alias("text"), "error")


def _some(spark: SparkSession, path: str | list[str], endings: tuple[str, ...]):
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(endings) + "}")
    return reader, path


def read_local(spark: SparkSession, path: str | list[str], max_docs: int | None = None, text_field: str = "text", pdf: bool | None = None) -> DataFrame:
    """Documents of a file or folder: text and Markdown files are one each, JSON lines one a line, pages their main
    text, PDF pages one each (``pdf``; if not said, where pypdf is installed). Blank texts are left out; meta.path names the file. With ``max_docs`` the first in order of path."""
    if not path:
        raise ValueError("a local source needs a path")
    place = F.col("_metadata.file_path").alias("path")
    reader, at = _some(spark, path, KINDS["text"] + KINDS["html"])
    raw = reader.option("wholetext", "true").text(at).select(place, F.col("value").alias("t"))
    page = F.col("path").rlike("(?i)\\.html?$")
    whole = raw.withColumn("text", F.when(page, extract(F.col("t"))).otherwise(F.col("t"))).select("path", F.lit(0).cast("long").alias("line"), "text")
    reader, at = _some(spark, path, KINDS["json"])
    lines = reader.schema(f"`{text_field}` string").json(at).select(place, F.monotonically_increasing_id().alias("line"), F.coalesce(F.col(text_field), F.lit("")).alias("text"))
    rows = whole.unionByName(lines).withColumn("error", F.lit(None).cast("string"))
    if find_spec("pypdf") is not None if pdf is None else pdf:
        rows = rows.unionByName(read_pdf(spark, path))
    rows = rows.filter((F.regexp_replace("text", "(?U)\\s+", "") != "") | F.col("error").isNotNull())
    if max_docs is not None:
        rows = rows.orderBy("path", "line").limit(max_docs)
    return rows.select("text", F.lit("local").alias("source"), F.create_map(F.lit("path"), "path").alias("meta"), "path", "line", "error")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """A corpus written by ``write_shards``; absent fields get their empty values."""
    rows = spark.read.schema(DOCUMENT).option("pathGlobFilter", "*.{jsonl,json,gz}").json(path)
    empty = F.create_map().cast("map<string,string>")
    return rows.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("meta", empty).alias("meta"))


def write_shards(docs: DataFrame, path: str, docs_per_shard: int = DOCS_PER_SHARD, mode: str = "overwrite") -> None:
    """Gzip JSON lines with at most ``docs_per_shard`` rows a file."""
    docs.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", docs_per_shard).json(path)


def moses_pairs(src: DataFrame, tgt: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Positional pairs of two line tables (line, text; ``by`` names more keys); the shorter ends both, pairs with a blank side go."""
    by = by or ["line"]
    met = src.select(*by, F.trim("text").alias("src")).join(tgt.select(*by, F.trim("text").alias("tgt")), by)
    return met.filter("src <> '' and tgt <> ''")


def smol_target(trg: str = "trg", trgs: str = "trgs"):
    """The target text: trg, else the first of trgs, else empty."""
    return F.coalesce(F.nullif(F.col(trg), F.lit("")), F.get(F.col(trgs), F.lit(0)), F.lit(""))
