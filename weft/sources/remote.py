"""What the network sources read and how their rows become documents.

Nothing here opens a connection: ``rows`` fetchers give the rows of a data set at the coordinates that a
source states, ``get`` fetchers answer (url, params, headers) with (status, bytes). Requests run in tasks,
one row each, so their answers never pass through the driver. Rows with an empty text are left out.
"""

from __future__ import annotations

import io
import json
import re
import time
import zipfile
from collections.abc import Callable, Iterable
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.sources.files import main_text, moses_pairs
from weft.sources.needs import SourceUnavailable
from weft.sources.records import first_payload
from weft.storage import stored

Get = Callable[[str, dict, dict], tuple[int, bytes]]
#: Where the data sets and services are.
WIKIPEDIA, GLOT500, CULTURAX = "wikimedia/wikipedia", "cis-lmu/Glot500", "uonlp/CulturaX"
OSCAR, FINEWEB2, FLORES, SMOL = "oscar-corpus/OSCAR-2301", "HuggingFaceFW/fineweb-2", "openlanguagedata/flores_plus", "google/smol"
MADLAD = "datasets/allenai/madlad-400/data/{lang}"
CRAWLS, CRAWL_INDEX, CRAWL_DATA = "https://index.commoncrawl.org/collinfo.json", "https://index.commoncrawl.org/{crawl}-index", "https://data.commoncrawl.org/"
OPUS = "https://opus.nlpl.eu/opusapi/"
SNAPSHOT = "20231101"
#: HTTP statuses that refuse access, and those of a server that may answer later.
REFUSED, BUSY = (401, 403), (408, 425, 429)
#: Seconds before each further try.
WAITS = (1, 2, 4, 8)
#: Lines of a text file that travel in one batch.
LINES = 10_000


def _one_of(params: dict, source: str, *names: str) -> str:
    for name in names:
        if params.get(name):
            return params[name]
    raise ValueError(f"{source} needs {' or '.join(names)}")


def coordinates(source: str, params: dict) -> dict:
    """Keyword arguments that name the rows of a hub data set."""
    if source == "wikipedia":
        return {"path": WIKIPEDIA, "name": f"{params.get('snapshot', SNAPSHOT)}.{_one_of(params, source, 'wiki')}", "split": "train"}
    if source == "glot500":
        return {"path": GLOT500, "name": _one_of(params, source, "glot", "lang_script"), "split": "train"}
    if source == "culturax":
        return {"path": CULTURAX, "name": _one_of(params, source, "lang"), "split": "train"}
    if source == "oscar":
        return {"path": OSCAR, "language": _one_of(params, source, "lang"), "split": "train"}
    if source == "fineweb2":
        return {"path": FINEWEB2, "name": _one_of(params, source, "fineweb", "lang_script"), "split": "train"}
    if source == "flores":
        return {"path": FLORES, "name": _one_of(params, source, "flores", "lang_script"), "split": params.get("split", "dev")}
    if source == "smol":
        _one_of(params, source, "tgt")
        return {"path": SMOL, "split": "train"}
    if source == "madlad400":
        return {"path": MADLAD.format(lang=_one_of(params, source, "lang"))}
    raise ValueError(f"no rows of {source} are known")


def refused(why: Exception) -> bool:
    """Whether an error is one of access: by its type, by the HTTP status that it carries, or by one that its text begins with."""
    holder = getattr(why, "response", None) or why
    status = next((v for a in ("status_code", "status", "code") if isinstance(v := getattr(holder, a, None), int)), None)
    if status is None:
        begins = re.match(r"\D{0,20}(\d{3})\b", str(why))
        status = int(begins[1]) if begins else None
    return isinstance(why, PermissionError) or status in REFUSED


def asked(read: Callable[..., DataFrame], spark: SparkSession, source: str, where: dict) -> DataFrame:
    """Rows at the coordinates; where access is refused, the error says what is missing."""
    try:
        return read(spark, **where)
    except Exception as why:
        if refused(why):
            raise PermissionError(f"{source} wants its terms accepted and a token: {where}") from why
        raise


def answer(get: Get, url: str, params: dict | None = None, headers: dict | None = None, waits: tuple = WAITS, good: Callable[[bytes], bool] = lambda body: True) -> tuple[bytes, str | None]:
    """The body and null, or nothing and what was wrong. Who is busy, fails, or doesn't answer well is asked again after each wait."""
    why = "not asked"
    for wait in (0, *waits):
        time.sleep(wait)
        try:
            status, body = get(url, params or {}, headers or {})
        except OSError as error:
            why = f"{type(error).__name__}: {error}"
            continue
        if 200 <= status < 300 and good(body):
            return body, None
        why = f"status {status}" if status >= 300 else "the answer can't be read"
        if 300 <= status < 500 and status not in BUSY:
            break
    return b"", why


def _meta(**columns):
    """Those of the columns that aren't null."""
    pairs = F.create_map(*(x for name, c in columns.items() for x in (F.lit(name), c.cast("string"))))
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def documents(rows: DataFrame, source: str, text, meta) -> DataFrame:
    """text, source and meta of the rows that have a text; where some may have failed, error too, which such rows have instead."""
    failed = "error" in rows.columns
    out = rows.select(F.coalesce(text, F.lit("")).alias("text"), F.lit(source).alias("source"), meta.alias("meta"), *(["error"] if failed else []))
    return out.filter("text <> '' or error is not null" if failed else "text <> ''")


def hub_documents(rows: DataFrame, source: str, params: dict) -> DataFrame:
    """Documents of a data set of texts, with url, title and source where it has them."""
    if source == "flores":
        meta = _meta(flores=F.lit(coordinates(source, params)["name"]), split=F.lit(params.get("split", "dev")))
    elif source == "madlad400":
        meta = _meta(variant=F.lit(params.get("variant", "clean")))
    else:
        meta = _meta(**{c: F.col(c) for c in ("url", "title", "source") if c in rows.columns})
    return documents(rows, source, F.col("text"), meta.cast("map<string,string>"))


def chosen_shards(names: Iterable[str], variant: str = "clean") -> list[str]:
    """Compressed JSON lines whose name has the variant, all of them if none has; in order of name."""
    packed = sorted(n for n in names if n.endswith(".jsonl.gz"))
    return [n for n in packed if variant in n] or packed


_PAIR = re.compile(r"(?P<variant>.+?)__(?P<src>[^_]+)_(?P<tgt>[^_]+)")


def smol_config(configs: Iterable[str], variant: str, src: str, tgt: str) -> str:
    """The configuration of a language pair: the target itself, else one that goes on from it (a script or region)."""
    pairs = [m for c in configs if (m := _PAIR.fullmatch(c)) and (m["variant"], m["src"]) == (variant, src)]
    ranked = [(m["tgt"] != tgt, i, m[0]) for i, m in enumerate(pairs) if m["tgt"].startswith(tgt)]
    if not ranked:
        raise ValueError(f"smol has no {variant} from {src} to {tgt}")
    return min(ranked)[2]


def smol_documents(rows: DataFrame, params: dict) -> DataFrame:
    """Target texts: trg, else the first of trgs (or trgs itself, where it is one text)."""
    src, tgt = params.get("src", "en"), params["tgt"]
    target = F.nullif(F.col("trg"), F.lit("")) if "trg" in rows.columns else F.lit(None).cast("string")
    if "trgs" in rows.columns:
        many = rows.schema["trgs"].dataType.typeName() == "array"
        target = F.coalesce(target, F.get("trgs", F.lit(0)) if many else F.col("trgs"))
    col = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    both = F.to_json(F.create_map(F.lit(src), col("src"), F.lit(tgt), target))
    return documents(rows, "smol", target, _meta(variant=F.lit(params.get("variant", "gatitos")), sl=col("sl"), tl=col("tl"), translation=both))


# ---- crawl index and archives
INDEXED = "i long, j long, url string, file string, offset long, length long, error string"
_INDEXED = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("error", pa.string())])


def newest_crawl(get: Get, waits: tuple = WAITS) -> str:
    """The first of the list of crawls."""
    body, why = answer(get, CRAWLS, waits=waits)
    if why:
        raise SourceUnavailable(f"the list of crawls can't be had: {why}")
    return json.loads(body)[0]["id"]


def _record(line: bytes) -> dict | None:
    """File, offset and length of an index line; None if it isn't one."""
    try:
        found = json.loads(line)
        return {"url": found.get("url"), "file": found["filename"], "offset": int(found["offset"]), "length": int(found["length"])}
    except (ValueError, KeyError, TypeError, AttributeError):
        return None


def index_rows(get: Get, crawl: str, i: int, pattern: str, limit: int, waits: tuple = WAITS) -> list[dict]:
    """Records of pages with status 200 and type text/html that match a pattern; one row with an error if they can't be had."""
    asked_for = {"url": pattern, "output": "json", "limit": limit, "filter": ["=status:200", "=mime:text/html"]}
    lines = lambda body: [x for x in body.splitlines() if x.strip()]
    body, why = answer(get, CRAWL_INDEX.format(crawl=crawl), asked_for, waits=waits, good=lambda body: all(map(_record, lines(body)[:1])))
    if why == "status 404":  # the index knows no page of the pattern
        return []
    if why:
        return [{"i": i, "j": -1, "error": f"index of {crawl}, {pattern}: {why}"}]
    return [{"i": i, "j": j, **(_record(x) or {"error": f"index of {crawl}, {pattern}: line {j} can't be read"})} for j, x in enumerate(lines(body))]


def page_text(get: Get, file: str, offset: int, length: int, waits: tuple = WAITS) -> tuple[str, str | None]:
    """Main text of one record by its byte range, and what was wrong."""
    data, why = answer(get, CRAWL_DATA + file, None, {"Range": f"bytes={offset}-{offset + length - 1}"}, waits)
    html = None if why else first_payload(data)
    return (main_text(html.decode("utf-8", "replace")) if html is not None else ""), f"{file} at {offset}: {why}" if why else None


def url_patterns(params: dict) -> list[str]:
    patterns = params.get("url_patterns") or [p for p in (params.get("url_pattern"),) if p]
    if not patterns:
        raise ValueError("commoncrawl needs url_pattern or url_patterns")
    return patterns


def crawl_documents(spark: SparkSession, get: Get, params: dict, max_docs: int | None = None, waits: tuple = WAITS) -> DataFrame:
    """Main texts of the pages that match the patterns, at most ``max_docs`` (else params.limit) for each pattern.

    One task for each pattern asks the index, one for each found record gets its byte range. What can't be had
    is a row without text that says why in column error, and ends nothing else.
    """
    patterns = url_patterns(params)
    crawl, most = params.get("crawl") or newest_crawl(get, waits), max_docs or params.get("limit", 100)

    def ask(batches):
        for b in batches:
            for i, pattern in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_pylist(index_rows(get, crawl, i, pattern, most, waits), _INDEXED)

    def pull(batches):
        for b in batches:
            texts, errors = [], []
            for file, offset, length, error in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length", "error"))):
                text, why = ("", error) if error else page_text(get, file, offset, length, waits)
                texts.append(text)
                errors.append(why)
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("j"), b.column("url"), pa.array(texts, pa.string()), pa.array(errors, pa.string())], ["i", "j", "url", "text", "error"])

    asks = spark.createDataFrame(list(enumerate(patterns)), "i long, pattern string").repartition(len(patterns), "i")
    pages = asks.mapInArrow(ask, INDEXED).repartition("file", "offset").mapInArrow(pull, "i long, j long, url string, text string, error string")
    pages = pages.filter("text <> '' or error is not null")
    if max_docs is not None:
        pages = stored(spark, pages, "pages")  # used twice, asked for once
        good = pages.filter("error is null").orderBy("i", "j").limit(max_docs)
        pages = good.union(pages.filter("error is not null"))
    return documents(pages, "commoncrawl", F.col("text"), _meta(url=F.col("url"), crawl=F.lit(crawl)))


# ---- parallel corpora
_LINES = pa.schema([("i", pa.int64()), ("corpus", pa.string()), ("side", pa.int64()), ("line", pa.int64()), ("text", pa.string()), ("error", pa.string())])


def chosen_corpora(entries: Iterable[dict], params: dict) -> list[tuple[str, str]]:
    """(corpus, url) of those asked for: params.corpus alone, else params.corpora, else all; without url none."""
    wanted = {params["corpus"]} if params.get("corpus") else set(params.get("corpora") or ())
    return [(e.get("corpus"), e["url"]) for e in entries if e.get("url") and (not wanted or e.get("corpus") in wanted)]


def side_lines(data: bytes, codes: tuple[str, str]):
    """(side, line, text) of the line files of both languages in a zip, some at a time; nothing if it isn't one or lacks a side."""
    if not zipfile.is_zipfile(io.BytesIO(data)):
        return
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        by_ending = {n.rpartition(".")[2]: n for n in reversed(z.namelist())}
        if not set(codes) <= set(by_ending):
            return
        for side, code in enumerate(codes):
            with io.TextIOWrapper(z.open(by_ending[code]), encoding="utf-8", errors="replace") as f:
                line = 0
                while some := list(islice(f, LINES)):
                    yield side, line, [x.strip() for x in some]
                    line += len(some)


def opus_documents(spark: SparkSession, get: Get, params: dict, max_docs: int | None = None, waits: tuple = WAITS) -> DataFrame:
    """Sentences of the source language with their pair in meta.translation.

    One task for each corpus gets its zip and gives the lines of both files as rows, which meet by corpus and line, as
    far as the shorter file goes. A corpus that can't be had is a row with an error.
    """
    src, tgt = _one_of(params, "opus", "src"), params.get("tgt", "en")
    body, why = answer(get, OPUS, {"source": src, "target": tgt, "preprocessing": "moses", "version": "latest"}, waits=waits)
    if why:
        raise SourceUnavailable(f"the list of corpora can't be had: {why}")
    chosen = chosen_corpora(json.loads(body).get("corpora", []), params)

    def pull(batches):
        for b in batches:
            for i, corpus, url in zip(*(c.to_pylist() for c in b.columns)):
                data, why = answer(get, url, waits=waits)
                if why:
                    yield pa.RecordBatch.from_pylist([{"i": i, "corpus": corpus, "error": f"{corpus}: {why}"}], _LINES)
                for side, line, texts in side_lines(data, (src, tgt)):
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int64()), pa.array([corpus] * n, pa.string()), pa.array([side] * n, pa.int64()), pa.array(range(line, line + n), pa.int64()), pa.array(texts, pa.string()), pa.nulls(n, pa.string())], schema=_LINES)

    asks = spark.createDataFrame([(i, c, u) for i, (c, u) in enumerate(chosen)], "i long, corpus string, url string")
    if chosen:
        asks = asks.repartition(len(chosen), "i")
    # both sides are used, and asked for once
    lines = stored(spark, asks.mapInArrow(pull, "i long, corpus string, side long, line long, text string, error string"), "lines")
    side = lambda k: lines.filter((F.col("side") == k) & F.col("error").isNull()).select("i", "corpus", "line", "text")
    pairs = moses_pairs(side(0), side(1), ["i", "corpus", "line"])
    if max_docs is not None:
        pairs = pairs.orderBy("i", "line").limit(max_docs)
    none = F.lit(None).cast("string")
    rows = pairs.withColumn("error", none).unionByName(lines.filter("error is not null").select("i", "corpus", "line", none.alias("src"), none.alias("tgt"), "error"))
    both = F.to_json(F.create_map(F.lit(src), F.col("src"), F.lit(tgt), F.col("tgt")))
    return documents(rows, "opus", F.col("src"), _meta(corpus=F.col("corpus"), translation=both))
