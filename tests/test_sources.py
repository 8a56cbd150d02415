"""Network sources over answers that stand in for the network."""

import io
import json
import zipfile
import zlib

import pytest

from pyspark.sql.datasource import EqualTo, GreaterThan, Not

from weft.sources import datasource, remote
from weft.sources.records import first_payload
from weft.sources.registry import connector
from weft.sources import planned


def found(df):
    return [(r["text"], r["meta"]) for r in df.collect()]


class Rows:
    """A hub of one data set; says where it was asked."""

    def __init__(self, rows, schema, names=()):
        self.rows, self.schema, self.known, self.seen = rows, schema, names, None

    def __call__(self, spark, **where):
        self.seen = where
        return spark.createDataFrame(self.rows, self.schema)

    def names(self, path):
        return self.known


def test_text_sets(spark):
    hub = Rows([("one", "u1", None, 3), ("", "u2", "t", 4), (None, "u3", "t", 5), ("two", None, "T", 6)], "text string, url string, title string, other int")
    got = found(connector("wikipedia").documents(spark, {"wiki": "cy"}, fetch=hub))
    assert got == [("one", {"url": "u1"}), ("two", {"title": "T"})] and hub.seen == {"path": remote.WIKIPEDIA, "name": "20231101.cy", "split": "train"}
    assert connector("wikipedia").documents(spark, {"wiki": "cy"}, 1, fetch=hub).count() == 1
    connector("oscar").documents(spark, {"lang": "cy"}, token="t", fetch=hub)
    assert hub.seen == {"path": remote.OSCAR, "language": "cy", "split": "train"}
    assert remote.coordinates("fineweb2", {"lang_script": "kmr_Latn"})["name"] == remote.coordinates("glot500", {"glot": "kmr_Latn"})["name"] == "kmr_Latn"
    assert found(connector("flores").documents(spark, {"flores": "cym_Latn"}, token="t", fetch=hub))[0] == ("one", {"flores": "cym_Latn", "split": "dev"})
    for name in ("wikipedia", "glot500", "oscar", "fineweb2", "flores", "madlad400", "smol", "opus", "commoncrawl"):
        with pytest.raises(ValueError):
            connector(name).documents(spark, {}, token="t", fetch=hub)


def test_a_gate_is_a_permission_error(spark):
    def closed(spark, **where):
        raise OSError("403: this set is gated")

    def broken(spark, **where):
        raise OSError("no such host")

    with pytest.raises(PermissionError):
        connector("glot500").documents(spark, {"glot": "cym_Latn"}, fetch=closed)
    with pytest.raises(OSError, match="host"):
        connector("glot500").documents(spark, {"glot": "cym_Latn"}, fetch=broken)


def test_shards_and_configurations(spark):
    files = ["b_noisy_0.jsonl.gz", "b_clean_1.jsonl.gz", "a_clean_0.jsonl.gz", "readme.md"]
    hub = Rows([("x",)], "text string", files)
    assert found(connector("madlad400").documents(spark, {"lang": "b"}, fetch=hub)) == [("x", {"variant": "clean"})]
    assert hub.seen["files"] == ["a_clean_0.jsonl.gz", "b_clean_1.jsonl.gz"]
    assert remote.chosen_shards(files, "other") == sorted(files[:3])
    configs = ["gatitos__en_dje", "gatitos__en_iu-Latn", "smolsent__en_dje", "gatitos__fr_iu"]
    assert remote.smol_config(configs, "gatitos", "en", "dje") == "gatitos__en_dje" and remote.smol_config(configs, "gatitos", "en", "iu") == "gatitos__en_iu-Latn"
    with pytest.raises(ValueError):
        remote.smol_config(configs, "smoldoc", "en", "dje")
    hub = Rows([("one", ["a"], "s", "en"), ("", ["b", "c"], "t", "en"), (None, None, "u", None)], "trg string, trgs array<string>, src string, sl string", configs)
    got = found(connector("smol").documents(spark, {"tgt": "dje"}, fetch=hub))
    assert [t for t, _ in got] == ["one", "b"] and got[0][1] == {"variant": "gatitos", "sl": "en", "translation": '{"en":"s","dje":"one"}'} and hub.seen["name"] == "gatitos__en_dje"
    hub = Rows([("", "whole text")], "trg string, trgs string", configs)
    assert found(connector("smol").documents(spark, {"tgt": "dje"}, fetch=hub))[0][0] == "whole text"


def packed(html, chunked=False):
    body = b"HTTP/1.1 200 OK\r\n\r\n" + html
    if chunked:
        body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + f"{len(html):x}\r\n".encode() + html + b"\r\n0\r\n\r\n"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    out = zlib.compressobj(6, zlib.DEFLATED, 31)
    return out.compress(record) + out.flush()


def test_crawl(spark):
    pages = [packed(b"<p>page zero"), packed(b"<p>page one", True), b"no archive", packed(b""), packed(b"<p>page four")]
    archive, at = b"".join(pages), [sum(map(len, pages[:i])) for i in range(len(pages))]
    lines = [json.dumps({"url": f"http://x/{i}", "filename": "f.warc.gz", "offset": str(at[i]), "length": str(len(pages[i]))}) for i in range(5)]
    assert first_payload(pages[1]) == b"<p>page one" and first_payload(b"junk") is None

    def get(url, params, headers):
        if url == remote.CRAWLS:
            return 200, b'[{"id": "CC-NEW"}, {"id": "CC-OLD"}]'
        if "index" in url:
            assert "CC-NEW" in url and params["filter"] == ["=status:200", "=mime:text/html"]
            some = {"a/*": lines[:2], "b/*": lines[2:]}[params["url"]][: params["limit"]]
            return 200, "\n".join(some).encode()
        a, z = map(int, headers["Range"].removeprefix("bytes=").split("-"))
        return 206, archive[a : z + 1]

    docs = lambda n=None, **p: sorted(found(connector("commoncrawl").documents(spark, {"url_patterns": ["a/*", "b/*"]} | p, n, fetch=get)), key=str)
    assert docs() == [("page four", {"url": "http://x/4", "crawl": "CC-NEW"}), ("page one", {"url": "http://x/1", "crawl": "CC-NEW"}), ("page zero", {"url": "http://x/0", "crawl": "CC-NEW"})]
    assert [t for t, _ in docs(limit=1)] == ["page zero"] and [t for t, _ in docs(2)] == ["page one", "page zero"]
    # an index that stays busy is asked again, then the pattern is a row with an error
    asked = []
    (row,) = remote.index_rows(lambda *_: asked.append(1) or (503, b""), "c", 3, "p", 1, (0, 0))
    assert len(asked) == 3 and row["i"] == 3 and "status 503" in row["error"]
    asked.clear()
    assert remote.index_rows(lambda *_: asked.append(1) or (404, b""), "c", 0, "p", 1) == [] and len(asked) == 1
    assert remote.answer(lambda *_: (200, b"busy"), "u", waits=(0,), good=lambda b: b.startswith(b"{")) == (b"", "the answer can't be read")


def test_a_failing_request_ends_nothing_else(spark):
    html = packed(b"<p>page")
    line = json.dumps({"url": "http://x", "filename": "f.warc.gz", "offset": "0", "length": str(len(html))})
    broken = line.replace("f.warc", "gone.warc")

    def get(url, params, headers):
        if "index" in url:
            if params["url"] == "timeout/*":
                raise TimeoutError("no answer")
            return (403, b"") if params["url"] == "closed/*" else (200, f"{line}\n{broken}\nnot an index line".encode())
        return (404, b"") if "gone" in url else (206, html)

    rows = remote.crawl_documents(spark, get, {"url_patterns": ["closed/*", "timeout/*", "open/*"], "crawl": "C"}, waits=()).collect()
    assert [r["text"] for r in rows if r["error"] is None] == ["page"]
    errors = sorted(r["error"] for r in rows if r["error"])
    assert [e.split(": ", 1)[1] for e in errors] == ["status 404", "status 403", "line 2 can't be read", "TimeoutError: no answer"]
    few = remote.crawl_documents(spark, get, {"url_patterns": ["closed/*", "open/*"], "crawl": "C"}, 1, ()).collect()
    assert sum(r["error"] is None for r in few) == 1 and any(r["error"] for r in few)
    assert connector("commoncrawl").documents(spark, {"url_pattern": "closed/*", "crawl": "C"}, fetch=get).count() == 0


def test_parallel_corpora(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("x.cy-en.cy", "un \n\ndau\ntri\n")
        z.writestr("x.cy-en.en", "one\ntwo\n three\n")
    entries = [{"corpus": "A", "url": "http://a"}, {"corpus": "B", "url": "http://b"}, {"corpus": "C"}, {"corpus": "D", "url": "http://d"}]

    def get(url, params, headers):
        if url == remote.OPUS:
            return 200, json.dumps({"corpora": entries}).encode()
        return (404, b"") if url == "http://b" else (200, buffer.getvalue() if url == "http://a" else b"not a zip")

    got = found(connector("opus").documents(spark, {"src": "cy"}, fetch=get))
    assert [t for t, _ in got] == ["un", "dau"] and got[0][1] == {"corpus": "A", "translation": '{"cy":"un","en":"one"}'}
    assert connector("opus").documents(spark, {"src": "cy"}, 1, fetch=get).count() == 1
    assert connector("opus").documents(spark, {"src": "cy", "corpora": ["B"]}, fetch=get).count() == 0
    assert connector("opus").documents(spark, {"src": "cy", "corpora": ["A"], "corpus": "Z"}, fetch=get).count() == 0
    assert remote.chosen_corpora(entries, {"corpora": ["A", "C"]}) == [("A", "http://a")]


def test_line_files_meet_beyond_a_batch(spark):
    buffer = io.BytesIO()
    n = remote.LINES + 7
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("x.cy", "\n".join(f"un {i}" if i % 9 else "" for i in range(n)))
        z.writestr("x.en", "\n".join(f"one {i}" for i in range(n - 3)))

    def get(url, params, headers):
        return (200, json.dumps({"corpora": [{"corpus": "A", "url": "http://a"}, {"corpus": "B", "url": "http://b"}]}).encode()) if url == remote.OPUS else (200, buffer.getvalue()) if url == "http://a" else (500, b"")

    rows = remote.opus_documents(spark, get, {"src": "cy"}, waits=()).collect()
    assert sorted(r["text"] for r in rows if r["error"] is None) == sorted(f"un {i}" for i in range(n - 3) if i % 9)
    assert all(json.loads(r["meta"]["translation"])["en"].split()[1] == r["text"].split()[1] for r in rows if r["error"] is None)
    assert [r["error"] for r in rows if r["error"]] == ["B: status 500"]


def test_waves_read_files_in_order_and_no_more_than_wanted(spark, tmp_path):
    for i in range(20):
        (tmp_path / f"{i:02d} [x].txt").write_text("word " * 200)
    listed = planned.listed(spark, str(tmp_path), ("txt",))
    waves, seen = planned.Waves(listed, 2500, 1000), []
    for paths in waves:
        seen.append([p.rsplit("/", 1)[-1][:2] for p in paths])
        waves.gave(800 * len(paths))
    assert seen[0] == ["00", "01", "02"] and sum(map(len, seen)) <= 8 and sum(seen, []) == [f"{i:02d}" for i in range(len(sum(seen, [])))]
    parts = connector("local").parts(spark, {"path": str(tmp_path)}, wanted=10**9)
    first = next(parts)
    assert first.count() == 20
    with pytest.raises(StopIteration):
        parts.send(10**9)


def test_file_lists_are_read_in_growing_parts(spark):
    files = [f"{i}_clean.jsonl.gz" for i in range(9)]
    hub = Rows([("x" * 100,)], "text string", files)
    parts, sizes = connector("madlad400").parts(spark, {"lang": "b"}, fetch=hub, wanted=250), []
    part = next(parts, None)
    while part is not None:
        sizes.append(len(hub.seen["files"]))
        try:
            part = parts.send(100)
        except StopIteration:
            part = None
    assert sizes == [1, 2, 4]
    assert "files" in hub.seen and next(connector("madlad400").parts(spark, {"lang": "b"}, fetch=hub)).count() == 1 and len(hub.seen["files"]) == 9


@pytest.fixture
def mixed(tmp_path):
    (tmp_path / "a.txt").write_text("plain text")
    (tmp_path / "b.html").write_text("<p>a page</p>")
    (tmp_path / "c.jsonl").write_text("".join(json.dumps({"text": f"line {i}", "n": i}) + "\n" for i in range(500)))
    (tmp_path / "d.jsonl.gz").write_bytes(b"no gzip")
    (tmp_path / "e.bin").write_bytes(b"other")
    return tmp_path


def test_local_data_source(spark, mixed):
    datasource.register(spark)
    read = lambda **o: spark.read.format("weft_local").options(path=str(mixed), **o).load()
    rows = read(split=1000).collect()
    assert sorted(r["text"] for r in rows if r["error"] is None) == sorted(["plain text", "a page", *(f"line {i}" for i in range(500))])
    assert [(r["path"][-10:], r["error"].split(":")[0]) for r in rows if r["error"]] == [("d.jsonl.gz", "BadGzipFile")]
    assert read(split=1000).rdd.getNumPartitions() > 5
    # filters on the place of a document reach the source: what they leave out is not opened
    few = read().filter("kind = 'html' and bytes > 3")
    assert [r["text"] for r in few.collect()] == ["a page"]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "html" not in plan
    assert read().filter("path like '%.txt'").count() == 1 and read().filter("kind in ('text', 'html') and text like '%page%'").count() == 1
    parts = read(split=1000)
    assert read(split=1000, limit=2).filter("error is null").count() <= 2 * parts.rdd.getNumPartitions() and read(limit=3, glob="*.jsonl").count() == 3
    assert read(glob="*.none").count() == 0 and read().filter("kind = 'pdf'").count() == 0
    spark.sql(f"create or replace temp view local_docs using weft_local options (path '{mixed}')")
    assert spark.sql("select count(*) from local_docs where kind = 'json' and error is null").first()[0] == 500
    with pytest.raises(Exception, match="path"):
        spark.read.format("weft_local").load().collect()


def test_pushed_filters_are_told():
    names = ("path", "bytes")
    assert datasource.told(EqualTo(("path",), "x"), names)({"path": "x", "bytes": 1})
    assert datasource.told(Not(GreaterThan(("bytes",), 3)), names)({"path": "x", "bytes": 3})
    assert datasource.told(EqualTo(("text",), "x"), names) is None and datasource.told(Not(EqualTo(("text",), "x")), names) is None
    reader = datasource.FilesReader({"path": "/tmp"})
    assert list(reader.pushFilters([EqualTo(("kind",), "html"), EqualTo(("text",), "x")])) == [EqualTo(("text",), "x")] and len(reader.tests) == 1


def test_crawl_data_source(spark):
    html = packed(b"<p>page")
    asked = spark.sparkContext.accumulator(0)

    def get(url, params, headers):
        asked.add(1)
        if "index" in url:
            if params["url"] == "closed/*":
                return 403, b""
            return 200, "\n".join(json.dumps({"url": f"http://{params['url'][0]}/{i}", "filename": "gone" if i == 2 else "f", "offset": "0", "length": str(len(html))}) for i in range(4)).encode()
        return (404, b"") if "gone" in url else (206, html)

    datasource.register(spark, get, ())
    read = lambda **o: spark.read.format("weft_crawl").options(url_patterns="a/* b/* closed/*", crawl="C", splits=2, **o).load()
    rows = read().collect()
    assert sorted(r["url"] for r in rows if r["text"] == "page") == [f"http://{x}/{i}" for x in "ab" for i in (0, 1, 3)]
    assert sorted(r["error"].split(": ")[-1] for r in rows if r["error"]) == ["status 403", "status 404", "status 404"]
    before = asked.value
    assert read().filter("pattern = 'b/*' and url = 'http://b/1'").count() == 1
    assert asked.value - before == 3  # the index for each split, and one page
