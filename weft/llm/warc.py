"""WARC archives: a deduplicating writer and a splittable reader (operator 3).

Writer: one gzip member for each record (WARC/1.1). Payloads of ``least_bytes`` or more that are equal
(SHA-1 and length) are stored once, in the response record of the largest page_id; the others become
revisit records that refer to it. Each attempt of a task writes a hidden file in a shared folder and
gives it a name of its own at the end; only the files of attempts that Spark commits are listed, so
neither a lost nor a repeated task leaves half a file or another's records.

Reader: archives are cut in byte ranges. A task scans its range for the gzip magic, takes a place as
a member only if its header decodes and its content starts with the WARC version, and owns the
records that start inside its range; the last one may end beyond it. Nothing but a range and one
record is in memory, and no index is needed. An archive inside a payload can be mistaken for records only
where deflate stored it as it is, and such a block ends within 64 KB; so the first member of a range
counts only if members follow each other from there for as long. Records of every type are read, with or
without digests, folded headers and chunked bodies; ``problem`` says what is wrong with a record: truncated
(the file ends in it), no length, or a digest that its payload doesn't have.

Cases: a null html is an empty payload and a null url an empty target; empty and small payloads are
all responses; repeated rows (same page_id and payload) count as one and are all responses; a null
page_id never is the response of a larger group that has ids; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import bounded_batches, fresh_path, stored
from weft.sources.records import parse, stated_sha1

LEAST_BYTES = 1000
SPLIT_BYTES = 4 << 20
MOST_TASKS = 20_000
#: At most so many repeated payloads (some 60 bytes each) are broadcast; more meet their pages in a sort-merge join.
BROADCAST_ROWS = 100_000
#: The length of a block that deflate stores as it is, at most.
STORED_BYTES = 65_536
READ_BYTES = 1 << 20
MAGIC = b"\x1f\x8b\x08"
_BAD = re.compile(r"[\x00-\x20\x7f]")
_DATE = "2020-01-01T00:00:00Z"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, as this executor reaches it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _clean_uri(url: str | None) -> str:
    return _BAD.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    number = (record or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record as one gzip member. ``digest``: hex SHA-1 of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_clean_uri(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def plan_records(spark: SparkSession, pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to of every page; the hot payload never meets in one task.

    Only digests are shuffled, unless the repeated payloads are too many to broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    large = rows.filter(F.col("size") >= least_bytes)
    first = large.groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    first = stored(spark, first.select(F.col("digest").alias("d"), F.col("size").alias("z"), "first"), "payloads")
    small = first.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(first) if small else first.hint("merge"), (F.col("digest") == F.col("d")) & (F.col("size") == F.col("z")), "left")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", other.alias("refers_to"))


def write(spark: SparkSession, records: DataFrame, path: str) -> DataFrame:
    """Writes archives below ``path``; (path, bytes) of each file."""
    bounded_batches(spark)

    def run(batches):
        fs, base = filesystem(path)
        fs.create_dir(base, recursive=True)
        own = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        mine, size = f"{base}/.{own}", 0
        with fs.open_output_stream(mine) as out:
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    size += out.write(record_bytes(*row, row[4] is not None))
        if size:
            fs.move(mine, f"{base}/part-{own}.warc.gz")
            yield pa.RecordBatch.from_arrays([pa.array([f"{path}/part-{own}.warc.gz"]), pa.array([size])], ["path", "bytes"])
        else:
            fs.delete_file(mine)

    return stored(spark, records.mapInArrow(run, "path string, bytes long"), "archives")


def members(f: pa.NativeFile, start: int, end: int, size: int) -> Iterator[tuple[int, bytes | None]]:
    """(offset, content) of the WARC members that start in [start, end); no content if the file ends inside the member."""
    at = after = start
    sure = start == 0
    while at < end:
        f.seek(at)
        window = f.read(min(READ_BYTES, end - at) + len(MAGIC) - 1)
        found = window.find(MAGIC)
        if found < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += found
        got = _member(f, at, size)
        if got and (sure and at == after or _followed(f, got[0], at + STORED_BYTES, size)):
            yield at, got[1]
            at = after = got[0]
            sure = True
        else:
            at += 1


def _followed(f: pa.NativeFile, at: int, until: int, size: int) -> bool:
    """Whether member follows member from a member's end at ``at`` up to ``until`` or the end of the file."""
    while at < min(until, size):
        got = _member(f, at, size)
        if got is None:
            return False
        at = got[0]
    return True


def _member(f: pa.NativeFile, at: int, size: int) -> tuple[int, bytes | None] | None:
    """(end, content) if a gzip member with a WARC header starts at ``at``; no content if the file ends before the member does."""
    f.seek(at)
    unpack, parts, checked, used, step = zlib.decompressobj(31), [], False, at, 16 << 10
    try:
        while not unpack.eof:
            data = f.read(step)
            if not data:
                return (size, None) if checked else None
            used += len(data)
            step = READ_BYTES
            parts.append(unpack.decompress(data))
            if not checked and sum(map(len, parts)) >= 5:
                if not b"".join(parts)[:5] == b"WARC/":
                    return None
                checked = True
    except zlib.error:
        return None
    return (used - len(unpack.unused_data), b"".join(parts)) if checked else None


READ_SCHEMA = "path string, offset long, record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, problem string"


def record_row(path: str, offset: int, content: bytes | None, payloads: bool) -> tuple:
    """A row of ``READ_SCHEMA``. A revisit has no payload: its digest and size are those that its headers state."""
    if content is None:
        return (path, offset, *[None] * 7, "truncated")
    warc, http, payload, body = parse(content)
    stated, problem = stated_sha1(warc.get("warc-payload-digest")), None
    if "content-length" not in warc:
        problem = "no length"
    if warc.get("warc-type") == "revisit":
        length = http.get("content-length", "")
        digest, length, payload = stated, int(length) if length.isdigit() else None, None
    else:
        digest, length = hashlib.sha1(payload).hexdigest(), len(payload)
        if stated and stated not in (digest, hashlib.sha1(body).hexdigest()):
            problem = "digest differs"
    return (path, offset, warc.get("warc-record-id"), warc.get("warc-type"), warc.get("warc-target-uri"), warc.get("warc-refers-to"), digest, length, payload if payloads else None, problem)


def read(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """Records of the archives ``files`` (path, bytes), rows of READ_SCHEMA."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    splits = files.select("path", "bytes", F.explode(starts).alias("start"))
    # one task for each range, however small its row: a count that AQE doesn't coalesce
    splits = stored(spark, splits, "splits")
    splits = splits.repartition(max(1, min(splits.count(), MOST_TASKS)), "path", "start")

    def run(batches):
        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                fs, name = filesystem(path)
                rows: list[tuple] = []
                held = 0
                with fs.open_input_file(name) as f:
                    for offset, content in members(f, start, min(start + split_bytes, size), size):
                        rows.append(record_row(path, offset, content, payloads))
                        held += len(content or b"") if payloads else 0
                        if held > 16 << 20 or len(rows) > 5000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return splits.select("path", "bytes", "start").mapInArrow(run, READ_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in READ_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)], [name for name, _ in fields])


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """What reading the archives of ``pages`` gives for each page; a record with a problem ends the run."""
    files = write(spark, plan_records(spark, pages, least_bytes), fresh_path(spark, "warc"))
    back = read(spark, files, payloads=False)
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")
    fine = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat("path", F.lit(": "), "problem"))).otherwise(F.col("record_type"))
    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", fine.alias("record_type"), page("refers_to").alias("refers_to"))
