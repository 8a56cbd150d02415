"""One WARC record: headers, HTTP message and payload, of any writer."""

from __future__ import annotations

import base64
import re
import zlib


def headers(block: bytes) -> dict[str, str]:
    """Lower-case names; a line that begins with a blank continues the one before it."""
    lines = re.sub(r"\r?\n[ \t]+", " ", block.decode("utf-8", "replace")).splitlines()[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def joined(body: bytes) -> bytes:
    """The chunks of a body; a body that is not in chunks (crawlers often join them) stays as it is."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = re.fullmatch(rb"\s*([0-9a-fA-F]+)\s*(;.*)?", body[at:line]) if line >= 0 else None
        if not size:
            return body
        n, at = int(size[1], 16), line + 2
        if not n:
            return b"".join(parts)
        parts.append(body[at : at + n])
        at += n + 2


def parse(content: bytes) -> tuple[dict[str, str], dict[str, str], bytes, bytes]:
    """WARC headers, HTTP headers, payload and body as stored of a record.

    The payload of an HTTP message is its body, chunks joined; that of any other record is its whole block.
    """
    head, _, rest = content.partition(b"\r\n\r\n")
    warc = headers(head)
    length = warc.get("content-length", "")
    block = rest[: int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")
    if not warc.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        return warc, {}, block, block
    lines, blank, body = block.partition(b"\r\n\r\n")
    if not blank:
        lines, _, body = block.partition(b"\n\n")
    http = headers(lines)
    return warc, http, joined(body) if "chunked" in http.get("transfer-encoding", "").lower() else body, body


def stated_sha1(header: str | None) -> str | None:
    """Hex of a sha1 digest header, base 32 or hex; None for other digests."""
    name, _, value = (header or "").partition(":")
    if name.strip().lower() not in ("sha1", "sha-1"):
        return None
    value = value.strip()
    try:
        return bytes.fromhex(value).hex() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def first_payload(data: bytes) -> bytes | None:
    """Payload of the first record of a byte range of an archive, compressed or not; None if there is none."""
    if data[:2] == b"\x1f\x8b":
        try:
            data = zlib.decompressobj(31).decompress(data)
        except zlib.error:
            return None
    return parse(data)[2] if data.startswith(b"WARC/") else None
