"""WARC/1.1 records: building, reading, digests, HTTP bodies, and the text of a page."""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import html
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

VERSION = b"WARC/1.1"
END = b"\r\n"
#: Characters that would break a header line are percent-encoded in it.
UNSAFE = re.compile(r"[\x00-\x1F\x7F]|^ | $")
HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main|"
    r"nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>", re.I)
TAG = re.compile(r"<[a-zA-Z/!?][^<>]*>")
CHUNK = re.compile(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(?:;[^\n]*)?\r?\Z")
CHARSET = re.compile(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:+-]+)", re.I)
SPACE = re.compile(r"[^\S\n]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe(value: str) -> str:
    if value.isprintable() and value[:1] != " " and value[-1:] != " ":
        return value
    return UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value)


def header_lines(fields: Iterable[tuple[str, str | None]]) -> bytes:
    """``name: value`` lines; a field without a value is left out."""
    return b"".join(f"{name}: {safe(value)}".encode() + END for name, value in fields if value is not None)


def record(fields: Iterable[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as a gzip member of its own; equal input gives equal bytes."""
    head = [*fields, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return gzip.compress(VERSION + END + header_lines(head) + END + block + END + END, 6, mtime=0)


def parsed_lines(lines: Iterable[bytes]) -> list[tuple[str, str]]:
    """Names and values; a line that begins with a blank goes on with the value
    before it."""
    pairs: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (b" ", b"\t") and pairs:
            name, value = pairs[-1]
            pairs[-1] = name, f"{value} {line.decode('utf-8', 'replace').strip()}".strip()
            continue
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            pairs.append((name.strip(), value.strip()))
    return pairs


class Fields(dict):
    """Header lines by lower-case name; ``pairs`` has every line, in order."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.pairs = [(name.lower(), value) for name, value in pairs]
        super().__init__(self.pairs)

    def all(self, name: str) -> str | None:
        """The values of a field that may be repeated, one a line."""
        return "\n".join(v for n, v in self.pairs if n == name) if name in self else None


def records(source: BinaryIO) -> Iterator[tuple[Fields, bytes]]:
    """(headers, block) of every record of a file."""
    with gzip.GzipFile(fileobj=source) as stream:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            lines = []
            while (line := stream.readline()).strip():
                lines.append(line)
            fields = Fields(parsed_lines(lines))
            size = int(fields["content-length"])
            block = stream.read(size)
            if len(block) != size:
                raise ValueError(f"record cut short: {len(block)} of {size} bytes")
            yield fields, block


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP response."""
    head, _, payload = block.partition(END + END)
    status, *lines = head.split(END)
    return status.decode("utf-8", "replace"), parsed_lines(lines), payload


def unchunked(body: bytes) -> bytes:
    """The data of a body in chunks; from a chunk that breaks the format on, the
    body as it is."""
    data, at = [], 0
    while True:
        end = body.find(b"\n", at)
        size = CHUNK.match(body, at, end if end >= 0 else len(body))
        if not size:
            data.append(body[at:])
            break
        length = int(size[1], 16)
        if not length or end < 0:
            break
        data.append(body[end + 1:end + 1 + length])
        at = end + 1 + length
        at += 2 if body[at:at + 2] == END else 1 if body[at:at + 1] == b"\n" else 0
        if at >= len(body):
            break
    return b"".join(data)


def _inflated(data: bytes, wbits: int) -> bytes:
    """All members of a compressed stream, up to where it breaks."""
    out = []
    while data:
        unpack = zlib.decompressobj(wbits)
        try:
            out.append(unpack.decompress(data))
        except zlib.error:
            break
        if not unpack.eof or unpack.unused_data == data:
            break
        data = unpack.unused_data if wbits == 31 else b""
    return b"".join(out)


def plain_body(fields: Fields, body: bytes) -> tuple[bytes, bytes | None]:
    """The body without its transfer coding, and that without its content
    codings: None where a coding is unknown. A body stored decoded under headers
    that still name a coding is told by its first bytes and left as it is."""
    codings = [c.strip().lower() for c in (fields.get("transfer-encoding") or "").split(",")]
    if "chunked" in codings and CHUNK.match(body, 0, max(0, body.find(b"\n"))):
        body = unchunked(body)
    plain = body
    codings = [c for c in codings if c != "chunked"]
    for name in reversed([*(c.strip().lower() for c in (fields.get("content-encoding") or "").split(",")), *codings]):
        if name in ("", "identity"):
            continue
        if name in ("gzip", "x-gzip"):
            plain = _inflated(plain, 31) if plain[:2] == b"\x1f\x8b" else plain
        elif name == "deflate":
            # with the zlib header by the standard, without it from some servers
            zlib_head = len(plain) > 1 and plain[0] & 15 == 8 and (plain[0] << 8 | plain[1]) % 31 == 0
            plain = _inflated(plain, 15 if zlib_head else -15) or plain
        else:
            return body, None
    return body, plain


def decoded(fields: Fields, data: bytes) -> str:
    """The body's characters: by a byte order mark, else the charset that the
    header names, else the page's own in its first 1024 bytes, else UTF-8. What
    has no such character becomes U+FFFD."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if data.startswith(mark):
            return data[len(mark):].decode(name, "replace")
    said = CHARSET.search((fields.get("content-type") or "").encode())
    named = said or CHARSET.search(data, 0, 1024)
    try:
        name = codecs.lookup(named[1].decode()).name if named else "utf-8"
        if not said and name.startswith("utf-16"):  # a page whose words are read as bytes is not in it
            name = "utf-8"
        # as browsers do: pages that name these two hold the Windows characters
        return data.decode({"iso8859-1": "cp1252", "ascii": "cp1252"}.get(name, name), "replace")
    except (LookupError, ValueError):  # no charset of that name
        return data.decode("utf-8", "replace")


def page_text(page: str) -> str:
    """Visible text: scripts, styles and comments go, block elements end a line,
    entities are resolved, runs of blanks become one."""
    text = TAG.sub("", BLOCK.sub("\n", HIDDEN.sub(" ", page.replace("\r", " ").replace("\n", " "))))
    lines = (html.unescape(line) for line in text.split("\n"))
    # a line break can come from an entity; it stays
    lines = (" ".join(line.split()) if "\n" not in line else SPACE.sub(" ", line).strip() for line in lines)
    return "\n".join(line for line in lines if line)
