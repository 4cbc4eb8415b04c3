"""WARC derivatives: linked metadata and plain-text conversion records.

1. ``write_responses`` turns pages into response records (an HTTP header and
   the page), each a gzip member with its own identifier and digests. A task
   starts a new file whenever one reaches ``file_bytes``.
2. ``build_derivatives`` reads response files as streams, one record in memory
   at a time. For each response it writes a metadata record (the source's HTTP
   status and headers, its digests and whether they hold) and a conversion
   record (the page's text), both with ``WARC-Refers-To`` naming the response,
   and the metadata record with ``WARC-Concurrent-To`` naming the conversion.
   Target URI and date are those of the response. Other records are passed over.
   Chunked, gzip and deflate bodies are decoded, the charset is honoured and
   folded header lines are joined; a body in another coding gives empty text and
   a ``source-coding-unknown`` field.
3. ``read_derivatives`` returns a row per record from the files themselves.

The tables passed on hold file names alone; files are dealt out evenly, and
no step shuffles a page. A file is written under a temporary name and renamed,
so a repeated task attempt replaces like with like.

Cases: a null page is an empty payload and empty text; a null url or page_id
leaves its header out and reads back as null; control characters in a url are
percent-encoded in the header; repeated rows give records of their own (the
identifier takes in the row's place); an empty table gives no file and no rows;
other columns are ignored. ``page_id`` may be of any type that has a text form.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import materialise, store_of
from emberwake.llm.warc_records import (
    Fields, decoded, digest, header_lines, http_parts, page_text, plain_body, record, records,
)
from emberwake.session import scratch_path

FILE_BYTES = 64 << 20
#: Fixed value: the date of records whose source names none.
NO_DATE = "1970-01-01T00:00:00Z"
FILES = "file string, records long, bytes long"
ROWS = {
    "page_id": pa.string(), "warc_type": pa.string(), "record_id": pa.string(), "refers_to": pa.string(),
    "concurrent_to": pa.string(), "target_uri": pa.string(), "warc_date": pa.string(), "content_type": pa.string(),
    "source_digest": pa.string(), "source_digest_ok": pa.bool_(), "source_headers": pa.string(),
    "block_digest_ok": pa.bool_(), "n_bytes": pa.int64(), "block_sha256": pa.string()}


def record_id(*parts: object) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, "\x1f".join(map(str, parts))).urn


class Rolling:
    """Files ``<prefix>-<n>.warc.gz`` of about ``file_bytes`` each."""

    def __init__(self, folder: str, prefix: str, file_bytes: int):
        self.store, self.root = store_of(folder)
        self.prefix, self.file_bytes = prefix, file_bytes
        self.out, self.done = None, []

    def write(self, *members: bytes) -> None:
        if self.out is None:
            self.store.create_dir(self.root)
            self.name = f"{self.prefix}-{len(self.done):05d}.warc.gz"
            self.temporary = f"{self.root}/.{self.name}-{TaskContext.get().taskAttemptId()}"
            self.out, self.records, self.bytes = self.store.open_output_stream(self.temporary), 0, 0
        for m in members:
            self.out.write(m)
            self.records, self.bytes = self.records + 1, self.bytes + len(m)
        if self.bytes >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.root}/{self.name}")
            self.done.append((self.name, self.records, self.bytes))
            self.out = None

    def rows(self) -> pa.RecordBatch:
        self.close()
        names, counts, sizes = list(zip(*self.done)) or ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
            ["file", "records", "bytes"])


def write_responses(pages: DataFrame, folder: str | None = None, date: str = NO_DATE,
                    file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Response records of page_id, url, html; returns the folder and its files."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc_responses")
    source = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), F.col("html").cast("string"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        files, row = Rolling(folder, f"responses-{part:06d}", file_bytes), 0
        for b in rows:
            for page_id, url, page in zip(*(c.to_pylist() for c in b.columns)):
                payload = (page or "").encode()
                head = b"HTTP/1.1 200 OK\r\n" + header_lines([
                    ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload))),
                    ("X-Page-Id", page_id)])
                files.write(record([
                    ("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id('response', part, row, page_id, url)}>"),
                    ("WARC-Date", date), ("WARC-Target-URI", url),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("WARC-Payload-Digest", digest(payload))], head + b"\r\n" + payload))
                row += 1
        yield files.rows()

    return folder, materialise(source.mapInArrow(run, FILES), "warc_files")


def derivatives(fields: dict[str, str], block: bytes) -> tuple[bytes, bytes]:
    """The metadata and the conversion record of one response."""
    status, headers, payload = http_parts(block)
    source, uri, date = fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date", NO_DATE)
    named, http = fields.get("warc-payload-digest"), Fields(headers)
    body, plain = plain_body(http, payload)
    text = b"" if plain is None else page_text(decoded(http, plain)).encode()
    # writers take the payload's digest with the chunks or without
    holds = named is not None and (named == digest(payload) or body is not payload and named == digest(body))
    ids = {kind: f"<{record_id(kind, source)}>" for kind in ("metadata", "conversion")}
    common = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source)]
    meta = header_lines([
        ("source-payload-digest", named), ("source-block-digest", fields.get("warc-block-digest")),
        ("source-payload-digest-holds", None if named is None else str(holds).lower()),
        ("source-coding-unknown", http.get("content-encoding") if plain is None else None),
        ("http-status", status), *((f"http-header-{name.lower()}", value) for name, value in headers)])
    return (
        record([("WARC-Type", "metadata"), ("WARC-Record-ID", ids["metadata"]), *common,
                ("WARC-Concurrent-To", ids["conversion"]), ("Content-Type", "application/warc-fields")], meta),
        record([("WARC-Type", "conversion"), ("WARC-Record-ID", ids["conversion"]), *common,
                ("Content-Type", "text/plain; charset=utf-8"), ("X-Source-Payload-Digest", named),
                ("X-Page-Id", http.get("x-page-id"))], text))


def _dealt(files: DataFrame) -> DataFrame:
    """A task per file: ranges of names as many as there are files, and no more
    names than the ranges are sampled from. The list has a row per ``file_bytes``
    of records."""
    return files.select("file").repartitionByRange(max(1, files.count()), "file")


def build_derivatives(folder: str, files: DataFrame, out: str | None = None,
                      file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Metadata and conversion records of the response ``files`` in ``folder``."""
    spark = files.sparkSession
    out = out or scratch_path(spark, "warc_derivatives")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        for b in rows:
            for name in b.column(0).to_pylist():
                made = Rolling(out, f"derived-{name.removesuffix('.warc.gz')}", file_bytes)
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for fields, block in records(source):
                        if fields.get("warc-type") == "response":
                            made.write(*derivatives(fields, block))
                yield made.rows()

    return out, materialise(_dealt(files).mapInArrow(run, FILES), "warc_files")


def _row(fields: Fields, block: bytes) -> dict:
    row = {"warc_type": fields["warc-type"], "record_id": fields["warc-record-id"],
           "refers_to": fields.get("warc-refers-to"), "concurrent_to": fields.all("warc-concurrent-to"),
           "target_uri": fields.get("warc-target-uri"), "warc_date": fields.get("warc-date"),
           "content_type": fields.get("content-type"), "page_id": fields.get("x-page-id"),
           "source_digest": fields.get("x-source-payload-digest"),
           "block_digest_ok": fields.get("warc-block-digest") == digest(block), "n_bytes": len(block),
           "block_sha256": hashlib.sha256(block).hexdigest()}
    if fields["warc-type"] == "metadata":
        lines = [line.split(": ", 1) for line in block.decode().split("\r\n") if line]  # a header may be repeated
        meta = dict(lines)
        row |= {"page_id": meta.get("http-header-x-page-id"), "source_digest": meta.get("source-payload-digest"),
                "source_digest_ok": meta.get("source-payload-digest-holds") == "true",
                "source_headers": "\n".join(f"{k.removeprefix('http-header-')}: {v}" for k, v in lines
                                            if k.startswith("http-"))}
    return row


def read_derivatives(folder: str, files: DataFrame, id_type: str = "string") -> DataFrame:
    """A row per record of ``files``: identifiers, links, digests and sizes."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        for b in rows:
            for name in b.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    held = []
                    for fields, block in records(source):
                        held.append(_row(fields, block))
                        if len(held) == 4096:
                            yield pa.RecordBatch.from_pylist(held, pa.schema(ROWS))
                            held = []
                    yield pa.RecordBatch.from_pylist(held, pa.schema(ROWS))

    kinds = {pa.string(): "string", pa.bool_(): "boolean", pa.int64(): "long"}
    found = _dealt(files).mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in ROWS.items()))
    return found.withColumn("page_id", F.col("page_id").cast(id_type))
