"""WARC archives: written by tasks, read back record by record.

Every record is a gzip member of its own. The reader streams a file in small pieces
through one zlib decompressor per member, takes the payload's length from Content-Length
and verifies the payload digest, so its memory is one record, not one file.

Records of equal payload (digest and length) share one response, that of the largest
page id; the others are revisits that refer to it. Only narrow rows (page id, digest,
length) are grouped; the payload moves once, by page id, so a payload that a third of all
pages share burdens no task. Tasks name their files by a fresh id and report them; only
reported files are read, so an attempt that was lost or ran twice leaves no record behind.

Null html counts as empty. A null page id refers to nothing as a response, and is a
revisit where another record has its payload. Rows that repeat the largest page id of a
payload are all responses. Other columns are ignored. The files lie in the shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import new_folder
from .common import named, stored

FILE_BYTES = 256 << 20
PIECE = 1 << 16
LEVEL = 4
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record, not compressed. A revisit keeps the HTTP headers only."""
    kind = "response" if refers_to is None else "revisit"
    http = _HTTP % len(payload)
    block = http + payload if refers_to is None else http
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url else []),
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(stream: BinaryIO) -> Iterator[bytes]:
    """Unpacked members of a gzip stream, one after the other. A member that ends early
    raises EOFError; damaged bytes raise zlib.error."""
    rest = b""
    while True:
        unpacker, out = zlib.decompressobj(31), []
        started = False
        while not unpacker.eof:
            piece = rest or stream.read(PIECE)
            rest = b""
            if not piece:
                if started:
                    raise EOFError("the archive ends inside a record")
                return
            started = True
            out.append(unpacker.decompress(piece))
        rest = unpacker.unused_data
        yield b"".join(out)


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


def parse(data: bytes) -> dict:
    """A record's fields. ``verified`` is false if the framing or the digest is wrong."""
    head, gap, body = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    size = int(fields.get("content-length", -1))
    block = body[:size]
    framed = head.startswith(b"WARC/1.") and bool(gap) and len(block) == size and body[size:] == b"\r\n\r\n"
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "").partition(":")[2]
    whole = int(_headers(http).get("content-length", -1))
    intact = kind == "revisit" or (len(payload) == whole and sha1_base32(payload) == digest)
    return {
        "page_id": _page(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": whole,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "verified": framed and intact,
    }


def _open(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else f"file:{uri}")
    return system, path


def write_archives(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; returns (path, records) of the files.
    Payloads under ``least_bytes`` are never revisits."""
    source = pages.select(
        named(id_col).cast("long").alias("page_id"),
        (named(url_col) if url_col in pages.columns else F.lit(None)).cast("string").alias("url"),
        F.coalesce(named(html_col), F.lit("")).cast("binary").alias("payload"),
    )
    narrow = source.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
    narrow = stored(narrow.filter(F.col("size") >= least_bytes), "warc-digests")
    shared = (
        narrow.groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull())
        .drop("n")
    )
    # One row per page and digest that is a revisit: few rows, without payload.
    revisits = (
        narrow.join(shared, ["digest", "size"])
        .filter(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("of"), F.col("digest").alias("with"), F.col("first").alias("refers_to"))
        .distinct()
    )
    joined = source.join(
        revisits, F.col("page_id").eqNullSafe(F.col("of")) & (F.sha1("payload") == F.col("with")), "left"
    ).select("page_id", "url", "payload", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        path, out, size, n, done = "", None, 0, 0, []
        for batch in batches:
            for k in range(batch.num_rows):
                if out is None:
                    path, size, n = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                page_id, url, payload, refers_to = (batch.column(c)[k].as_py() for c in range(4))
                member = gzip_member(record(page_id, url, payload, refers_to))
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        paths, numbers = ([f"{folder.rstrip('/')}/{p.rpartition('/')[2]}" for p, _ in done], [n for _, n in done])
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(numbers, pa.int64())], names=["path", "records"])

    return stored(joined.mapInArrow(write, "path string, records long"), "warc-files")


def read_archives(files: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """Records of the archives in column ``path``: page_id, url, payload (null for revisits),
    payload_bytes, payload_digest, record_type, refers_to, verified."""
    kinds = {
        "page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(),
        "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "verified": pa.bool_(),
    }

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], names=list(kinds))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for paths in batches:
            for uri in paths.column(0).to_pylist():
                system, path = _open(uri)
                with system.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        found = parse(data)
                        if not with_payload:
                            found["payload"] = None
                        rows.append(found)
                        size += len(found["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield batch(rows)
                            rows, size = [], 0
        if rows:
            yield batch(rows)

    number = max(1, files.count())  # one row per archive
    return (
        files.select("path")
        .repartition(number)
        .mapInArrow(
            read,
            "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, verified boolean",
        )
    )


def archived(pages: DataFrame, *, with_payload: bool = True, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **options), with_payload=with_payload)


