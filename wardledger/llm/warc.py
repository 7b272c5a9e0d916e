"""WARC archives: one gzip member per record, written by tasks and read sequentially.

Each task writes files of its own below a shared folder; the names of those that a
finished task wrote come back as a table (the manifest), so files of lost or
repeated tasks are never read. A reader streams a file: inflate some KB, find the
header, count ``Content-Length`` bytes and hash them as they pass. It holds one
buffer and, if asked for, one payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_path, stored

DATE = "1970-01-01T00:00:00Z"  # fixed, so that archives of equal pages are equal
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"
CHUNK = 1 << 18
FILE_BYTES = 64 << 20


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _header_value(text: str) -> str:
    """Control characters would end the line: they are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _record(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    lines = [*headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return gz.compress(head.encode()) + gz.compress(block) + gz.compress(b"\r\n\r\n") + gz.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, level: int = 6) -> bytes:
    """A response with its payload, or a revisit of the page ``refers_to`` without."""
    digest = "sha1:" + digest_text(hashlib.sha1(payload).digest())
    headers = [("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_value(url)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        kind, block = "response", http + payload
    else:
        kind, block = "revisit", http
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    headers += [
        ("WARC-Type", kind),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", "sha1:" + digest_text(hashlib.sha1(block).digest())),
    ]
    return _record(headers, block, level)


@dataclass
class Record:
    headers: dict[str, str]
    payload_bytes: int = 0
    payload_digest: str = ""
    block_digest: str = ""
    payload: bytes | None = None
    _pieces: list[bytes] = field(default_factory=list)


def read_records(stream: BinaryIO, keep_payload: bool = True) -> Iterator[Record]:
    """The records of one archive in order; a damaged or cut archive raises ``ValueError``."""
    raw = b""
    while raw or (raw := stream.read(CHUNK)):
        member = zlib.decompressobj(31)
        text = b""

        def more() -> bytes:
            nonlocal raw
            while not member.eof:
                if not raw and not (raw := stream.read(CHUNK)):
                    raise ValueError("the archive ends inside a record")
                got = member.decompress(raw, CHUNK)
                raw = member.unused_data if member.eof else member.unconsumed_tail
                if got:
                    return got
            return b""

        while b"\r\n\r\n" not in text:
            if not (got := more()):
                raise ValueError("a record without header")
            text += got
        head, _, rest = text.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record: {first[:40]!r}")
        record = Record({k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines)})
        left = int(record.headers["Content-Length"])
        http = record.headers.get("Content-Type", "").startswith("application/http")
        block, payload, opening = hashlib.sha1(), hashlib.sha1(), b""
        while left:
            if not rest and not (rest := more()):
                raise ValueError("a record is shorter than its Content-Length")
            piece, rest = rest[:left], rest[left:]
            left -= len(piece)
            block.update(piece)
            if http:
                opening += piece
                if b"\r\n\r\n" not in opening:
                    continue
                piece, http = opening.partition(b"\r\n\r\n")[2], False
            payload.update(piece)
            record.payload_bytes += len(piece)
            if keep_payload:
                record._pieces.append(piece)
        while got := more():
            rest += got
        if rest != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        record.payload_digest, record.block_digest = digest_text(payload.digest()), digest_text(block.digest())
        record.payload = b"".join(record._pieces) if keep_payload else None
        yield record


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _number(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").removeprefix(ID)
    return int(digits) if digits else None


def write_warc(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", level: int = 6
) -> DataFrame:
    """Archives of ``pages`` in a new shared folder; returns their manifest (``file``, ``records``).

    Of pages with equal payloads that with the largest id is a response and the others
    revisit it. A null html is an empty payload; a null url has no target header; a null
    id never is the largest, and pages of null ids alone are all responses. Repeated
    rows of the largest id are all responses. An empty table gives no archives.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload")})
    copies = rows.groupBy("sha", "size").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.join(copies, ["sha", "size"], "left").select(
        "id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("keep")), F.col("keep")).alias("refers_to")
    )
    target = shared_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _folder(target)
        files.create_dir(root, recursive=True)
        out, name, size, records = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, body, refers_to = (c[at].as_py() for c in batch.columns)
                if out is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    info = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Type", "warcinfo")]
                    out.write(_record([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", level))
                record = page_record(page_id, url, body, refers_to, level)
                out.write(record)
                size, records = size + len(record), records + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((name, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records))
        if done:
            yield pa.RecordBatch.from_pydict({"file": [f"{target}/{n}" for n, _ in done], "records": [r for _, r in done]})

    return stored(marked.mapInArrow(write, "file string, records bigint"), "warc-manifest")


def read_warc(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Records of the archives named in ``file``: ``page_id``, ``record_type``, ``refers_to``,
    ``payload_bytes``, ``payload_digest`` (as stated), ``digest_ok`` (as computed), ``url``, ``payload``.

    A revisit has no payload of its own: 0 bytes, and only its block can be verified.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "digest_ok", "url", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                files, path = _folder(uri)
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for r in read_records(stream, keep_payload):
                        h = r.headers
                        if h["WARC-Type"] not in ("response", "revisit"):
                            continue
                        stated = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        ok = h["WARC-Block-Digest"] == "sha1:" + r.block_digest
                        if h["WARC-Type"] == "response":
                            ok = ok and stated == r.payload_digest
                        rows.append((_number(h["WARC-Record-ID"]), h["WARC-Type"], _number(h.get("WARC-Refers-To")), r.payload_bytes, stated, ok, h.get("WARC-Target-URI"), r.payload))
                        held += r.payload_bytes if keep_payload else 0
                        if len(rows) >= 4096 or held >= 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    files = manifest.select("file")
    spread = files.repartition(max(1, files.count()))  # a task for each archive
    return spread.mapInArrow(
        read,
        "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
        "digest_ok boolean, url string, payload binary",
    )


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Writes ``pages``, reads the archives and resolves revisits: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``, ``digest_ok``. One row per row of ``pages``.

    A revisit has the size of the response it refers to, which must have its digest too.
    """
    records = stored(read_warc(write_warc(pages, **columns), keep_payload=False).drop("payload", "url"), "warc-records")
    responses = (
        records.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("full_bytes"))
    )
    revisits = records.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
    columns_out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"]
    resolved = revisits.withColumn("digest_ok", F.col("digest_ok") & F.col("full_bytes").isNotNull())
    resolved = resolved.withColumn("payload_bytes", F.col("full_bytes")).select(columns_out)
    return records.where("record_type = 'response'").select(columns_out).unionByName(resolved)


_DIGEST = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '')"""
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT page_id, strlen(t) AS n, h, max(page_id) OVER (PARTITION BY t) AS keep FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_DIGEST} AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to, true AS digest_ok
FROM m
"""
