"""WARC archives as a chunked record table.

A record is a run of rows ``(record, chunk)``: row 0 holds the header, every
row at most ``chunk_bytes`` of the payload, and each carries the SHA-1 of the
payload up to its end.  A payload is written and read back one chunk at a time;
only the page's own row, which the table holds whole, is larger.  Header, chunks
in order and two line ends are the record's bytes in a WARC file.

A record's id names its page and row, that of a response of at least ``least``
bytes its page and payload digest, which is what its revisits refer to (rows
that repeat both id and payload are one capture and share it).

Records with payloads equal in bytes and at least ``least`` long share one
response: that with the largest ``page_id``; the others are revisits without
payload.  Rows with that same largest id (repeated rows) are all responses.
Null html is an empty payload; a null ``page_id`` is smaller than any other,
and a group of null ids alone is all responses.  An empty table gives an
empty archive.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

CHUNK_BYTES = 64 << 10
LEAST = 1000

ARCHIVE = "record long, chunk int, last boolean, warc_header string, payload binary, running_sha1 string"


def plan_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Each page with its payload, digest, record type and the response that it refers to."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long"), "record": F.monotonically_increasing_id()})
    # Only digests travel here; groups of one are dropped before anything is joined.
    # Written, so that the join below deals out both sides itself and can split a hot digest.
    groups = written(p.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
                     .where("n > 1").select(F.col("digest").alias("g_digest"), F.col("bytes").alias("g_bytes"), "keep"), "warc-groups")
    j = p.join(groups, (p["digest"] == groups["g_digest"]) & (p["bytes"] == groups["g_bytes"]), "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return j.select("record", "page_id", "url", "digest", "bytes", F.when(revisit, F.col("keep")).alias("refers_to"),
                    F.when(~revisit, F.col("payload")).alias("payload"))


def _header(record: int, page_id, url, digest: str, size: int, refers_to, date: str, least: int) -> str:
    kind = "response" if refers_to is None else "revisit"
    own = digest if refers_to is None and size >= least else record
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{own}>", f"WARC-Date: {date}",
             f"WARC-Target-URI: {(url or '').translate(dict.fromkeys((10, 13), ' '))}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {size}",
             f"Content-Length: {size if refers_to is None else 0}"]
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines) + "\r\n\r\n"


def write_archive(records: DataFrame, name: str = "warc", chunk_bytes: int = CHUNK_BYTES, least: int = LEAST, date: str | None = None) -> DataFrame:
    """The chunked record table, written to the shared folder.  ``date`` is the records'
    WARC-Date (``YYYY-MM-DDThh:mm:ssZ``), by default the time at which the writing begins;
    ``least`` as given to ``plan_records``."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def chunks(batches):
        for b in batches:
            rows = []
            cols = [b.column(c) for c in ("record", "page_id", "url", "digest", "bytes", "refers_to", "payload")]
            held = 0
            for i in range(b.num_rows):
                record, page_id, url, digest, size, refers = (c[i].as_py() for c in cols[:6])
                buf = cols[6][i].as_buffer() if cols[6][i].is_valid else None
                body = memoryview(buf) if buf is not None else memoryview(b"")
                sha, at, k = hashlib.sha1(), 0, 0
                while True:
                    piece = body[at:at + chunk_bytes]
                    sha.update(piece)
                    at += len(piece)
                    held += len(piece)
                    rows.append((record, k, at >= len(body), _header(record, page_id, url, digest, size, refers, date, least) if k == 0 else None,
                                 bytes(piece), sha.hexdigest() if refers is None else digest))
                    if held > (4 << 20):
                        yield _rows(rows)
                        rows, held = [], 0
                    k += 1
                    if at >= len(body):
                        break
            if rows:
                yield _rows(rows)

    return written(records.mapInArrow(chunks, ARCHIVE), name)


_ARROW = pa.schema([("record", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("warc_header", pa.string()), ("payload", pa.binary()), ("running_sha1", pa.string())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def read_archive(archive: DataFrame) -> DataFrame:
    """Each record read back: header fields, and size and SHA-1 of the payload's own bytes.

    Records of one chunk (nearly all) are read where they lie.  The chunks of
    longer ones are brought together by record and digested in order, one
    chunk in memory at a time.  ``digest_ok``: the header's digest and
    length hold for the payload read.
    """
    def field(name: str, pattern: str):
        x = F.regexp_extract("warc_header", rf"\r\n{name}: {pattern}\r\n", 1)
        return F.when(x != "", x)

    one = archive.where("chunk = 0 and last").select("record", "warc_header", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"))

    def digest(batches):
        record, header, sha, size = None, None, None, 0
        for b in batches:
            out = []
            cols = [b.column(c) for c in ("record", "chunk", "last", "warc_header", "payload")]
            for i in range(b.num_rows):
                rec, k, last, head = (c[i].as_py() for c in cols[:4])
                if k == 0:
                    record, header, sha, size = rec, head, hashlib.sha1(), 0
                if rec != record:
                    raise ValueError(f"record {rec} lacks its first chunk")
                buf = cols[4][i].as_buffer()
                sha.update(buf)
                size += buf.size
                if last:
                    out.append((record, header, size, sha.hexdigest()))
            if out:
                r, h, n, s = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(h, pa.string()), pa.array(n, pa.int64()), pa.array(s, pa.string())], names=["record", "warc_header", "bytes", "sha1"])

    many = (archive.where("not (chunk = 0 and last)").repartition("record").sortWithinPartitions("record", "chunk")
            .mapInArrow(digest, "record long, warc_header string, bytes long, sha1 string"))
    r = one.unionByName(many)
    kind, want, size = field("WARC-Type", "(\\w+)"), field("WARC-Payload-Digest", "sha1:([0-9a-f]{40})"), field("WARC-Payload-Length", "(\\d+)").cast("long")
    return r.select(
        field("WARC-Record-ID", "<urn:page:(-?\\d*):[0-9a-f]+>").alias("id_text"), F.col("record"), kind.alias("record_type"),
        F.when(kind == "response", F.col("bytes")).otherwise(size).alias("payload_bytes"),
        F.when(kind == "response", F.col("sha1")).otherwise(want).alias("payload_digest"),
        F.regexp_extract("warc_header", r"\r\nWARC-Refers-To: <urn:page:(-?\d+):[0-9a-f]{40}>\r\n", 1).alias("refers_text"),
        ((kind == "revisit") | ((F.col("sha1") == want) & (F.col("bytes") == size))).alias("digest_ok"),
    ).select(F.col("id_text").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
             F.col("refers_text").try_cast("long").alias("refers_to"), "record", "digest_ok")


def archive_pages(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, least: int = LEAST) -> DataFrame:
    """Pages written as WARC records and read back."""
    return read_archive(write_archive(plan_records(pages, least), chunk_bytes=chunk_bytes, least=least))
