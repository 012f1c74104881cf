"""WARC archives with segmented records: writing pages, and reassembling them from the archives (op5).

Writing: each page is an HTTP response record whose body uses chunked transfer coding, or a revisit record if its payload equals
that of a page with a larger id. A record whose block exceeds ``segment_bytes`` becomes a first segment and
continuation records, tied by the first one's id (WARC-Segment-Origin-ID), numbered, the last with the total length.
Records go out as raw bytes through Spark's text writer, separated by the two line ends that close a record, so
archives are written by tasks, committed by Spark's protocol, and may lie in any store Spark can reach.

Reading: archives are split at the version line of each record (a text without a repeated beginning, so that
readers which look for it buffer by buffer cannot miss it). Whole records are decoded as they are read; segments are grouped by
origin id, ordered by number, checked against the total length and each segment's own length, and joined. Only
segmented records are shuffled, and a group is one record. The writer cuts a chunk inside any version text of a payload, and
encodes one in a URL, so no page can break the split.

Defined cases: null html is an empty payload; equal payloads of rows with the same (largest) page_id are all responses; a segment
that was archived twice is used once, and a record archived n times is returned n times; a record with a missing or damaged
segment is returned with ``error`` set, never silently. An empty table gives empty archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import ensure_checkpoint_dir, load, slices, workers_import

#: Payloads of at least this many bytes are deduplicated.
DEDUP_BYTES = 0
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10

#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
_START = VERSION.rstrip()
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer coding. A chunk ends inside every version text that the payload holds."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + size, len(payload))
        found = payload.find(_START, at, min(end + len(_START), len(payload)))
        if found >= 0:
            end = min(end, found + 4)
        out.append(b"%x\r\n%s\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunk(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is wrong."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if size < 0:
            raise ValueError("negative chunk")
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk length and data differ")
        out.append(body[at:at + size])
        at += size + 2


def _header(fields: list[tuple[str, object]]) -> bytes:
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def records_of(page_id, url, payload: bytes, refers_to, segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """The record, or segments, of one page; each without the two line ends that follow it."""
    digest = base32_sha1(payload)
    name = f"page/{page_id}/{digest}"
    record = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
    # A header is one line: control characters of a URL are percent-encoded.
    target = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "").replace("WARC/1.", "WARC%2F1.")
    common = [("WARC-Target-URI", target), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Page-ID", "" if page_id is None else page_id),
              ("WARC-Payload-Length", len(payload))]
    if refers_to is not None:
        other = uuid.uuid5(uuid.NAMESPACE_URL, f"page/{refers_to}/{digest}")
        return [_header([("WARC-Type", "revisit"), ("WARC-Record-ID", record), *common, ("WARC-Refers-To", f"<urn:uuid:{other}>"),
                         ("WARC-Refers-To-Page-ID", refers_to),
                         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Length", 0)])]
    block = _HTTP + chunked(payload)
    kind = [("WARC-Type", "response"), ("WARC-Record-ID", record), *common, ("Content-Type", "application/http;msgtype=response")]
    if len(block) <= segment_bytes:
        return [_header([*kind, ("Content-Length", len(block))]) + block]
    parts = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    out = [_header([*kind, ("WARC-Segment-Number", 1), ("Content-Length", len(parts[0]))]) + parts[0]]
    for n, part in enumerate(parts[1:], 2):
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{n}')}>"
        out.append(_header([("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Segment-Origin-ID", record),
                            ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None),
                            ("WARC-Target-URI", target), ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Length", len(part))]) + part)
    return out


def with_revisits(pages: DataFrame, least: int = DEDUP_BYTES) -> DataFrame:
    """page_id, url, payload (binary) and refers_to: the largest page_id with the same payload, if that is another."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.when(F.octet_length("payload") >= least, F.unhex(F.sha1("payload"))))
    # Counted on digests alone, combined before the shuffle; only payloads that occur again are joined back.
    again = (rows.where(F.col("digest").isNotNull()).groupBy("digest")
             .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = rows.join(again, "digest", "left")
    return joined.select("page_id", "url", "payload", F.when(F.col("last") != F.coalesce("page_id", F.lit(-1)), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``with_revisits`` rows as archives under ``path``, one for each task, compressed."""
    def build(batches):
        for batch in slices(batches, "payload"):
            records = [r for page in zip(*[c.to_pylist() for c in batch.columns], strict=True)
                       for r in records_of(*page, segment_bytes)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    workers_import(pages.sparkSession)
    (pages.select("page_id", "url", "payload", "refers_to").mapInArrow(build, "record binary")
     .select(F.col("record").cast("string").alias("value"))  # bytes as they are: the writer does not look at them
     .write.option("lineSep", RECORD_END).option("compression", "gzip").text(path))


RECORDS = ("type string, record_id string, origin_id string, segment int, total long, length long, page_id long, uri string, "
           "digest string, payload_length long, refers_to long, block binary, error string")
_NAMES = [f.split()[0] for f in RECORDS.split(", ")]


def parse_record(raw: bytes) -> dict:
    """The fields of one record, given as its bytes from the version line or behind it."""
    head, _, block = (raw if not raw.startswith(VERSION) else raw[len(VERSION):]).partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()

    def number(key):
        v = fields.get(key, "")
        return int(v) if v.lstrip("-").isdigit() else None
    length = number("content-length")
    error = None
    if length is None:
        error = "no content length"
    elif len(block) < length:
        error = "record is cut short"
    else:
        block = block[:length]
    return {"type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "origin_id": fields.get("warc-segment-origin-id"),
            "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"), "length": length,
            "page_id": number("warc-page-id"), "uri": fields.get("warc-target-uri"),
            "digest": (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
            "payload_length": number("warc-payload-length"), "refers_to": number("warc-refers-to-page-id"), "block": block, "error": error}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, segments apart."""
    workers_import(spark)
    lines = spark.read.option("lineSep", VERSION.decode()).text(path).select(F.col("value").cast("binary"))

    def parse(batches):
        for batch in slices(batches, "value"):
            rows = [parse_record(raw) for raw in batch.column(0).to_pylist() if raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], kind) for n, kind in zip(_NAMES, _arrow_types(), strict=True)], _NAMES)
    return lines.mapInArrow(parse, RECORDS)


def _arrow_types() -> list[pa.DataType]:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return [kinds[f.split()[1]] for f in RECORDS.split(", ")]


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: unsegmented ones as they are, segmented ones joined in order of their number."""
    whole = records.where((F.col("type") != "continuation") & F.col("segment").isNull())
    parts = records.where(F.col("segment").isNotNull()).withColumn("origin", F.coalesce("origin_id", "record_id"))
    first = F.col("segment") == 1
    carried = [n for n in _NAMES if n not in ("block", "error", "total", "length", "record_id", "origin_id", "segment", "type")]
    # A group is the segments of one record; the set drops segments that were archived again.
    grouped = parts.groupBy("origin").agg(
        F.collect_set(F.struct("segment", "length", "block")).alias("segments"), F.max("total").alias("total"),
        F.greatest(F.count_if(first), F.lit(1)).alias("copies"), F.max("error").alias("bad"),
        *[F.max(F.when(first, F.col(n))).alias(n) for n in carried])
    ordered = grouped.withColumn("segments", F.array_sort("segments"))
    block = F.aggregate("segments", F.lit(b""), lambda a, s: F.concat(a, s["block"]))
    numbers = F.transform("segments", lambda s: s["segment"])
    joined = ordered.withColumn("block", block).withColumn(
        "error", F.coalesce(
            "bad", F.when(numbers != F.sequence(F.lit(1), F.size("segments")), F.lit("segments are missing or differ")),
            F.when(F.col("total").isNull(), F.lit("no total length")),
            F.when(F.octet_length("block") != F.col("total"), F.lit("total length differs"))))
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.lit("response").alias("type"), F.col("origin").alias("record_id"), F.lit(None).cast("string").alias("origin_id"),
        F.lit(None).cast("int").alias("segment"), "total", F.octet_length("block").cast("long").alias("length"), *carried, "block", "error")
    return whole.unionByName(joined)


PAGES = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary, "
         "error string")


def decode_pages(records: DataFrame, payloads: bool = True) -> DataFrame:
    """Pages from whole records: the HTTP head is removed, the chunked body decoded, its digest checked."""
    def decode(batches):
        for batch in slices(batches, "block"):
            rows = []
            for r in batch.to_pylist():
                error, payload = r["error"], None
                if r["type"] == "response" and error is None:
                    head, _, body = r["block"].partition(b"\r\n\r\n")
                    try:
                        payload = unchunk(body) if b"chunked" in head.lower() else body
                    except ValueError as why:
                        error = f"bad chunked framing: {why}"
                    if payload is not None and r["digest"] not in (None, digest := base32_sha1(payload)):
                        error = "payload digest differs"
                size = len(payload) if payload is not None else r["payload_length"]
                rows.append((r["page_id"], size, digest if payload is not None else r["digest"], r["type"], r["refers_to"], r["uri"],
                             payload if payloads else None, error))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                             [f.split()[0] for f in PAGES.split(", ")])
    return records.mapInArrow(decode, PAGES)


def op5_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as archives in the shared folder, then read them back."""
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(with_revisits(load(spark, sf_dir, "pages")), folder)
    pages = decode_pages(reassemble(read_records(spark, folder)), payloads=False)
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


#: DuckDB SQL for op5 (base32 from the hex digest, five bits at a time).
SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes, hex, max(page_id) OVER (PARTITION BY hex) AS last,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(hex, 1 + 10 * CAST(i // 8 AS INT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31 AS INT), 1)), '') AS digest
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM d
"""
