import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import warc
from starloom.llm.common import workers_import
from tests.conftest import SF_ORACLE


@given(st.binary(max_size=300), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_chunked_round_trip(payload, size):
    assert warc.unchunk(warc.chunked(payload, size)) == payload


@given(st.lists(st.sampled_from([b"\r\n\r\nWARC/1.1\r\n", b"\r\n", b"WARC/1.", b"WARC/1.1", b"x"]), max_size=12), st.integers(1, 50))
@settings(max_examples=200, deadline=None)
def test_no_payload_can_look_like_a_record(parts, size):
    payload = b"".join(parts)
    for record in warc.records_of(1, "http://a/WARC/1.1", payload, None, segment_bytes=size + 60):
        assert record.startswith(warc.VERSION) and record.count(warc.VERSION) == 1
    assert warc.unchunk(warc.chunked(payload, size)) == payload


@pytest.mark.parametrize("body", [b"5\r\nab\r\n0\r\n\r\n", b"zz\r\n", b"", b"2\r\nabXX0\r\n\r\n", b"-1\r\n"])
def test_bad_framing_is_an_error(body):
    with pytest.raises(ValueError):
        warc.unchunk(body)


def pages_of(spark, rows):
    workers_import(spark)
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)


def archive(spark, tmp_path, rows, **options):
    path = f"file://{tmp_path}/w"
    warc.write_archives(warc.with_revisits(pages_of(spark, rows)), path, **options)
    return path


ROWS = [(1, "http://a/", "same"), (2, "http://b/x?y", "same"), (3, None, "same"), (4, "u\r\nX: y", None), (5, "", ""), (6, "é", "é" * 500),
        (7, "h", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 30), (7, "h", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 30),
        (8, "b", "<html>" + "x" * 5000), (None, "n", "null id"), (9, "c", "0\r\n\r\n")]


@pytest.mark.parametrize("segment_bytes", [60, 128, 1 << 20])
def test_round_trip_with_segments_and_revisits(spark, tmp_path, segment_bytes):
    path = archive(spark, tmp_path, ROWS, segment_bytes=segment_bytes)
    records = warc.read_records(spark, path)
    kinds = {r.type for r in records.collect()}
    assert ("continuation" in kinds) == (segment_bytes < 1 << 20)
    got = warc.decode_pages(warc.reassemble(records)).collect()
    assert len(got) == len(ROWS) and not any(r.error for r in got)
    last = {}
    for i, _, h in ROWS:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in ROWS:
        data, first = (h or "").encode(), last[h or ""]
        revisit = i is not None and i != first
        want.append((i, len(data), warc.base32_sha1(data), "revisit" if revisit else "response", first if revisit else None, None if revisit else data))
    have = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert {r.url for r in got} >= {"http://a/", "u%0D%0AX: y", "é"}


def test_lost_doubled_and_cut_segments(spark, tmp_path):
    path = archive(spark, tmp_path, [(1, "a", "x" * 900), (2, "b", "y" * 900), (3, "c", "z" * 100)], segment_bytes=200)
    records = warc.read_records(spark, path).cache()
    one = records.where("page_id = 1 AND segment = 1").first().record_id
    origin = F.coalesce("origin_id", "record_id")
    lost = warc.decode_pages(warc.reassemble(records.where((origin != one) | (F.coalesce("segment", F.lit(0)) != 3)))).collect()
    assert {r.page_id: r.error for r in lost} == {1: "segments are missing or differ", 2: None, 3: None}
    last = records.where((origin != one) | F.col("total").isNull())
    assert {r.page_id: r.error for r in warc.decode_pages(warc.reassemble(last)).collect()}[1] == "no total length"
    doubled = records.unionByName(records.where(origin == one))
    assert sorted((r.page_id, r.error, r.payload_bytes) for r in warc.decode_pages(warc.reassemble(doubled)).collect()) == [
        (1, None, 900), (1, None, 900), (2, None, 900), (3, None, 100)]
    changed = records.withColumn("block", F.when((origin == one) & (F.col("segment") == 2), F.translate(F.col("block").cast("string"), "x", "w").cast("binary")).otherwise(F.col("block")))
    assert {r.page_id: r.error for r in warc.decode_pages(warc.reassemble(changed)).collect()}[1] == "payload digest differs"
    records.unpersist()


def test_cut_record():
    raw = warc.records_of(5, "u", b"payload", None)[0]
    assert warc.parse_record(raw)["error"] is None
    assert warc.parse_record(raw[:-3])["error"] == "record is cut short"
    assert warc.parse_record(b"no header")["error"] == "no content length"


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_ORACLE}/pages.parquet'")
    want = con.execute(warc.SQL).fetchall()
    columns = [d[0] for d in con.description]
    got = [tuple(r[c] for c in columns) for r in warc.op5_warc_segments(spark, SF_ORACLE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_random_pages_round_trip(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, f"http://h/{i}", "".join(rng.choice(["\r\n", "WARC/1.1", "\x00", "ü", "0\r\n\r\n", "a" * 50]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    got = warc.decode_pages(warc.reassemble(warc.read_records(spark, archive(spark, tmp_path, rows, segment_bytes=97)))).collect()
    texts = {i: h for i, _, h in rows}
    assert len(got) == len(rows) and all(r.error is None for r in got)
    assert all(bytes(r.payload).decode() == texts[r.page_id] for r in got if r.record_type == "response")


def test_many_records_across_reader_buffers(spark, tmp_path):
    """Thousands of small records put record ends at every place of a reader's buffer."""
    rows = [(i, f"http://h/{i}", "y" * (i % 97) + f"{i}") for i in range(6000)]
    path = f"file://{tmp_path}/many"
    warc.write_archives(warc.with_revisits(pages_of(spark, rows).coalesce(1)), path)
    got = warc.decode_pages(warc.reassemble(warc.read_records(spark, path)), payloads=False)
    assert got.count() == len(rows) and got.where("error IS NOT NULL").count() == 0


def test_empty_table(spark, tmp_path):
    path = archive(spark, tmp_path, [])
    assert warc.decode_pages(warc.reassemble(warc.read_records(spark, path))).count() == 0
