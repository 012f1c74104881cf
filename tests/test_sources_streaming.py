"""CSV dataset round trip (SC9) and the streaming incremental staging runner."""

import datetime as dt
import os
import tempfile

from starloom.plans import schemas
from starloom.sources.csv_dataset import read_manifest, read_table, write_dataset
from starloom.streaming.incremental import latest_version, stage_stream
from tests import finance_fixture as fx


def test_csv_dataset_round_trip(spark):
    folder = tempfile.mkdtemp(prefix="starloom-csv-")
    src = fx.sources(spark, fx.first_load_rows())
    manifest = write_dataset({"donations": src["donations"], "budget_allocations": src["budget_allocations"]}, folder)
    m = {r.table: r.rows for r in read_manifest(spark, folder).collect()}
    assert m == {"donations": 3, "budget_allocations": 4}
    back = read_table(spark, folder, "budget_allocations")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src["budget_allocations"].collect()))
    assert manifest.count() == 2


def test_stream_stages_new_extracts(spark):
    base = tempfile.mkdtemp(prefix="starloom-stream-")
    landing, target, ckpt = (os.path.join(base, x) for x in ("landing", "target", "ckpt"))
    rows = fx.first_load_rows()
    donors = schemas.from_rows(spark, "donors", rows["donors"])
    campaigns = schemas.from_rows(spark, "campaigns", rows["campaigns"])
    parents = {"donors": donors, "campaigns": campaigns}
    schemas.from_rows(spark, "donations", rows["donations"][:2]).write.parquet(os.path.join(landing, "b1"))
    q = stage_stream(spark, "donations", landing, target, ckpt, parents=parents)
    q.awaitTermination(120)
    assert q.exception() is None, q.exception()
    v1 = latest_version(spark, "donations", target)
    assert v1.count() == 2
    schemas.from_rows(spark, "donations", rows["donations"][2:]).write.parquet(os.path.join(landing, "b2"))
    q = stage_stream(spark, "donations", landing, target, ckpt, parents=parents)
    q.awaitTermination(120)
    assert q.exception() is None, q.exception()
    v2 = latest_version(spark, "donations", target)
    assert v2.count() == 3
    assert v2.filter("id = 103").collect()[0].stg_row_id == 3
    assert isinstance(dt.datetime.now(), dt.datetime)


def test_stream_restart_without_new_files_changes_nothing(spark):
    base = tempfile.mkdtemp(prefix="starloom-stream-")
    landing, target, ckpt = (os.path.join(base, x) for x in ("landing", "target", "ckpt"))
    rows = fx.first_load_rows()
    parents = {"donors": schemas.from_rows(spark, "donors", rows["donors"]),
               "campaigns": schemas.from_rows(spark, "campaigns", rows["campaigns"])}
    schemas.from_rows(spark, "donations", rows["donations"]).write.parquet(os.path.join(landing, "b1"))
    q = stage_stream(spark, "donations", landing, target, ckpt, parents=parents)
    q.awaitTermination(120)
    assert q.exception() is None, q.exception()
    before = sorted(tuple(r) for r in latest_version(spark, "donations", target).collect())
    versions = sorted(os.listdir(target))
    q = stage_stream(spark, "donations", landing, target, ckpt, parents=parents)   # restart, same checkpoint
    q.awaitTermination(120)
    assert q.exception() is None, q.exception()
    assert sorted(os.listdir(target)) == versions
    assert sorted(tuple(r) for r in latest_version(spark, "donations", target).collect()) == before


def _stream(spark, table, base, landing):
    q = stage_stream(spark, table, landing, os.path.join(base, "target"), os.path.join(base, "ckpt"), parents={})
    q.awaitTermination(120)
    assert q.exception() is None, q.exception()
    return latest_version(spark, table, os.path.join(base, "target"))


def test_stream_of_a_full_refresh_table_keeps_earlier_files(spark):
    base = tempfile.mkdtemp(prefix="starloom-stream-")
    landing = os.path.join(base, "landing")
    rows = fx.first_load_rows()["donors"]
    assert len(rows) >= 2
    schemas.from_rows(spark, "donors", rows[:1]).write.parquet(os.path.join(landing, "b1"))
    assert _stream(spark, "donors", base, landing).count() == 1
    schemas.from_rows(spark, "donors", rows[1:]).write.parquet(os.path.join(landing, "b2"))
    assert _stream(spark, "donors", base, landing).count() == len(rows)


def test_two_files_for_one_id_in_one_batch(spark):
    from pyspark.sql import functions as F
    base = tempfile.mkdtemp(prefix="starloom-stream-")
    landing = os.path.join(base, "landing")
    first = schemas.from_rows(spark, "donors", fx.first_load_rows()["donors"])
    later = first.withColumns({"full_name": F.lit("later"), "updated_at": F.lit(dt.datetime(2027, 1, 1)).cast("timestamp_ntz")})
    first.withColumn("updated_at", F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz")).write.parquet(os.path.join(landing, "b1"))
    later.write.parquet(os.path.join(landing, "b2"))
    out = _stream(spark, "donors", base, landing).collect()
    assert len(out) == len({r.id for r in out}) == first.count() and {r.full_name for r in out} == {"later"}
    later.withColumn("full_name", F.lit("again")).write.parquet(os.path.join(landing, "b3"))
    later.withColumn("full_name", F.lit("again")).write.parquet(os.path.join(landing, "b4"))
    again = _stream(spark, "donors", base, landing).collect()
    assert sorted((r.id, r.stg_row_id) for r in again) == sorted((r.id, r.stg_row_id) for r in out) and {r.full_name for r in again} == {"again"}


def test_written_versions_hold_no_stale_rows(spark):
    """A recomputed accumulation group has another date key: the old row must not survive in its old partition."""
    from starloom.plans.tables import read_tables, write_tables
    root = tempfile.mkdtemp(prefix="starloom-tables-")
    schema = "child_key long, snapshot_date_key int, n int"
    day = "child_key long, date_key int, n int"
    write_tables({"fact_child_snapshot_accumulation": spark.createDataFrame([(1, 20280101, 1), (2, 20280101, 1)], schema),
                  "fact_x": spark.createDataFrame([(1, 20280101, 1), (1, 20280102, 1)], day)}, root)
    second = {"fact_child_snapshot_accumulation": spark.createDataFrame([(1, 20280102, 2), (2, 20280101, 1)], schema),
              "fact_x": spark.createDataFrame([(1, 20280101, 5)], day)}
    got = read_tables(spark, write_tables(second, root))
    for name, df in second.items():
        assert sorted(map(tuple, got[name].select(df.columns).collect())) == sorted(map(tuple, df.collect()))
