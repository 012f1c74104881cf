"""Work tables: what is kept on disk between the steps of a run."""

import datetime as dt
import os

from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash
from starloom.plans.staging import SPEC_BY_NAME, run_staging
from starloom.session import checkpoint_rows, cut_lineage, discard, ensure_checkpoint_dir, shuffles_removed


def _folder(spark):
    return ensure_checkpoint_dir(spark).removeprefix("file:")


def _held(spark):
    return {n for n in os.listdir(_folder(spark)) if n.startswith("work-")}


def _size(path):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(path) for f in files)


def test_constants_of_a_work_table_take_no_room(spark):
    before = _held(spark)
    rows = spark.range(20_000).select("id", *[F.lit("a constant of the envelope").alias(f"c{i}") for i in range(10)])
    kept = cut_lineage(rows)
    (name,) = _held(spark) - before
    assert _size(os.path.join(_folder(spark), name)) < 20 * 20_000
    assert kept.schema.simpleString() == rows.schema.simpleString() and kept.exceptAll(rows).count() == 0 and kept.count() == 20_000
    discard(kept)
    assert name not in _held(spark)


def test_rows_that_parquet_cannot_hold_are_checkpointed(spark):
    before = _held(spark)
    odd = spark.range(3).select("id", F.lit(None).alias("nothing"), F.col("id").alias("ID"))
    assert [tuple(r) for r in cut_lineage(odd).collect()] == [(i, None, i) for i in range(3)]
    assert _held(spark) == before
    discard(checkpoint_rows(odd))


def test_no_rows_keep_their_columns(spark):
    none = cut_lineage(spark.createDataFrame([], "a int, b timestamp_ntz, c decimal(18,2)"))
    assert none.count() == 0 and none.dtypes == [("a", "int"), ("b", "timestamp_ntz"), ("c", "decimal(18,2)")]


def test_a_staging_run_keeps_one_copy_of_a_table(spark):
    day = dt.datetime(2020, 1, 1)
    donors = spark.range(1, 15_001).select(
        F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), F.col("id")).alias("full_name"), F.lit(None).cast("string").alias("national_id"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("email"),
        F.when(F.col("id") % 10 == 0, "nobody").otherwise("individual").alias("donor_type"), F.lit(True).alias("is_active"),
        F.lit(day).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    before = _held(spark)
    out, log = run_staging(spark, "finance_ops", {"donors": donors}, {}, day, specs=("donors",))
    assert len(_held(spark) - before) == 1
    assert (log.first().rows_read, log.first().rows_valid, log.first().rows_rejected) == (15_000, 13_500, 1_500)
    rows = out["donors"].orderBy("id").select("id", "stg_row_id", "row_hash", "is_valid", "source_table").collect()
    assert [(r.id, r.stg_row_id) for r in rows] == [(i, n) for n, i in enumerate((i for i in range(1, 15_001) if i % 10), 1)]
    assert all(len(r.row_hash) == 64 and r.is_valid and r.source_table == "donors" for r in rows)


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_work_table_leaves_no_shuffle_behind(spark):
    before = _shuffle_files(spark)
    rows = spark.range(1_000).select((F.col("id") % 7).alias("k"), "id").groupBy("k").agg(F.sum("id").alias("s"))
    kept = cut_lineage(rows.repartition(5, "s"))
    assert not _shuffle_files(spark) - before
    assert kept.count() == 7 and rows.count() == 7
    discard(kept)


def test_the_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with shuffles_removed(spark), shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def _donors(spark, ids, title, updated):
    return spark.range(*ids).select(
        F.col("id").cast("int").alias("id"), F.concat(F.lit(title), F.col("id")).alias("full_name"), F.lit(None).cast("string").alias("national_id"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("email"), F.lit("individual").alias("donor_type"),
        F.lit(True).alias("is_active"), F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz").alias("created_at"),
        F.lit(updated).cast("timestamp_ntz").alias("updated_at"))


def test_staged_tables_store_no_hash_that_follows_from_the_columns(spark, monkeypatch):
    from dataclasses import replace

    from starloom.plans import staging
    spec = replace(SPEC_BY_NAME["donors"], load="upsert")
    monkeypatch.setattr(staging, "SPECS", [spec])
    day = dt.datetime(2020, 1, 1)
    before = _held(spark)
    first, _ = run_staging(spark, "finance_ops", {"donors": _donors(spark, (1, 15_001), "n", day)}, {}, day, 1)
    (name,) = _held(spark) - before
    assert "row_hash" not in spark.read.parquet(f"{_folder(spark)}/{name}").columns
    # Ids to 100 carry a hash of another loader; ids from 50 on are loaded again, of which those that differ and the new ones change.
    old = first["donors"].withColumn("row_hash", F.when(F.col("id") <= 100, F.lit("odd")).otherwise(F.col("row_hash")))
    later = dt.datetime(2020, 2, 1)
    second, log = run_staging(spark, "finance_ops", {"donors": _donors(spark, (51, 30_001), "n", day)}, {"donors": old}, later, 2)
    assert (log.first().rows_inserted, log.first().rows_updated) == (15_000, 50)
    rows = second["donors"]
    assert rows.where("row_hash = 'odd'").agg(F.min("id"), F.max("id"), F.count("id")).first()[:] == (1, 50, 50)
    assert rows.where("id > 50").where(F.col("row_hash") != row_hash(*spec.source_columns())).count() == 0
    assert rows.where("stg_row_id = id").count() == rows.count() == 30_000
    batches = {r.etl_batch_id: r["count"] for r in rows.groupBy("etl_batch_id").count().collect()}
    assert batches == {1: 14_950, 2: 15_050}


def test_large_tables_are_moved_one_after_the_other(spark, monkeypatch):
    import threading

    from starloom.plans import staging
    monkeypatch.setattr(staging, "ONE_AT_A_TIME_ROWS", 10)
    moving, most, real, lock = [0], [0], staging.assign_keys, threading.Lock()

    def watched(rows, *args, **kwargs):
        with lock:
            moving[0] += 1
            most[0] = max(most[0], moving[0])
        try:
            out = real(rows, *args, **kwargs)
            out.count()
            return out
        finally:
            with lock:
                moving[0] -= 1
    monkeypatch.setattr(staging, "assign_keys", watched)
    day = dt.datetime(2020, 1, 1)
    donors = _donors(spark, (1, 51), "n", day)
    titles = donors.select("id", F.col("full_name").alias("name"), "is_active", "created_at", "updated_at")
    out, _ = run_staging(spark, "finance_ops", {"donors": donors, "expense_categories": titles}, {}, day, specs=("donors", "expense_categories"))
    assert out["donors"].count() == out["expense_categories"].count() == 50 and most[0] == 1
