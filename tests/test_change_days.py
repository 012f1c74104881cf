"""Rows by day of change: windows against the plain filter, and what they read."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from starloom.plans.change_days import ChangeDays
from starloom.sources.watermark import change_window, inclusive_watermark

SCHEMA = "id long, v int, row_hash string, updated_at timestamp_ntz, created_at timestamp_ntz"


def at(day, hour=0):
    return None if day is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def rows(spark, data):
    return spark.createDataFrame([(i, v, f"h{v}.{u}.{c}", at(u, 5), at(c, 3)) for i, v, u, c in data], SCHEMA)


@pytest.mark.parametrize("days", [1, 5])
def test_windows_like_the_plain_filter(spark, tmp_path, days):
    rng = random.Random(8)
    t, have = ChangeDays(spark, str(tmp_path), index_blocks=5, days_per_block=days), {}
    for load in range(3):
        ids = rng.sample(range(40), 15)
        data = [(i, rng.randrange(3), rng.choice([None, rng.randrange(12)]), rng.choice([None, rng.randrange(12)])) for i in ids]
        n_new = len([d for d in data if d[0] not in have])
        n_changed = len([d for d in data if d[0] in have and have[d[0]] != d])
        done = t.load(rows(spark, data))
        assert (done.rows_inserted, done.rows_updated) == (n_new, n_changed)
        have |= {d[0]: d for d in data}
        plain = rows(spark, list(have.values()))
        assert sorted(map(str, t.read().collect())) == sorted(map(str, plain.collect()))
        for lo, hi in ((0, 4), (3, 9), (11, 30), (5, 5)):
            start, end = at(lo, 4), at(hi, 4)
            want = change_window(plain, start, end, ["updated_at", "created_at"])
            assert sorted(map(str, t.window(start, end).collect())) == sorted(map(str, want.collect()))
        assert sorted(map(str, t.upto(at(6, 3)).collect())) == sorted(map(str, inclusive_watermark(plain, at(6, 3)).collect()))
        t.remove_versions(keep=1)


def _days(df):
    return {p.split("_block=")[1].split("/")[0] for p in df.inputFiles()}


def test_a_window_reads_its_days(spark, tmp_path):
    t = ChangeDays(spark, str(tmp_path))
    t.load(rows(spark, [(i, 1, None, i % 30) for i in range(300)] + [(1000, 1, None, None)]))
    assert len(t.days()) == 31 and "none" in t.days()
    w = t.window(at(4), at(7))
    assert _days(w) == {"2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"} and w.count() == 30
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "_block=2024-01-05" in plan or "4 paths" in plan
    assert t.upto(at(400)).count() == 300 and t.read().count() == 301
    # A moved row leaves its day; the other days keep their files.
    folders = t._rows.folders()
    done = t.load(rows(spark, [(5, 2, 40, 5), (301, 1, None, 7)]))
    assert (done.rows_inserted, done.rows_updated) == (1, 1) and done.blocks_written == ("2024-01-06", "2024-01-08", "2024-02-10")
    assert done.rows_written == 9 + 2 and len(t._rows.folders()["2024-01-08"]) == 2
    assert {d: f for d, f in t._rows.folders().items() if d not in done.blocks_written} == {d: f for d, f in folders.items() if d not in done.blocks_written}
    assert t.window(at(5), at(6)).count() == 9 and [r.id for r in t.window(at(40), at(41)).collect()] == [5]
    before = sorted(os.listdir(tmp_path / "rows"))
    assert t.load(rows(spark, [(5, 2, 40, 5)])).rows_unchanged == 1 and sorted(os.listdir(tmp_path / "rows")) == before
    # The last row of a day moves: the day is gone.
    t.load(rows(spark, [(5, 3, 50, 5)]))
    assert "2024-02-10" not in t.days() and t.read().count() == 302


def test_a_failure_between_index_and_rows(spark, tmp_path):
    t = ChangeDays(spark, str(tmp_path), index_blocks=3)
    t.load(rows(spark, [(1, 1, None, 1), (2, 1, None, 2)]))
    real = t._rows._commit

    def lost(*a, **k):
        raise RuntimeError("lost")
    t._rows._commit = lost
    with pytest.raises(RuntimeError, match="lost"):
        t.load(rows(spark, [(1, 2, 5, 1), (3, 1, None, 3)]))
    assert {(r.id, r.v) for r in t.read().collect()} == {(1, 1), (2, 1)}
    t._rows._commit = real
    again = ChangeDays(spark, str(tmp_path), index_blocks=3)
    done = again.load(rows(spark, [(1, 2, 5, 1), (3, 1, None, 3)]))
    assert (done.rows_inserted, done.rows_updated) == (1, 1)
    assert {(r.id, r.v) for r in again.read().collect()} == {(1, 2), (2, 1), (3, 1)} and again.read().count() == 3
    again.remove_versions(keep=1)
    assert again.load(rows(spark, [(1, 2, 5, 1)])).rows_unchanged == 1


def test_odd_extracts(spark, tmp_path):
    t = ChangeDays(spark, str(tmp_path), index_blocks=3)
    assert t.read() is None and t.window(at(0), at(9)) is None
    assert t.load(rows(spark, [])).rows_read == 0
    t.load(rows(spark, [(None, 1, None, 1), (None, 1, None, 1), (7, 1, 1, 1), (7, 2, 3, 1)]))
    assert t.read().count() == 3 and t.read().where("id = 7").first().v == 2
    t.load(rows(spark, [(None, 1, None, 1)]))
    assert t.read().where("id IS NULL").count() == 3
    with pytest.raises(ValueError, match="columns differ"):
        t.load(rows(spark, [(1, 1, 1, 1)]).withColumn("x", F.lit(1)))
    for k in range(10):      # a day in many folders becomes one
        t.load(rows(spark, [(100 + k, 1, None, 1)]))
    assert len(t._rows.folders()["2024-01-02"]) <= 8 and t.read().count() == 14
