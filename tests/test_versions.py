"""Several tables published as one version, and the daily snapshot's state carried through stored versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.plans import tables
from starloom.plans.mart1 import DailyState
from tests.test_intervals import SCHEMA, day, made, measures, rolled
from starloom.operators import intervals as iv


def frame(spark, value, n=3):
    return spark.range(n).select("id", F.lit(value).alias("v"))


def values(frames):
    return {name: sorted({r.v for r in df.collect()}) for name, df in frames.items()}


def test_readers_see_one_version(spark, tmp_path):
    root = str(tmp_path / "dw")
    assert tables.current(spark, root) == {}
    assert tables.publish(spark, {"a": frame(spark, 1), "b": frame(spark, 1), "fact_x": frame(spark, 1).withColumn("date_key", F.col("id"))}, root) == 1
    first = tables.current(spark, root)
    assert tables.publish(spark, {"a": frame(spark, 2)}, root) == 2
    assert values(tables.current(spark, root)) == {"a": [2], "b": [1], "fact_x": [1]}
    # A table may be computed from the version that it follows.
    tables.publish(spark, {"a": tables.current(spark, root)["a"].withColumn("v", F.col("v") + 1)}, root)
    assert values(tables.current(spark, root))["a"] == [3] and values(first) == {"a": [1], "b": [1], "fact_x": [1]}


def test_a_crash_between_two_tables_leaves_the_old_set(spark, tmp_path):
    root = str(tmp_path / "dw")
    tables.publish(spark, {"a": frame(spark, 1), "b": frame(spark, 1)}, root)
    broken = frame(spark, 2).withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(spark, {"a": frame(spark, 2), "b": broken}, root)
    assert values(tables.current(spark, root)) == {"a": [1], "b": [1]}
    gone = tables.remove_versions(spark, root, keep=1)
    assert len(gone) == 1 and values(tables.current(spark, root)) == {"a": [1], "b": [1]}
    assert tables.publish(spark, {"b": frame(spark, 5)}, root) == 2


def test_removal_keeps_what_versions_refer_to(spark, tmp_path):
    root = str(tmp_path / "dw")
    for v in range(1, 5):
        tables.publish(spark, {"a": frame(spark, v), **({"b": frame(spark, v)} if v == 1 else {})}, root)
    gone = tables.remove_versions(spark, root, keep=2)
    # The first version's folder still holds b.
    assert [g[:8] for g in gone] == ["v-000002"]
    assert values(tables.current(spark, root)) == {"a": [4], "b": [1]} and tables.remove_versions(spark, root, keep=2) == []


def test_two_writers(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "dw")
    tables.publish(spark, {"a": frame(spark, 1)}, root)
    real = tables.write_tables

    def slow(frames, folder):
        monkeypatch.setattr(tables, "write_tables", real)
        tables.publish(spark, {"a": frame(spark, 7)}, root)
        return real(frames, folder)
    monkeypatch.setattr(tables, "write_tables", slow)
    with pytest.raises(RuntimeError, match="another run published"):
        tables.publish(spark, {"a": frame(spark, 2)}, root)
    assert values(tables.current(spark, root)) == {"a": [7]}


def test_daily_state_through_stored_versions(spark, tmp_path):
    root, runs = str(tmp_path / "dw"), [(1, 0, 4), (2, 3, 8), (3, 9, 10)]
    rows = made("stored", 3)
    state, m = DailyState(), measures()
    for batch, lo, hi in runs:
        state = DailyState.of(tables.current(spark, root))
        new = spark.createDataFrame([tuple(r[c] for c in ("g", "day", "a", "b", "ok", "x", "batch")) for r in rows if r["batch"] == batch], SCHEMA)
        spans, firsts, touched = iv.fold(m, state.spans, state.firsts, new)
        published, done = iv.publish(m, spans, touched, state.published, state.runs, iv.Run(batch, day(lo), day(hi)))
        state = DailyState(spans, firsts, published, done, {**state.loaded, batch: dt.datetime(2024, 1, batch)})
        tables.publish(spark, state.tables(spark), root)
    again = DailyState.of(tables.current(spark, root))
    assert again.runs == state.runs and again.loaded == {b: dt.datetime(2024, 1, b) for b in (1, 2, 3)}
    want = rolled(spark, rows, runs)
    got = iv.expand(again.published, again.runs)
    assert got.count() > 0 and got.exceptAll(iv.expand(*want[2:])).count() == 0 == iv.expand(*want[2:]).exceptAll(got).count()
