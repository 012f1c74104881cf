"""The daily snapshot and the accumulation by ranges of their groups: the same rows, with less to sort and to hold at a time."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import intervals as iv
from starloom.operators import keys
from starloom.plans.mart1 import fact_child_snapshot_accumulation, written_accumulation


def _measures():
    return iv.Measures(("g", "h"), "day", distinct={"n_a": ("a", None), "n_ok": ("a", F.col("ok"))}, sums={"x": ("x", None)},
                       mins={"low": ("x", F.col("ok"))}, maxs={"high": ("x", None)})


def test_a_fold_by_ranges_is_the_whole_fold(spark, monkeypatch):
    day = F.when(F.col("id") % 11 > 0, F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 7 % 23).cast("int")))
    rows = spark.range(400).select((F.col("id") % 9 - 1).alias("g"), (F.col("id") % 2).alias("h"), day.alias("day"), (F.col("id") % 31).cast("int").alias("a"),
                                   (F.col("id") % 3 == 0).alias("ok"), F.when(F.col("id") % 5 > 0, F.col("id") % 13).alias("x"), (F.col("id") % 4 > 1).alias("late"))

    def folded():
        m, spans, firsts, published, runs, parts = _measures(), None, None, None, [], []
        for batch, new in enumerate((rows.where("not late"), rows.where("late")), 1):
            spans, firsts, touched = iv.fold(m, spans, firsts, new)
            parts.append(len(getattr(spans, "_work_folders", ())))
            published, runs = iv.publish(m, spans, touched, published, runs, iv.Run(batch, dt.date(2024, 1, 1), dt.date(2024, 1, 10 * batch)))
        found = [sorted(map(str, df.select(*sorted(df.columns)).collect())) for df in (spans, firsts, published)]
        return found, parts, (m, spans, published, runs)
    whole, parts, _ = folded()
    assert parts == [1, 1]
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 40)
    ranged, parts, (m, spans, published, runs) = folded()
    assert ranged == whole and min(parts) > 1
    # A window whose days are all there, with no new rows, leaves what is published as it is.
    again, after = iv.publish(m, spans, None, published, runs, iv.Run(3, dt.date(2024, 1, 5), dt.date(2024, 1, 20)))
    assert again is published and len(after) == 3


def test_an_accumulation_by_ranges_is_the_whole_one(spark, monkeypatch):
    columns = "date_key int, child_key long, center_key long, teacher_key long"
    made = [(20200100 + i % 28 + 1, -1 if i % 13 == 0 else i % 10, i % 3, i % 2) for i in range(200)]
    daily = spark.createDataFrame([(*r, i % 5, i % 4, i % 3, i % 2) for i, r in enumerate(sorted(set(made)))], columns +
                                  ", planned_task_count int, assessment_count int, completed_task_count int, scored_task_count int")
    progress = spark.createDataFrame([(d, None if c == -1 else c, e, t, i, i if i % 3 else None) for i, (d, c, e, t) in enumerate(made)], columns +
                                     ", source_daily_task_assignment_id long, source_task_assessment_id long")
    first, middle, end = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 15), dt.datetime(2020, 2, 1)

    def both(make):
        old = make(daily, progress.where("child_key < 7 or child_key is null"), first, middle, None, 1, end)
        return sorted(map(str, make(daily, progress.where("child_key > 3"), middle, end, old, 2, end).collect()))
    whole = both(fact_child_snapshot_accumulation)
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 40)
    assert both(written_accumulation) == whole and len({r.split("etl_batch_id=")[1][0] for r in whole}) == 2
