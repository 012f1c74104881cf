"""Program mart over seven days: day 1 first load, days 2-5 one run each, days 6-7 one run.

Checks, after every run: past dates keep their signature (the fact is append-only); no grain
appears twice; keys resolve. At the end: the daily snapshot equals the as-of aggregate of the
final facts, by two-way EXCEPT against an independent recomputation.
"""

import datetime as dt
from collections import defaultdict
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom.plans.dim_date import dim_date_between
from starloom.plans.mart1 import run_mart1
from starloom.plans.quality import date_signature, reconcile
from starloom.plans.staging import run_staging
from tests import program_fixture as base

DAYS = [dt.date(2027, 6, d) for d in range(1, 8)]
RUNS = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 8)]       # [first day, end day) of each run


def at(day, h):
    return dt.datetime(day.year, day.month, day.day, h)


def rows_upto(last_day):
    r = base.day1_rows()
    for key in ("daily_task_assignments", "assessment_sessions", "task_assessments", "child_daily_status",
                "center_daily_status"):
        r[key] = []
    for n, day in enumerate(DAYS):
        if day > last_day:
            break
        for child in (1, 2, 3):
            aid = 100 * (n + 1) + child
            status = ["completed", "planned", "cancelled", "incomplete"][(n + child) % 4]
            template = 1 if child != 3 else None
            r["daily_task_assignments"].append(
                (aid, child, day, None, template, 1 if template else 2, "Read words" if template else "Count to ten",
                 1, 1, status, at(day, 9), None))
            if (n + child) % 2 == 0:
                teacher = 1 if child != 3 else 2
                r["assessment_sessions"].append((aid, child, teacher, 1 if child != 3 else 2, day, None, None, "done",
                                                 None, at(day, 10), None))
                score = D(f"{(n + child) % 10}.50") if child != 2 else None
                r["task_assessments"].append((aid, aid, aid, child, teacher, day, score, None,
                                              "scored" if score is not None else "not_scored",
                                              1 if score is None else None, 1, None, at(day, 11), None))
        if n % 3 == 1:
            r["child_daily_status"].append((n + 1, 2, day, "absent", 1, None, 1, at(day, 7), None))
        if n == 4:
            r["center_daily_status"].append((n + 1, 2, day, "closed", 1, None, 2, at(day, 7), None))
    return r


@pytest.fixture(scope="module")
def history(spark):
    dim_date = dim_date_between(spark, dt.date(2027, 5, 1), dt.date(2027, 7, 31))
    stg, out, sigs = {}, {}, []
    for batch, (lo, hi) in enumerate(RUNS, start=1):
        start, end = dt.datetime(2027, 6, lo), dt.datetime(2027, 6, hi)
        src = base.sources(spark, rows_upto(DAYS[hi - 2]))
        stg, _ = run_staging(spark, "program_ops", src, stg, end, batch_id=batch)
        out = run_mart1(spark, stg, dict(out, dim_date=dim_date), start, end, batch_id=batch,
                        first_load=(batch == 1))
        sig = date_signature(out["fact_tran_student_task_progress"].withColumn("raw_score", F.coalesce(
            "raw_score", F.lit(0))), "date_key", ["raw_score"], ["is_planned", "is_assessed", "is_absent"])
        sigs.append((start, {r.date_key: tuple(r) for r in sig.collect()}))
    return {"out": out, "sigs": sigs, "dim_date": dim_date}


def test_past_dates_keep_their_signature(history):
    sigs = history["sigs"]
    for (start, before), (_, after) in zip(sigs, sigs[1:]):
        limit = int(start.strftime("%Y%m%d"))
        past = {k: v for k, v in before.items() if k < limit}
        assert {k: after[k] for k in past} == past


def test_no_duplicate_grain_and_keys_resolve(history):
    out = history["out"]
    f = out["fact_tran_student_task_progress"]
    assert f.groupBy("source_daily_task_assignment_id", "source_task_assessment_id").count() \
            .filter("count > 1").count() == 0
    assert f.filter("child_key = -1 OR center_key = -1 OR date_key = -1").count() == 0
    assert f.count() == 7 * 3 + sum(1 for n in range(7) for c in (1, 2, 3) if (n + c) % 2 == 0)
    d = out["fact_daily_student_task_progress"]
    assert d.groupBy("date_key", "child_key", "center_key", "teacher_key").count().filter("count > 1").count() == 0
    e = out["fact_child_task_event"]
    assert e.count() == f.count()


def test_snapshot_equals_as_of_aggregate(spark, history):
    out = history["out"]
    facts = out["fact_tran_student_task_progress"].collect()
    by_key = {r.TimeKey: r.FullDateAlternateKey for r in history["dim_date"].collect()}
    rows = []
    for day in DAYS:
        groups = defaultdict(list)
        for r in facts:
            if by_key[r.date_key] <= day:
                groups[(r.child_key, r.center_key, r.teacher_key)].append(r)
        for (child, center, teacher), rs in groups.items():
            a = {r.source_daily_task_assignment_id for r in rs}
            rows.append((int(day.strftime("%Y%m%d")), child, center, teacher, len(a),
                         len({r.source_task_assessment_id for r in rs if r.source_task_assessment_id is not None}),
                         len({r.source_daily_task_assignment_id for r in rs if r.is_completed == 1}),
                         len({r.source_daily_task_assignment_id for r in rs if r.is_scored == 1})))
    cols = "date_key int, child_key long, center_key long, teacher_key long, planned_task_count int, " \
           "assessment_count int, completed_task_count int, scored_task_count int"
    expected = spark.createDataFrame(rows, cols)
    got = out["fact_daily_student_task_progress"].select(*expected.columns)
    got = got.select(*[F.col(c).cast(t) for c, t in zip(expected.columns, [f.dataType for f in expected.schema])])
    diff = reconcile(got, expected).collect()[0]
    assert diff.n_only_left == 0 and diff.n_only_right == 0 and diff.n_left == diff.n_right > 0
