"""Property test: the cumulative daily snapshot equals the literal definition (aggregate every
row dated on or before the day, or undated) on random inputs, including rows before the
window, after it, without a date, and ids repeated across rows."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators.snapshots import cumulative_daily_snapshot

START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 12)
row = st.tuples(st.integers(0, 3),                                       # group
                st.integers(0, 12),                                      # id (repeats across rows)
                st.one_of(st.none(), st.integers(0, 15)),                # day offset from Jan 1, or undated
                st.integers(-5, 20),                                     # value
                st.booleans())                                           # flag for the conditional metrics


def brute(rows):
    out = {}
    for i in range((END - START).days):
        d = START + dt.timedelta(days=i)
        groups = defaultdict(list)
        for g, idv, off, v, flag in rows:
            day = None if off is None else dt.date(2024, 1, 1) + dt.timedelta(days=off)
            if day is None or day <= d:
                groups[g].append((idv, v, flag))
        for g, rs in groups.items():
            flagged = [v for _, v, f in rs if f]
            out[(d, g)] = (len({i for i, _, _ in rs}), len({i for i, _, f in rs if f}),
                           sum(flagged) if flagged else None, len(flagged),
                           min(flagged) if flagged else None, max(v for _, v, _ in rs))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_snapshot_matches_definition(spark, rows):
    df = spark.createDataFrame(rows, "g int, id int, off int, v int, flag boolean").withColumn(
        "day", F.when(F.col("off").isNotNull(), F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("off"))))
    snap = cumulative_daily_snapshot(
        df, ["g"], "day", START, END, distinct={"n": ("id", None), "nf": ("id", F.col("flag"))},
        sums={"v": ("v", F.col("flag"))}, mins={"lo": ("v", F.col("flag"))}, maxs={"hi": ("v", None)})
    got = {(r.snapshot_date, r.g): (r.n, r.nf, r.v_sum, r.v_n, r.lo, r.hi) for r in snap.collect()}
    assert got == brute(rows)
