"""Unit tests of the generic operators on tiny hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.hashing import row_hash
from starloom.operators.keys import assign_keys
from starloom.operators.loads import append_new, hash_upsert, replace_touched
from starloom.operators.lookups import either_or_key, latest_per_key, lookup_key
from starloom.operators.scd import scd1_rebuild, scd2_merge
from starloom.operators.snapshots import cumulative_daily_snapshot
from starloom.operators.validation import ForeignKey, greater_than, in_domain, ordered, required, validate


def test_assign_keys_contiguous_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("nk")).repartition(13)
    out = assign_keys(df, ["nk"], "k", base=5, num_partitions=6).collect()
    pairs = sorted((r.nk, r.k) for r in out)
    assert [k for _, k in pairs] == list(range(6, 1006))


def test_latest_per_key_and_lookup_unknown(spark):
    stg = spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (2, 5, "c")], "id int, stg_row_id long, v string")
    assert {(r.id, r.v) for r in latest_per_key(stg, ["id"], ["stg_row_id"]).collect()} == {(1, "b"), (2, "c")}
    dim = spark.createDataFrame([(7, 1), (3, 1), (9, 2)], "k int, nk int")
    fact = spark.createDataFrame([(1,), (2,), (4,), (None,)], "nk int")
    got = {r.nk: r.k for r in lookup_key(fact, dim, {"nk": "nk"}, "k").collect()}
    assert got == {1: 3, 2: 9, 4: -1, None: -1}


def test_either_or_key(spark):
    dim = spark.createDataFrame([(1, 100, None, None), (2, None, 5, "x"), (3, None, 5, "x")],
                                "k int, tid int, dom int, title string")
    fact = spark.createDataFrame([(100, 5, "x"), (None, 5, "x"), (None, 6, "y"), (200, 5, "x")],
                                 "tid int, dom int, title string")
    out = either_or_key(fact, dim, ({"tid": "tid"}, F.col("tid").isNotNull()),
                        ({"dom": "dom", "title": "title"}, F.col("tid").isNull()), "k", "task_key",
                        second_guard=F.col("tid").isNull())
    got = sorted((r.tid or 0, r.dom, r.task_key) for r in out.collect())
    assert got == [(0, 5, 3), (0, 6, -1), (100, 5, 1), (200, 5, -1)]


def test_validation_messages(spark):
    parent = spark.createDataFrame([(1,)], "id int")
    df = spark.createDataFrame([(1, 1, "cash", 5.0, 1, 2), (2, None, "gold", -1.0, 3, 2), (3, 9, "CASH ", 1.0, None, 1)],
                               "id int, p int, t string, amount double, a int, b int")
    v = validate(df, [required("p"), in_domain("t", ["cash"]), greater_than("amount", 0), ordered("a", "b")],
                 [ForeignKey("p", parent, "id")])
    msgs = {r.id: (r.is_valid, r.validation_message) for r in v.collect()}
    assert msgs[1] == (True, None)
    assert msgs[2] == (False, "p missing; t invalid; amount out of range; a after b; ")
    assert msgs[3] == (False, "p not found; ")


def test_hash_upsert_actions(spark):
    old = spark.createDataFrame([(1, "h1", True, 10), (2, "h2", True, 11), (3, "h3", False, 12)],
                                "id int, row_hash string, is_valid boolean, stg_row_id int")
    new = spark.createDataFrame([(1, "h1", True, None), (2, "hX", True, None), (3, "h3", True, None),
                                 (4, "h4", True, None)], "id int, row_hash string, is_valid boolean, stg_row_id int")
    for limit in (None, 1000):
        out = {r.id: (r.row_hash, r.stg_row_id, r.upsert_action)
               for r in hash_upsert(old, new, ["id"], keep_old=("stg_row_id",), broadcast_max_rows=limit).collect()}
        assert out == {1: ("h1", 10, "unchanged"), 2: ("hX", 11, "update"), 3: ("h3", 12, "update"),
                       4: ("h4", None, "insert")}


def test_append_new_null_safe(spark):
    existing = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    cand = spark.createDataFrame([(1, None), (1, 3), (2, 5), (None, None)], "a int, b int")
    got = sorted((r.a or 0, r.b or 0) for r in append_new(cand, existing, ["a", "b"], null_safe=True).collect())
    assert got == [(0, 0), (1, 3)]


def test_replace_touched(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "g int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "g int, v string")
    assert sorted(tuple(r) for r in replace_touched(old, new, ["g"]).collect()) == [(1, "old"), (2, "new"), (3, "new")]


def test_scd1_keeps_keys(spark):
    src1 = spark.createDataFrame([(10, "a"), (20, "b")], "nk int, v string")
    d1 = scd1_rebuild(src1, None, ["nk"], "k", unknown={"nk": -1, "v": "?"})
    src2 = spark.createDataFrame([(20, "B"), (15, "c")], "nk int, v string")
    d2 = {r.nk: (r.k, r.v) for r in scd1_rebuild(src2, d1, ["nk"], "k", unknown={"nk": -1, "v": "?"}).collect()}
    assert d2 == {-1: (-1, "?"), 20: (2, "B"), 15: (3, "c")}


def test_scd2_close_and_insert(spark):
    t0, t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
    s1 = spark.createDataFrame([(1, "x"), (2, "y")], "nk int, attr string").withColumn("h", row_hash("attr"))
    d1 = scd2_merge(None, s1, ["nk"], "k", "h", t0, t1)
    s2 = spark.createDataFrame([(1, "x"), (2, "z"), (3, "w")], "nk int, attr string").withColumn("h", row_hash("attr"))
    d2 = scd2_merge(d1, s2, ["nk"], "k", "h", t1, t2).collect()
    rows = sorted((r.k, r.nk, r.attr, r.effective_from, r.effective_to, r.is_current) for r in d2)
    assert rows == [(1, 1, "x", t0, None, True), (2, 2, "y", t0, t2, False),
                    (3, 2, "z", t2, None, True), (4, 3, "w", t2, None, True)]


def test_cumulative_snapshot_unknown_dates_and_running(spark):
    f = spark.createDataFrame(
        [(1, 1, dt.date(2024, 1, 1), 5), (1, 2, dt.date(2024, 1, 3), 7), (1, 2, dt.date(2024, 1, 2), 9),
         (1, 3, None, 1), (2, 4, dt.date(2024, 1, 9), 2)], "g int, id int, day date, v int")
    snap = cumulative_daily_snapshot(f, ["g"], "day", dt.date(2024, 1, 2), dt.date(2024, 1, 5),
                                     distinct={"n": ("id", None)}, sums={"v": ("v", None)},
                                     mins={"lo": ("v", None)}, maxs={"hi": ("v", None)})
    got = sorted((r.snapshot_date.day, r.g, r.n, r.v_sum, r.v_n, r.lo, r.hi) for r in snap.collect())
    # group 1: ids 1 (Jan 1, before start), 3 (no date) count from the start; id 2 first seen Jan 2.
    assert got == [(2, 1, 3, 15, 3, 1, 9), (3, 1, 3, 22, 4, 1, 9), (4, 1, 3, 22, 4, 1, 9)]


def test_date_key(spark):
    r = spark.createDataFrame([(dt.date(2028, 2, 29),), (None,)], "d date").select(date_key("d").alias("k")).collect()
    assert [x.k for x in r] == [20280229, None]


def test_assign_keys_small_path_matches_distributed(spark):
    df = spark.range(0, 500).select((F.col("id") * 13 % 500).alias("nk"), (F.col("id") % 7).alias("v")).repartition(9)
    small = sorted((r.nk, r.k) for r in assign_keys(df, ["nk"], "k", base=10).collect())
    dist = sorted((r.nk, r.k) for r in assign_keys(df, ["nk"], "k", base=10, num_partitions=5).collect())
    assert small == dist and [k for _, k in small] == list(range(11, 511))


def test_exact_avg_matches_decimal_half_up(spark):
    import random
    from decimal import ROUND_HALF_UP
    from decimal import Decimal as D

    from starloom.functions.numeric import exact_avg
    random.seed(7)
    rows = [(D(random.randint(-10 ** 9, 10 ** 9)) / 100, random.randint(1, 3_000_000)) for _ in range(500)]
    rows += [(D("1.01"), 2), (D("-1.01"), 2), (D("0.05"), 10), (None, 0)]
    df = spark.createDataFrame(rows, "s decimal(20,2), n long")
    got = [r.a for r in df.select(exact_avg(F.col("s"), F.col("n"), 2, 18).alias("a")).collect()]

    def want(s, n):
        if s is None or n == 0:
            return None
        q = (abs(s) / n).quantize(D("0.01"), rounding=ROUND_HALF_UP)
        return -q if s < 0 else q
    assert got == [want(s, n) for s, n in rows]


def test_hash_upsert_null_key_rows_agree_on_both_paths(spark):
    old = spark.createDataFrame([(1, "a", True), (None, "z", True)], "id int, row_hash string, is_valid boolean")
    new = spark.createDataFrame([(1, "b", True), (None, "n", True)], "id int, row_hash string, is_valid boolean")
    results = []
    for limit in (None, 1000):
        out = hash_upsert(old, new, ["id"], broadcast_max_rows=limit)
        results.append(sorted((r.id if r.id is not None else -99, r.row_hash, r.upsert_action) for r in out.collect()))
    assert results[0] == results[1] == [(-99, "n", "insert"), (-99, "z", "unchanged"), (1, "b", "update")]
