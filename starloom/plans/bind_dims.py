"""Dimension and lookup bindings (A2, U1, U2, SC8, D7, D12-D15, K6-K8, J1, J5, J6, J8, J9, J17, Q10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import ts_lit

from starloom.functions.hashing import row_hash
from starloom.functions.text import keyword_flags, norm_lower, norm_upper
from starloom.operators.lookups import checked_broadcast, current_key, latest_per_key, latest_value, lookup_key
from starloom.operators.scd import scd1_rebuild, scd2_merge
from starloom.plans import driver_dims as dd
from starloom.plans.driver_dims import STATUS_DIM_SQL
from starloom.plans.bind_extract import SNAPSHOT_1, SNAPSHOT_2, user_snapshot, user_snapshot_sql
from starloom.plans.registry import register
from starloom.session import cut_lineage
from starloom.sources.tables import load

# Keyword groups of the reason classifier, in priority order.
REASON_KEYWORDS = [
    ("child", ["child", "absent", "refus"]),
    ("teacher", ["teacher"]),
    ("center", ["center", "closed"]),
    ("system", ["system"]),
]


@register("code_dim", ("A2", "K6", "K7", "D12"), """
SELECT CAST(row_number() OVER (ORDER BY code) AS BIGINT) AS priority_key, code, title
FROM (SELECT lower(trim(o_orderpriority)) AS code, min(trim(o_orderpriority)) AS title FROM orders
      WHERE lower(trim(o_orderpriority)) IS NOT NULL AND lower(trim(o_orderpriority)) <> '' GROUP BY 1)
UNION ALL SELECT -1, 'unknown', 'Unknown'
""")
def code_dim_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.priority_dim(spark, sf_dir)




@register("status_union_dim", ("SC8", "U1", "K6", "D13"), STATUS_DIM_SQL)
def status_union_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.status_dim(spark, sf_dir)


@register("multi_column_code_dim", ("U2", "K6", "D14"), """
SELECT CAST(row_number() OVER (ORDER BY code) AS BIGINT) AS code_key, code, code AS name FROM (
  SELECT upper(trim(l_returnflag)) AS code FROM lineitem UNION SELECT upper(trim(l_linestatus)) FROM lineitem
  UNION SELECT upper(trim(o_orderstatus)) FROM orders UNION SELECT upper(trim(c_mktsegment)) FROM customer
  UNION SELECT upper(trim(p_type)) FROM part) WHERE code IS NOT NULL AND code <> ''
UNION ALL SELECT -1, 'UNKNOWN', 'Unknown'
""")
def multi_column_code_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    # One scan per table: lineitem contributes two columns through explode(array(...)).
    codes = (li.select(F.explode(F.array(norm_upper("l_returnflag"), norm_upper("l_linestatus"))).alias("code"))
               .unionByName(load(spark, sf_dir, "orders").select(norm_upper("o_orderstatus").alias("code")))
               .unionByName(load(spark, sf_dir, "customer").select(norm_upper("c_mktsegment").alias("code")))
               .unionByName(load(spark, sf_dir, "part").select(norm_upper("p_type").alias("code"))))
    src = codes.filter(F.col("code").isNotNull() & (F.col("code") != "")).distinct() \
               .withColumn("name", F.col("code"))
    return scd1_rebuild(src, None, ["code"], "code_key", unknown={"code": "UNKNOWN", "name": "Unknown"})


@register("date_dim", ("D15",), """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS TimeKey, d AS FullDateAlternateKey,
  CAST(NULL AS VARCHAR) AS PersianFullDateAlternateKey, CAST(isodow(d) AS INTEGER) AS DayNumberOfWeek,
  CAST(NULL AS INTEGER) AS PersianDayNumberOfWeek, dayname(d) AS EnglishDayNameOfWeek,
  CAST(NULL AS VARCHAR) AS PersianDayNameOfWeek, CAST(day(d) AS INTEGER) AS DayNumberOfMonth,
  CAST(NULL AS INTEGER) AS PersianDayNumberOfMonth, CAST(dayofyear(d) AS INTEGER) AS DayNumberOfYear,
  CAST(NULL AS INTEGER) AS PersianDayNumberOfYear, CAST(week(d) AS INTEGER) AS WeekNumberOfYear,
  CAST(NULL AS INTEGER) AS PersianWeekNumberOfYear, monthname(d) AS EnglishMonthName,
  CAST(NULL AS VARCHAR) AS PersianMonthName, CAST(month(d) AS INTEGER) AS MonthNumberOfYear,
  CAST(NULL AS INTEGER) AS PersianMonthNumberOfYear, CAST(quarter(d) AS INTEGER) AS CalendarQuarter,
  CAST(NULL AS INTEGER) AS PersianCalendarQuarter, CAST(year(d) AS INTEGER) AS CalendarYear,
  CAST(NULL AS INTEGER) AS PersianCalendarYear, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS CalendarSemester,
  CAST(NULL AS INTEGER) AS PersianCalendarSemester
FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders)
UNION ALL SELECT -1, DATE '1900-01-01', 'نامشخص', 0, 0, 'Unknown', 'نامشخص', 0, 0, 0, 0, 0, 0, 'Unknown',
  'نامشخص', 0, 0, 0, 0, 1900, 0, 0, 0
""")
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.order_calendar(spark, sf_dir)


@register("keyword_category", ("D7", "LIKE"), """
SELECT doc_id,
  CASE WHEN t LIKE '%child%' OR t LIKE '%absent%' OR t LIKE '%refus%' THEN 'child'
       WHEN t LIKE '%teacher%' THEN 'teacher' WHEN t LIKE '%center%' OR t LIKE '%closed%' THEN 'center'
       WHEN t LIKE '%system%' THEN 'system' ELSE 'other' END AS reason_category,
  CAST(t LIKE '%child%' OR t LIKE '%absent%' OR t LIKE '%refus%' AS INTEGER) AS is_child_related,
  CAST(t LIKE '%teacher%' AS INTEGER) AS is_teacher_related,
  CAST(t LIKE '%center%' OR t LIKE '%closed%' AS INTEGER) AS is_center_related,
  CAST(t LIKE '%system%' AS INTEGER) AS is_system_related
FROM (SELECT doc_id, lower(concat(coalesce(source, ''), ' ', coalesce(text, ''))) AS t FROM documents)
""")
def keyword_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    text = F.concat(F.coalesce("source", F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))
    category, flags = keyword_flags(text, REASON_KEYWORDS)
    return docs.select("doc_id", category.alias("reason_category"),
                       flags["child"].alias("is_child_related"), flags["teacher"].alias("is_teacher_related"),
                       flags["center"].alias("is_center_related"), flags["system"].alias("is_system_related"))


# --- K6 over two user snapshots ------------------------------------------------------------
@register("scd1_rebuild", ("K6", "K7", "J11"), f"""
WITH s1 AS {user_snapshot_sql('2024-01-15', 1)}, s2 AS {user_snapshot_sql('2024-01-31', 2)},
o AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS user_key FROM s1),
kept AS (SELECT o.user_key, s2.user_id, s2.event_type, s2.row_hash FROM s2 JOIN o ON o.user_id = s2.user_id),
fresh AS (SELECT (SELECT coalesce(max(user_key), 0) FROM o) + row_number() OVER (ORDER BY s2.user_id) AS user_key,
                 s2.user_id, s2.event_type, s2.row_hash
          FROM s2 WHERE s2.user_id NOT IN (SELECT user_id FROM o))
SELECT CAST(user_key AS BIGINT) AS user_key, user_id, event_type, row_hash FROM kept
UNION ALL SELECT CAST(user_key AS BIGINT), user_id, event_type, row_hash FROM fresh
UNION ALL SELECT -1, -1, 'unknown', NULL
""")
def scd1_rebuild_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["user_id", "event_type", "row_hash"]
    unknown = {"user_id": -1, "event_type": "unknown"}
    old = scd1_rebuild(user_snapshot(spark, sf_dir, SNAPSHOT_1, 1).select(*cols), None, ["user_id"],
                       "user_key", unknown)
    return scd1_rebuild(user_snapshot(spark, sf_dir, SNAPSHOT_2, 2).select(*cols), old, ["user_id"],
                        "user_key", unknown)


# --- K8: three Type 2 runs over the event stream -------------------------------------------
SCD2_START = _dt.datetime(2024, 1, 1)
SCD2_RUN_ENDS = [_dt.datetime(2024, 1, 11), _dt.datetime(2024, 1, 21), _dt.datetime(2024, 1, 31)]


@dd.memo_dim
def user_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    dim, lo = None, None
    start = SCD2_START
    for end in SCD2_RUN_ENDS:
        t_end = ts_lit(end)
        window = ev.filter(F.col("ts") < t_end) if lo is None else \
            ev.filter((F.col("ts") >= ts_lit(lo)) & (F.col("ts") < t_end))
        src = latest_per_key(window, ["user_id"], ["ts", "event_id"]) \
            .select("user_id", "event_type", row_hash("event_type").alias("attr_hash"))
        dim = scd2_merge(dim, src, ["user_id"], "user_key", "attr_hash", start, end,
                         unknown={"user_id": -1, "event_type": "unknown"})
        dim = cut_lineage(dim)  # each run reads the previous version exactly once written
        lo = end
    return dim


def _scd2_window_sql(lo: str | None, hi: str) -> str:
    cond = f"ts < TIMESTAMP '{hi}'" if lo is None else f"ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}'"
    return f"""(SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE {cond}) WHERE rn = 1)"""


SCD2_SQL = f"""
WITH w1 AS {_scd2_window_sql(None, '2024-01-11')}, w2 AS {_scd2_window_sql('2024-01-11', '2024-01-21')},
w3 AS {_scd2_window_sql('2024-01-21', '2024-01-31')},
v1 AS (SELECT user_id, event_type, 1 AS run, TIMESTAMP '2024-01-01 00:00:00' AS eff FROM w1),
v2 AS (SELECT w2.user_id, w2.event_type, 2 AS run, TIMESTAMP '2024-01-21 00:00:00' AS eff
       FROM w2 LEFT JOIN v1 c ON c.user_id = w2.user_id
       WHERE c.user_id IS NULL OR sha256(c.event_type) <> sha256(w2.event_type)),
c2 AS (SELECT user_id, event_type FROM v2
       UNION ALL SELECT user_id, event_type FROM v1 WHERE user_id NOT IN (SELECT user_id FROM v2)),
v3 AS (SELECT w3.user_id, w3.event_type, 3 AS run, TIMESTAMP '2024-01-31 00:00:00' AS eff
       FROM w3 LEFT JOIN c2 c ON c.user_id = w3.user_id
       WHERE c.user_id IS NULL OR sha256(c.event_type) <> sha256(w3.event_type)),
allv AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2 UNION ALL SELECT * FROM v3),
scd2 AS (
  SELECT CAST(row_number() OVER (ORDER BY run, user_id) AS BIGINT) AS user_key, user_id, event_type,
         sha256(event_type) AS attr_hash, eff AS effective_from,
         lead(eff) OVER (PARTITION BY user_id ORDER BY run) AS effective_to,
         lead(eff) OVER (PARTITION BY user_id ORDER BY run) IS NULL AS is_current
  FROM allv
  UNION ALL SELECT -1, -1, 'unknown', NULL, NULL, NULL, true)
"""


@register("scd2_versions", ("K8", "K7", "SC5", "J1", "V2"), SCD2_SQL + "SELECT * FROM scd2")
def scd2_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_scd2(spark, sf_dir)


@register("one_current_check", ("Q10",), SCD2_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n_members,
       CAST(sum(CASE WHEN n_current = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_one_current,
       CAST(sum(n_versions) AS BIGINT) AS n_versions,
       CAST(sum(n_closed_missing_end) AS BIGINT) AS n_closed_missing_end
FROM (SELECT user_id, count(*) AS n_versions, sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS n_current,
             sum(CASE WHEN NOT is_current AND effective_to IS NULL THEN 1 ELSE 0 END) AS n_closed_missing_end
      FROM scd2 WHERE user_key <> -1 GROUP BY user_id)
""")
def one_current_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.plans.quality import scd2_current_check
    return scd2_current_check(user_scd2(spark, sf_dir), "user_id", "user_key")


@register("current_lookup", ("J5", "L1"), SCD2_SQL + """
SELECT e.event_id, CAST(coalesce(k.user_key, -1) AS BIGINT) AS user_key
FROM events e LEFT JOIN (SELECT user_id, max(user_key) AS user_key FROM scd2 WHERE is_current GROUP BY user_id) k
  ON k.user_id = e.user_id
""")
def current_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("event_id", "user_id")
    return current_key(ev, user_scd2(spark, sf_dir), "user_id", "user_id", "user_key", "user_key") \
        .select("event_id", "user_key")


# --- J1, J6 --------------------------------------------------------------------------------
@register("latest_per_key", ("J1", "A1"), """
SELECT user_id, event_id, ts, event_type, CAST(value AS DECIMAL(12,2)) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def latest_per_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type",
                                              F.col("value").cast("decimal(12,2)").alias("value"))
    return latest_per_key(ev, ["user_id"], ["ts", "event_id"])


@register("latest_status", ("J6", "L1"), """
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, event_id) AS day_status FROM events GROUP BY 1, 2)
SELECT e.event_id, e.user_id, s.day_status
FROM events e LEFT JOIN s ON s.user_id = e.user_id AND s.d = CAST(e.ts AS DATE)
""")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    status = latest_value(ev.select("user_id", "d", "event_type", "event_id"), ["user_id", "d"],
                          ["event_type"], "event_id").withColumnRenamed("event_type", "day_status")
    return ev.select("event_id", "user_id", "d").join(status, ["user_id", "d"], "left").select("event_id", "user_id", "day_status")


# --- J8, J9, J17 ---------------------------------------------------------------------------
NATION_DIM_SQL = "nd AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) AS nation_key FROM nation)"


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return scd1_rebuild(n, None, ["n_nationkey"], "nation_key", unknown={"n_nationkey": -1, "n_name": "Unknown"})


@register("two_step_lookup", ("J8", "J1", "J2"), f"""
WITH {NATION_DIM_SQL},
s AS (SELECT s_suppkey, s_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY s_acctbal DESC, s_name DESC) rn
      FROM supplier) WHERE rn = 1)
SELECT l.l_orderkey, l.l_linenumber, CAST(coalesce(nd.nation_key, -1) AS BIGINT) AS supplier_nation_key
FROM lineitem l LEFT JOIN s ON s.s_suppkey = l.l_suppkey LEFT JOIN nd ON nd.n_nationkey = s.s_nationkey
""")
def two_step_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = latest_per_key(load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", "s_name"),
                          ["s_suppkey"], ["s_acctbal", "s_name"]).select("s_suppkey", "s_nationkey")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    x = li.join(supp, li.l_suppkey == supp.s_suppkey, "left")
    x = lookup_key(x, nation_dim(spark, sf_dir), {"s_nationkey": "n_nationkey"}, "nation_key",
                   "supplier_nation_key")
    return x.select("l_orderkey", "l_linenumber", "supplier_nation_key")


@register("coalesced_lookup", ("J9", "J2"), f"""
WITH {NATION_DIM_SQL}
SELECT l.l_orderkey, l.l_linenumber, CAST(coalesce(nd.nation_key, -1) AS BIGINT) AS nation_key
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nd ON nd.n_nationkey = coalesce(c.c_nationkey, s.s_nationkey)
""")
def coalesced_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    x = (li.join(o, li.l_orderkey == o.o_orderkey, "left").join(c, F.col("o_custkey") == c.c_custkey, "left")
           .join(s, li.l_suppkey == s.s_suppkey, "left")
           .withColumn("_nation", F.coalesce("c_nationkey", "s_nationkey")))
    x = lookup_key(x, nation_dim(spark, sf_dir), {"_nation": "n_nationkey"}, "nation_key", pick=None)
    return x.select("l_orderkey", "l_linenumber", "nation_key")


@register("dim_to_dim", ("J17", "J18"), """
SELECT s.s_suppkey, s.s_name, coalesce(n.n_name, 'Unknown') AS nation_name, coalesce(r.r_name, 'Unknown') AS region_name
FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def dim_to_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    x = s.join(checked_broadcast(n), s.s_nationkey == n.n_nationkey, "left") \
         .join(checked_broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
    return x.select("s_suppkey", "s_name", F.coalesce("n_name", F.lit("Unknown")).alias("nation_name"),
                    F.coalesce("r_name", F.lit("Unknown")).alias("region_name"))


@register("customer_dim", ("K6", "K7", "D9"), """
SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key, c_custkey AS customer_id,
       c_name AS customer_name, c_nationkey AS nation_id, lower(trim(c_mktsegment)) AS segment FROM customer
UNION ALL SELECT -1, -1, 'Unknown', NULL, 'unknown'
""")
def customer_dim_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.customer_dim(spark, sf_dir)
