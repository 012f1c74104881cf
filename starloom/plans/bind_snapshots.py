"""Snapshot bindings: cumulative daily (A5+K5), accumulating (J16+A8+K11),
monthly scaffold (J15+A6) and lifecycle (A7+A9)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.numeric import exact_avg
from starloom.functions.text import norm_lower
from starloom.operators.loads import append_new, replace_touched
from starloom.operators.lookups import lookup_key
from starloom.operators.snapshots import (
    cumulative_daily_snapshot, first_last_keys, latest_row_per_group, member_months, scaffold_measures,
)
from starloom.operators.validation import settled
from starloom.plans import driver_dims as dd
from starloom.plans.registry import register
from starloom.session import cut_lineage
from starloom.sources.tables import load
from starloom.sources.watermark import history_before

DAY0, DAY_MID, DAY_END = _dt.date(2024, 1, 1), _dt.date(2024, 1, 16), _dt.date(2024, 1, 31)


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a transaction fact: user = group, event day = transaction date."""
    return load(spark, sf_dir, "events").select(
        "user_id", "event_id", F.to_date("ts").alias("day"), norm_lower("event_type").alias("et"),
        F.col("value").cast("decimal(12,2)").alias("v"))


def user_daily_snapshot(facts: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    purchase = F.col("et") == "purchase"
    snap = cumulative_daily_snapshot(
        facts, ["user_id"], "day", start, end,
        distinct={"n_events": ("event_id", None), "n_purchases": ("event_id", purchase),
                  "n_views": ("event_id", F.col("et") == "view")},
        sums={"value": ("v", purchase)}, mins={"min_value": ("v", purchase)},
        maxs={"max_value": ("v", purchase)})
    return snap.select(date_key("snapshot_date").alias("date_key"), "user_id", "n_events", "n_purchases",
                       "n_views", F.col("value_sum").cast("decimal(18,2)").alias("value_sum"), "value_n",
                       "min_value", "max_value")


def brute_force_snapshot_sql(start: str, end: str) -> str:
    """The as-of aggregate evaluated literally: every day joined to every earlier fact row."""
    return f"""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, user_id,
  CAST(count(DISTINCT event_id) AS BIGINT) AS n_events,
  CAST(count(DISTINCT CASE WHEN et = 'purchase' THEN event_id END) AS BIGINT) AS n_purchases,
  CAST(count(DISTINCT CASE WHEN et = 'view' THEN event_id END) AS BIGINT) AS n_views,
  CAST(sum(CASE WHEN et = 'purchase' THEN v END) AS DECIMAL(18,2)) AS value_sum,
  CAST(count(CASE WHEN et = 'purchase' THEN v END) AS BIGINT) AS value_n,
  min(CASE WHEN et = 'purchase' THEN v END) AS min_value, max(CASE WHEN et = 'purchase' THEN v END) AS max_value
FROM (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{end}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d) days
JOIN (SELECT user_id, event_id, CAST(ts AS DATE) AS day, lower(trim(event_type)) AS et,
             CAST(value AS DECIMAL(12,2)) AS v FROM events) e
  ON e.day <= days.d OR e.day IS NULL
GROUP BY d, user_id"""


@register("daily_cumulative_snapshot", ("A5", "A3", "A4", "K5", "J14"),
          brute_force_snapshot_sql("2024-01-01", "2024-01-31"))
def daily_cumulative_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = event_facts(spark, sf_dir)
    first = user_daily_snapshot(facts, DAY0, DAY_MID)
    # The second run overlaps the first; K5 appends only (date, group) rows not yet present.
    second = user_daily_snapshot(facts, _dt.date(2024, 1, 10), DAY_END)
    return first.unionByName(append_new(second, first, ["date_key", "user_id"]))


def accumulation(snapshot: DataFrame, facts: DataFrame, start_key: int, end_key: int) -> DataFrame:
    """F6 core: latest daily row in [start_key, end_key) per group + first/last keys over all facts."""
    period = snapshot.filter((F.col("date_key") >= start_key) & (F.col("date_key") < end_key))
    latest = latest_row_per_group(period.select("user_id", "date_key", "n_events", "n_purchases"),
                                  ["user_id"], "date_key").withColumnRenamed("date_key", "snapshot_date_key")
    f = facts.withColumns({"dk": date_key("day"),
                           "purchase_id": F.when(F.col("et") == "purchase", F.col("event_id"))})
    dates = first_last_keys(f, ["user_id"], "dk", {"event": "event_id", "purchase": "purchase_id"})
    return latest.join(dates, ["user_id"])


ACCUM_SQL_TEMPLATE = """
(SELECT l.user_id, l.date_key AS snapshot_date_key, s.n_events, s.n_purchases,
        t.first_event_date_key, t.last_event_date_key, t.first_purchase_date_key, t.last_purchase_date_key
 FROM (SELECT user_id, max(date_key) AS date_key FROM snap WHERE date_key >= {lo} AND date_key < {hi} GROUP BY user_id) l
 JOIN snap s ON s.user_id = l.user_id AND s.date_key = l.date_key
 JOIN (SELECT user_id,
         min(CAST(coalesce(year(day) * 10000 + month(day) * 100 + day(day), -1) AS INTEGER)) AS first_event_date_key,
         max(CAST(coalesce(year(day) * 10000 + month(day) * 100 + day(day), -1) AS INTEGER)) AS last_event_date_key,
         min(CASE WHEN et = 'purchase' THEN CAST(coalesce(year(day) * 10000 + month(day) * 100 + day(day), -1) AS INTEGER) END) AS first_purchase_date_key,
         max(CASE WHEN et = 'purchase' THEN CAST(coalesce(year(day) * 10000 + month(day) * 100 + day(day), -1) AS INTEGER) END) AS last_purchase_date_key
       FROM f GROUP BY user_id) t ON t.user_id = l.user_id)"""


@register("accumulating_snapshot_merge", ("J16", "A8", "K11", "K10"), f"""
WITH snap AS ({brute_force_snapshot_sql('2024-01-01', '2024-01-31')}),
f AS (SELECT user_id, event_id, CAST(ts AS DATE) AS day, lower(trim(event_type)) AS et FROM events),
old AS {ACCUM_SQL_TEMPLATE.format(lo=20240101, hi=20240116)},
new AS {ACCUM_SQL_TEMPLATE.format(lo=20240116, hi=20240131)}
SELECT * FROM new UNION ALL SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM new)
""")
def accumulating_snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = event_facts(spark, sf_dir)
    # The snapshot feeds both accumulations: write it once (a work table, as in the loaders).
    snap = cut_lineage(user_daily_snapshot(facts, DAY0, DAY_END))
    old = accumulation(snap, facts, 20240101, 20240116)
    new = accumulation(snap, facts, 20240116, 20240131)
    return replace_touched(old, new, ["user_id"])


# --- J15 + A6: nation x month scaffold with four pre-aggregated measures --------------------
def _money(c):
    return F.col(c).cast("decimal(18,2)")


@register("monthly_snapshot_scaffold", ("J15", "A6", "A11"), """
WITH m AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS month_start FROM orders),
don AS (SELECT c.c_nationkey AS nation_id, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month_start,
               sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total_donation_amount, count(DISTINCT o.o_orderkey) AS donation_count
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE lower(trim(o.o_orderstatus)) = 'f' GROUP BY 1, 2),
exp AS (SELECT s.s_nationkey AS nation_id, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month_start,
               sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS total_expense_amount, count(*) AS expense_count
        FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE l.l_linestatus = 'F' GROUP BY 1, 2),
pay AS (SELECT s.s_nationkey AS nation_id, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month_start,
               sum(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))) AS total_payment_amount,
               count(*) AS payment_count
        FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE l.l_returnflag = 'R' GROUP BY 1, 2),
alloc AS (SELECT c.c_nationkey AS nation_id, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month_start, count(*) AS allocation_count
          FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2)
SELECT CAST(year(last_day(m.month_start)) * 10000 + month(m.month_start) * 100 + day(last_day(m.month_start)) AS INTEGER) AS month_key,
  n.n_nationkey AS nation_id,
  CAST(coalesce(don.total_donation_amount, 0) AS DECIMAL(18,2)) AS total_donation_amount,
  CAST(coalesce(exp.total_expense_amount, 0) AS DECIMAL(18,2)) AS total_expense_amount,
  CAST(coalesce(pay.total_payment_amount, 0) AS DECIMAL(18,2)) AS total_payment_amount,
  CAST(coalesce(don.total_donation_amount, 0) - coalesce(exp.total_expense_amount, 0) - coalesce(pay.total_payment_amount, 0) AS DECIMAL(18,2)) AS net_balance,
  CAST(coalesce(don.donation_count, 0) AS BIGINT) AS donation_count, CAST(coalesce(exp.expense_count, 0) AS BIGINT) AS expense_count,
  CAST(coalesce(pay.payment_count, 0) AS BIGINT) AS payment_count, CAST(coalesce(alloc.allocation_count, 0) AS BIGINT) AS allocation_count
FROM m CROSS JOIN nation n
LEFT JOIN don ON don.nation_id = n.n_nationkey AND don.month_start = m.month_start
LEFT JOIN exp ON exp.nation_id = n.n_nationkey AND exp.month_start = m.month_start
LEFT JOIN pay ON pay.nation_id = n.n_nationkey AND pay.month_start = m.month_start
LEFT JOIN alloc ON alloc.nation_id = n.n_nationkey AND alloc.month_start = m.month_start
""")
def monthly_snapshot_scaffold(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_discount", "l_returnflag",
                                                "l_linestatus", "l_shipdate")
    cust = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_id"))
    supp = load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation_id"))
    nations = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_id"))
    om = o.join(cust, o.o_custkey == cust.c_custkey).withColumn("month_start", F.trunc(F.to_date("o_orderdate"), "month"))
    lm = li.join(supp, li.l_suppkey == supp.s_suppkey).withColumn("month_start", F.trunc(F.to_date("l_shipdate"), "month"))
    keys = ["nation_id", "month_start"]
    # One conditional aggregation per source (orders, lines) instead of one per measure.
    fulfilled = norm_lower("o_orderstatus") == "f"
    by_order = om.groupBy(*keys).agg(
        F.sum(F.when(fulfilled, _money("o_totalprice"))).alias("total_donation_amount"),
        F.countDistinct(F.when(fulfilled, F.col("o_orderkey"))).alias("donation_count"),
        F.count(F.lit(1)).alias("allocation_count"))
    pay_amt = (_money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")
    shipped, returned = F.col("l_linestatus") == "F", F.col("l_returnflag") == "R"
    by_line = lm.groupBy(*keys).agg(
        F.sum(F.when(shipped, _money("l_extendedprice"))).alias("total_expense_amount"),
        F.count(F.when(shipped, F.lit(1))).alias("expense_count"),
        F.sum(F.when(returned, pay_amt)).alias("total_payment_amount"),
        F.count(F.when(returned, F.lit(1))).alias("payment_count"))
    # The period bounds are two scalars; the scaffold is members exploded over those months.
    lo, hi = o.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    scaffold = member_months(nations, lo, hi)
    x = scaffold_measures(scaffold, keys, [by_order, by_line])
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return x.select(
        date_key(F.last_day("month_start")).alias("month_key"), "nation_id",
        z("total_donation_amount").cast("decimal(18,2)").alias("total_donation_amount"),
        z("total_expense_amount").cast("decimal(18,2)").alias("total_expense_amount"),
        z("total_payment_amount").cast("decimal(18,2)").alias("total_payment_amount"),
        (z("total_donation_amount") - z("total_expense_amount") - z("total_payment_amount"))
        .cast("decimal(18,2)").alias("net_balance"),
        *[z(c).cast("long").alias(c) for c in ("donation_count", "expense_count", "payment_count", "allocation_count")])


# --- A7 + A9: lifecycle per (customer, priority, status, stage) ------------------------------
LIFECYCLE_END = _dt.datetime(2030, 1, 1)


def order_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                  "o_orderdate", "o_orderpriority")
    o = settled(history_before(orders, "o_orderdate", LIFECYCLE_END), "o_orderstatus", dd.ORDER_SETTLED)
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    # First allocation (ship) date key per order, over all lines (not bounded by the window).
    lines = li.groupBy("l_orderkey").agg(F.min(date_key("l_shipdate")).alias("allocated_date_key"),
                                         F.max((F.col("l_returnflag") == "R").cast("int")).alias("has_return"))
    o = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    o = lookup_key(o, dd.customer_dim(spark, sf_dir), {"o_custkey": "customer_id"}, "customer_key")
    o = lookup_key(o, dd.priority_dim(spark, sf_dir), [(norm_lower("o_orderpriority"), "code")], "priority_key")
    st = dd.status_dim(spark, sf_dir).filter(F.col("status_type") == "order")
    o = lookup_key(o, st, [(norm_lower("o_orderstatus"), "code")], "status_key")
    status = norm_lower("o_orderstatus")
    dk = date_key("o_orderdate")
    stage = (F.when(F.col("has_return") == 1, F.lit("refunded")).when(status == "o", F.lit("open"))
              .when(F.col("allocated_date_key").isNotNull(), F.lit("allocated")).otherwise(F.lit("fulfilled")))
    base = o.select(
        F.col("o_orderkey").alias("source_order_id"), "customer_key", "priority_key", "status_key",
        F.coalesce(dk, F.lit(-1)).alias("created_date_key"),
        F.when(status == "f", F.coalesce(dk, F.lit(-1))).otherwise(F.lit(-1)).alias("fulfilled_date_key"),
        F.coalesce("allocated_date_key", F.lit(-1)).alias("allocated_date_key"), stage.alias("current_stage"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    nz = lambda c: F.coalesce(F.min(F.when(F.col(c) != -1, F.col(c))), F.lit(-1)).alias(c)
    agg = base.groupBy("customer_key", "priority_key", "status_key", "current_stage").agg(
        F.min("source_order_id").alias("source_order_id"), nz("created_date_key"), nz("fulfilled_date_key"),
        nz("allocated_date_key"), F.sum("amount").cast("decimal(18,2)").alias("order_amount"),
        F.min("amount").alias("min_order"), F.max("amount").alias("max_order"),
        F.count("amount").alias("order_count"), F.sum("amount").alias("_sum"))
    return agg.withColumn("avg_order", exact_avg(F.col("_sum"), F.col("order_count"), 2, 18)).drop("_sum")


LIFECYCLE_SQL = """
WITH cust AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
prio AS (SELECT code, row_number() OVER (ORDER BY code) AS priority_key
         FROM (SELECT DISTINCT lower(trim(o_orderpriority)) AS code FROM orders) WHERE code IS NOT NULL AND code <> ''),
st AS (SELECT status_type, code, row_number() OVER (ORDER BY status_type, code) AS status_key
       FROM (SELECT 'order' AS status_type, c AS code FROM (VALUES ('f'), ('o'), ('p')) v(c)
             UNION SELECT 'line', lower(trim(l_linestatus)) FROM lineitem WHERE l_linestatus IS NOT NULL)),
lines AS (SELECT l_orderkey, min(CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER)) AS allocated_date_key,
                 max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_return FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey AS source_order_id, coalesce(cust.customer_key, -1) AS customer_key,
         coalesce(prio.priority_key, -1) AS priority_key, coalesce(st.status_key, -1) AS status_key,
         coalesce(CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER), -1) AS created_date_key,
         CASE WHEN lower(trim(o.o_orderstatus)) = 'f' THEN coalesce(CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER), -1) ELSE -1 END AS fulfilled_date_key,
         coalesce(lines.allocated_date_key, -1) AS allocated_date_key,
         CASE WHEN lines.has_return = 1 THEN 'refunded' WHEN lower(trim(o.o_orderstatus)) = 'o' THEN 'open'
              WHEN lines.allocated_date_key IS NOT NULL THEN 'allocated' ELSE 'fulfilled' END AS current_stage,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders o LEFT JOIN lines ON lines.l_orderkey = o.o_orderkey
  LEFT JOIN cust ON cust.c_custkey = o.o_custkey
  LEFT JOIN prio ON prio.code = lower(trim(o.o_orderpriority))
  LEFT JOIN st ON st.status_type = 'order' AND st.code = lower(trim(o.o_orderstatus))
  WHERE o.o_orderdate < TIMESTAMP '2030-01-01' AND lower(trim(coalesce(o.o_orderstatus, ''))) IN ('f', 'o'))
SELECT CAST(customer_key AS BIGINT) AS customer_key, CAST(priority_key AS BIGINT) AS priority_key,
  CAST(status_key AS BIGINT) AS status_key, current_stage, min(source_order_id) AS source_order_id,
  CAST(coalesce(min(CASE WHEN created_date_key <> -1 THEN created_date_key END), -1) AS INTEGER) AS created_date_key,
  CAST(coalesce(min(CASE WHEN fulfilled_date_key <> -1 THEN fulfilled_date_key END), -1) AS INTEGER) AS fulfilled_date_key,
  CAST(coalesce(min(CASE WHEN allocated_date_key <> -1 THEN allocated_date_key END), -1) AS INTEGER) AS allocated_date_key,
  CAST(sum(amount) AS DECIMAL(18,2)) AS order_amount, min(amount) AS min_order, max(amount) AS max_order,
  CAST(count(amount) AS BIGINT) AS order_count,
  CAST(CAST((2 * CAST(sum(amount) * 100 AS HUGEINT) + count(amount)) // (2 * count(amount)) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS avg_order
FROM base GROUP BY customer_key, priority_key, status_key, current_stage
"""


@register("lifecycle_agg", ("A7", "A9", "SC7", "K10", "V12"), LIFECYCLE_SQL)
def lifecycle_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lifecycle(spark, sf_dir)
