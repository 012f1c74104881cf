"""Reporting bindings (R1-R4, R6) and the either/or task lookup (J7 + D8 shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.text import norm_lower
from starloom.operators.lookups import either_or_key
from starloom.operators.scd import scd1_rebuild
from starloom.plans.bind_snapshots import monthly_snapshot_scaffold
from starloom.plans.registry import REGISTRY, register
from starloom.sources.tables import load


def _revenue():
    return F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


@register("cube_progress", ("R1",), """
SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS INTEGER) AS grouping_level,
  CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(38,4)) AS revenue
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")
def cube_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Measures are computed once per line, before the cube repeats each row per grouping set.
    li = load(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_quantity").cast("decimal(18,2)").alias("_qty"),
        _revenue().alias("_rev"))
    return li.cube("l_returnflag", "l_linestatus").agg(
        F.grouping_id().cast("int").alias("grouping_level"), F.count(F.lit(1)).alias("n_lines"),
        F.sum("_qty").cast("decimal(38,2)").alias("sum_qty"),
        F.sum("_rev").cast("decimal(38,4)").alias("revenue"))


@register("rollup_finance", ("R2",), """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus,
  CAST(grouping_id(year(o_orderdate), o_orderstatus) AS INTEGER) AS grouping_level,
  CAST(count(*) AS BIGINT) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount
FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus)
""")
def rollup_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    return o.rollup("order_year", "o_orderstatus").agg(
        F.grouping_id().cast("int").alias("grouping_level"), F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_amount"))


@register("drill_across", ("R3",), """
WITH a AS (SELECT c.c_nationkey AS nation_id, count(*) AS n_orders, sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS order_total
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1),
b AS (SELECT s.s_nationkey AS nation_id, count(*) AS n_lines,
             sum(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS line_revenue
      FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey GROUP BY 1)
SELECT coalesce(a.nation_id, b.nation_id) AS nation_id, CAST(coalesce(a.n_orders, 0) AS BIGINT) AS n_orders,
  CAST(coalesce(a.order_total, 0) AS DECIMAL(38,2)) AS order_total, CAST(coalesce(b.n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(b.line_revenue, 0) AS DECIMAL(38,4)) AS line_revenue
FROM a FULL OUTER JOIN b ON a.nation_id = b.nation_id
""")
def drill_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate each fact to the conformed nation grain first, then full-outer join the small results."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_id"))
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_discount")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation_id"))
    a = o.join(c, o.o_custkey == c.c_custkey).groupBy("nation_id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("order_total"))
    b = li.join(s, li.l_suppkey == s.s_suppkey).groupBy("nation_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(_revenue()).alias("line_revenue"))
    j = a.join(b, "nation_id", "full_outer")
    return j.select("nation_id", F.coalesce("n_orders", F.lit(0)).cast("long").alias("n_orders"),
                    F.coalesce("order_total", F.lit(0)).cast("decimal(38,2)").alias("order_total"),
                    F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce("line_revenue", F.lit(0)).cast("decimal(38,4)").alias("line_revenue"))


def _scaffold_sql() -> str:
    return REGISTRY["monthly_snapshot_scaffold"].sql


@register("trend_dashboard", ("R4",), f"""
WITH s AS ({_scaffold_sql()}),
m AS (SELECT month_key, CAST(sum(net_balance) AS DECIMAL(38,2)) AS net_balance FROM s GROUP BY month_key)
SELECT month_key, net_balance, lag(net_balance) OVER (ORDER BY month_key) AS prev_net_balance,
       CAST(net_balance - lag(net_balance) OVER (ORDER BY month_key) AS DECIMAL(38,2)) AS net_change
FROM m
""")
def trend_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = monthly_snapshot_scaffold(spark, sf_dir).groupBy("month_key").agg(
        F.sum("net_balance").cast("decimal(38,2)").alias("net_balance"))
    # The window runs over one row per month (already aggregated), so one partition is fine.
    w = Window.orderBy("month_key")
    prev = F.lag("net_balance").over(w)
    return monthly.select("month_key", "net_balance", prev.alias("prev_net_balance"),
                          (F.col("net_balance") - prev).cast("decimal(38,2)").alias("net_change"))


@register("roll_forward", ("R6",), f"""
WITH s AS ({_scaffold_sql()})
SELECT month_key, nation_id, net_balance,
  CAST(coalesce(sum(net_balance) OVER (PARTITION BY nation_id ORDER BY month_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DECIMAL(38,2)) AS opening_balance,
  CAST(sum(net_balance) OVER (PARTITION BY nation_id ORDER BY month_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS closing_balance
FROM s
""")
def roll_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = monthly_snapshot_scaffold(spark, sf_dir).select("month_key", "nation_id", "net_balance")
    w = Window.partitionBy("nation_id").orderBy("month_key")
    closing = F.sum("net_balance").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    opening = F.sum("net_balance").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return s.select("month_key", "nation_id", "net_balance",
                    F.coalesce(opening, F.lit(0)).cast("decimal(38,2)").alias("opening_balance"),
                    closing.cast("decimal(38,2)").alias("closing_balance"))


# --- J7: template id, or (domain, title) for custom tasks -----------------------------------
TEMPLATE_MAX_SIZE = 25


def part_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task rows per part: template-based for small parts, custom (domain, title) otherwise."""
    p = load(spark, sf_dir, "part")
    is_t = F.col("p_size") <= TEMPLATE_MAX_SIZE
    return p.select("p_partkey", F.when(is_t, F.col("p_partkey")).alias("template_id"),
                    norm_lower("p_type").alias("domain"), norm_lower("p_name").alias("title"), is_t.alias("is_t"))


def task_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = part_tasks(spark, sf_dir)
    code = F.when(F.col("is_t"), F.concat(F.lit("TEMPLATE:"), F.col("template_id").cast("string"))) \
            .otherwise(F.concat(F.lit("CUSTOM:"), F.col("domain"), F.lit(":"), F.col("title")))
    src = t.withColumn("task_code", code).groupBy("task_code").agg(
        F.min("template_id").alias("template_id"), F.min("domain").alias("domain"), F.min("title").alias("title"))
    return scd1_rebuild(src, None, ["task_code"], "task_key",
                        unknown={"task_code": "UNKNOWN", "domain": "unknown", "title": "Unknown"})


@register("either_or_lookup", ("J7", "D8", "J17"), f"""
WITH t AS (SELECT CASE WHEN p_size <= {TEMPLATE_MAX_SIZE} THEN 'TEMPLATE:' || CAST(p_partkey AS VARCHAR)
                       ELSE 'CUSTOM:' || lower(trim(p_type)) || ':' || lower(trim(p_name)) END AS task_code,
                  CASE WHEN p_size <= {TEMPLATE_MAX_SIZE} THEN p_partkey END AS template_id,
                  lower(trim(p_type)) AS domain, lower(trim(p_name)) AS title FROM part),
d AS (SELECT row_number() OVER (ORDER BY task_code) AS task_key, * FROM (
        SELECT task_code, min(template_id) AS template_id, min(domain) AS domain, min(title) AS title FROM t GROUP BY task_code)),
f AS (SELECT l.l_orderkey, l.l_linenumber, CASE WHEN p.p_size <= {TEMPLATE_MAX_SIZE} THEN l.l_partkey END AS template_id,
             lower(trim(p.p_type)) AS domain, lower(trim(p.p_name)) AS title
      FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey)
SELECT f.l_orderkey, f.l_linenumber, CAST(coalesce(a.k, b.k, -1) AS BIGINT) AS task_key
FROM f LEFT JOIN (SELECT template_id, max(task_key) AS k FROM d WHERE template_id IS NOT NULL GROUP BY 1) a
  ON a.template_id = f.template_id
LEFT JOIN (SELECT domain, title, max(task_key) AS k FROM d WHERE template_id IS NULL GROUP BY 1, 2) b
  ON f.template_id IS NULL AND b.domain = f.domain AND b.title = f.title
""")
def either_or_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = part_tasks(spark, sf_dir).drop("is_t")
    f = li.join(parts, li.l_partkey == parts.p_partkey, "left")
    dim = task_dim(spark, sf_dir).filter(F.col("task_key") != -1)
    out = either_or_key(
        f, dim,
        first=({"template_id": "template_id"}, F.col("template_id").isNotNull()),
        second=({"domain": "domain", "title": "title"}, F.col("template_id").isNull()),
        key_col="task_key", out_col="task_key", second_guard=F.col("template_id").isNull())
    return out.select("l_orderkey", "l_linenumber", "task_key")
