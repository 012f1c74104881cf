"""Reconciliation, data-quality and audit bindings (Q4-Q20, A10, L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.operators.loads import append_new
from starloom.operators.validation import settled, validation_counts
from starloom.plans import driver_dims as dd
from starloom.plans.audit import batch_rollup, load_log_rows, recent_log
from starloom.plans.bind_extract import (
    user_snapshot_sql, validated_customers, validated_lines, validated_orders,
)
from starloom.plans.bind_facts import (
    PROGRESS_SQL, TRANSACTION_FACT_SQL, order_transactions, progress_rows,
)
from starloom.plans.bind_snapshots import (
    DAY0, DAY_END, brute_force_snapshot_sql, daily_cumulative_snapshot, event_facts, order_lifecycle,
    user_daily_snapshot,
)
from starloom.plans.quality import (
    completeness, count_where, date_signature, duplicate_groups, orphan_counts, reconcile, scalars_row,
    table_counts,
)
from starloom.operators.lookups import checked_broadcast
from starloom.plans.registry import register
from starloom.session import cut_lineage
from starloom.sources.tables import TABLES, load


@register("reconcile_except", ("Q4", "U4", "A5"), f"""
WITH b AS ({brute_force_snapshot_sql('2024-01-01', '2024-01-31')})
SELECT CAST(count(*) AS BIGINT) AS n_left, CAST(count(*) AS BIGINT) AS n_right,
       CAST(0 AS BIGINT) AS n_only_left, CAST(0 AS BIGINT) AS n_only_right FROM b
""")
def reconcile_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-run (incremental, K5) snapshot must equal one full rebuild, row for row."""
    incremental = daily_cumulative_snapshot(spark, sf_dir)
    rebuilt = user_daily_snapshot(event_facts(spark, sf_dir), DAY0, DAY_END)
    return reconcile(incremental, rebuilt)


@register("date_signature", ("Q6",), f"""
SELECT date_key, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(amount * 100) AS BIGINT) AS amount_x100,
       CAST(sum(is_fulfilled) AS BIGINT) AS is_fulfilled_sum, CAST(sum(is_open) AS BIGINT) AS is_open_sum
FROM ({TRANSACTION_FACT_SQL}) GROUP BY date_key
""")
def date_signature_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_signature(order_transactions(spark, sf_dir), "date_key", ["amount"], ["is_fulfilled", "is_open"])


@register("completeness", ("Q7",), f"""
WITH s AS (SELECT o_orderkey AS source_order_id,
                  CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key
           FROM orders WHERE lower(trim(coalesce(o_orderstatus, ''))) IN ('f', 'o')),
f AS ({TRANSACTION_FACT_SQL})
SELECT s.date_key, CAST(count(*) AS BIGINT) AS n_source,
       CAST((SELECT count(*) FROM f WHERE f.date_key = s.date_key) AS BIGINT) AS n_fact,
       CAST(count(*) FILTER (WHERE s.source_order_id NOT IN (SELECT source_order_id FROM f)) AS BIGINT) AS n_missing
FROM s GROUP BY s.date_key
""")
def completeness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = settled(load(spark, sf_dir, "orders"), "o_orderstatus", dd.ORDER_SETTLED)
    source = o.select(F.col("o_orderkey").alias("source_order_id"), date_key("o_orderdate").alias("date_key"))
    return completeness(source, order_transactions(spark, sf_dir), "source_order_id", "date_key")


FLAG_CHECKS_SQL = """
  CAST(count(*) FILTER (WHERE is_scored = 1 AND is_not_scored = 1) AS BIGINT) AS scored_and_not_scored,
  CAST(count(*) FILTER (WHERE (raw_score IS NOT NULL) <> (is_scored = 1)) AS BIGINT) AS score_without_flag,
  CAST(count(*) FILTER (WHERE is_planned = 1 AND source_line_id IS NULL AND is_assessed = 1) AS BIGINT) AS planned_row_assessed,
  CAST(count(*) FILTER (WHERE normalized_score < 0 OR normalized_score > 100) AS BIGINT) AS normalized_out_of_range"""


@register("flag_consistency", ("Q8",), f"SELECT {FLAG_CHECKS_SQL} FROM ({PROGRESS_SQL})")
def flag_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = progress_rows(spark, sf_dir)
    return count_where(p, {
        "scored_and_not_scored": (F.col("is_scored") == 1) & (F.col("is_not_scored") == 1),
        "score_without_flag": F.col("raw_score").isNotNull() != (F.col("is_scored") == 1),
        "planned_row_assessed": (F.col("is_planned") == 1) & F.col("source_line_id").isNull()
                                & (F.col("is_assessed") == 1),
        "normalized_out_of_range": (F.col("normalized_score") < 0) | (F.col("normalized_score") > 100)})


@register("idempotent_append", ("Q11", "K4"), f"""
WITH p AS ({PROGRESS_SQL})
SELECT CAST(count(*) AS BIGINT) AS n_first_run, CAST(0 AS BIGINT) AS n_second_run, CAST(count(*) AS BIGINT) AS n_total FROM p
""")
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = progress_rows(spark, sf_dir)
    keys = ["source_order_id", "source_line_id"]
    # The first load is written (checkpointed) like a real target, then the same load runs again.
    first = cut_lineage(append_new(rows, rows.limit(0), keys, null_safe=True))
    second = append_new(rows, first, keys, null_safe=True, rows=first.count())   # re-running the same load adds nothing
    total = first.unionByName(second)
    cnt = lambda df: df.agg(F.count(F.lit(1)))
    return scalars_row({"n_first_run": cnt(first), "n_second_run": cnt(second), "n_total": cnt(total)})


@register("unresolved_keys", ("Q13",), f"""
SELECT CAST(count(*) FILTER (WHERE customer_key = -1) AS BIGINT) AS customer_key_unknown,
       CAST(count(*) FILTER (WHERE priority_key = -1) AS BIGINT) AS priority_key_unknown,
       CAST(count(*) FILTER (WHERE status_key = -1) AS BIGINT) AS status_key_unknown,
       CAST(count(*) FILTER (WHERE date_key = -1) AS BIGINT) AS date_key_unknown
FROM ({TRANSACTION_FACT_SQL})
""")
def unresolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = order_transactions(spark, sf_dir)
    return count_where(f, {f"{k}_unknown": F.col(k) == -1
                           for k in ("customer_key", "priority_key", "status_key", "date_key")})


@register("orphan_counts", ("Q17", "Q15", "J13"), """
SELECT 'lineitem_order' AS check_name, CAST(count(*) AS BIGINT) AS problem_count FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
UNION ALL SELECT 'lineitem_part', count(*) FROM lineitem
  WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
UNION ALL SELECT 'lineitem_supplier', count(*) FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)
UNION ALL SELECT 'orders_customer', count(*) FROM orders
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
UNION ALL SELECT 'customer_nation', count(*) FROM customer
  WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey IS NOT NULL)
UNION ALL SELECT 'supplier_nation', count(*) FROM supplier
  WHERE s_nationkey IS NOT NULL AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey IS NOT NULL)
UNION ALL SELECT 'nation_region', count(*) FROM nation
  WHERE n_regionkey IS NOT NULL AND n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey IS NOT NULL)
UNION ALL SELECT 'labels_document', count(*) FROM labels
  WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)
""")
def orphan_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: load(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "supplier", "customer", "nation",
                                             "region", "labels", "documents")}
    return orphan_counts([
        ("lineitem_order", t["lineitem"], "l_orderkey", t["orders"], "o_orderkey"),
        ("lineitem_part", t["lineitem"], "l_partkey", t["part"], "p_partkey"),
        ("lineitem_supplier", t["lineitem"], "l_suppkey", t["supplier"], "s_suppkey"),
        ("orders_customer", t["orders"], "o_custkey", t["customer"], "c_custkey"),
        ("customer_nation", t["customer"], "c_nationkey", t["nation"], "n_nationkey"),
        ("supplier_nation", t["supplier"], "s_nationkey", t["nation"], "n_nationkey"),
        ("nation_region", t["nation"], "n_regionkey", t["region"], "r_regionkey"),
        ("labels_document", t["labels"], "doc_id", t["documents"], "doc_id")])


@register("table_counts", ("Q16", "U5", "L3"), " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in TABLES))
def table_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({t: load(spark, sf_dir, t) for t in TABLES})


@register("operational_summary", ("Q18", "L3"), """
SELECT 'orders_by_status' AS summary, o_orderstatus AS group_value, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'lines_by_returnflag', l_returnflag, count(*), CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2))
FROM lineitem GROUP BY l_returnflag
UNION ALL
SELECT 'lines_by_supplier_nation', CAST(s.s_nationkey AS VARCHAR), count(*), CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2))
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey GROUP BY s.s_nationkey
""")
def operational_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    li = load(spark, sf_dir, "lineitem")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    def summ(df, name, group, amount):
        return df.groupBy(F.col(group).cast("string").alias("group_value")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col(amount).cast("decimal(18,2)")).cast("decimal(18,2)").alias("total_amount")) \
            .select(F.lit(name).alias("summary"), "group_value", "n_rows", "total_amount")
    by_nation = li.join(s, li.l_suppkey == s.s_suppkey)
    return summ(o, "orders_by_status", "o_orderstatus", "o_totalprice") \
        .unionByName(summ(li, "lines_by_returnflag", "l_returnflag", "l_extendedprice")) \
        .unionByName(summ(by_nation, "lines_by_supplier_nation", "s_nationkey", "l_extendedprice")) \
        .orderBy("summary", "group_value")


@register("duplicate_grain", ("Q19",), f"""
SELECT 'transaction_fact' AS check_name, CAST(count(*) AS BIGINT) AS n_duplicate_groups FROM (
  SELECT source_order_id FROM ({TRANSACTION_FACT_SQL}) GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'progress_rows', count(*) FROM (
  SELECT source_order_id, source_line_id FROM ({PROGRESS_SQL}) GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'daily_snapshot', count(*) FROM (
  SELECT date_key, user_id FROM ({brute_force_snapshot_sql('2024-01-01', '2024-01-31')}) GROUP BY 1, 2 HAVING count(*) > 1)
""")
def duplicate_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [("transaction_fact", order_transactions(spark, sf_dir), ["source_order_id"]),
              ("progress_rows", progress_rows(spark, sf_dir), ["source_order_id", "source_line_id"]),
              ("daily_snapshot", daily_cumulative_snapshot(spark, sf_dir), ["date_key", "user_id"])]
    out = None
    for name, df, grain in checks:
        row = duplicate_groups(df, grain).select(F.lit(name).alias("check_name"), "n_duplicate_groups")
        out = row if out is None else out.unionByName(row)
    return out


@register("status_distribution", ("Q20",), f"""
WITH st AS (SELECT status_type, code, row_number() OVER (ORDER BY status_type, code) AS status_key
       FROM (SELECT 'order' AS status_type, c AS code FROM (VALUES ('f'), ('o'), ('p')) v(c)
             UNION SELECT 'line', lower(trim(l_linestatus)) FROM lineitem WHERE l_linestatus IS NOT NULL))
SELECT coalesce(st.code, 'unknown') AS status_code, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(f.is_fulfilled) AS BIGINT) AS n_fulfilled, CAST(sum(f.is_open) AS BIGINT) AS n_open,
       CAST(count(*) FILTER (WHERE (st.code = 'f') <> (f.is_fulfilled = 1) OR (st.code = 'o') <> (f.is_open = 1)) AS BIGINT) AS n_flag_mismatch
FROM ({TRANSACTION_FACT_SQL}) f LEFT JOIN st ON st.status_key = f.status_key GROUP BY 1
""")
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = order_transactions(spark, sf_dir)
    st = dd.status_dim(spark, sf_dir).select("status_key", "code")
    j = f.join(checked_broadcast(st), "status_key", "left")  # status codes
    mismatch = ((F.col("code") == "f") != (F.col("is_fulfilled") == 1)) | \
               ((F.col("code") == "o") != (F.col("is_open") == 1))
    return j.groupBy(F.coalesce("code", F.lit("unknown")).alias("status_code")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("is_fulfilled").cast("long").alias("n_fulfilled"),
        F.sum("is_open").cast("long").alias("n_open"),
        F.sum(F.coalesce(mismatch, F.lit(False)).cast("long")).alias("n_flag_mismatch"))


# --- A10 / L2 over the load log of a staging run -------------------------------------------
def staging_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [(1, "customer", validated_customers(spark, sf_dir)), (1, "orders", validated_orders(spark, sf_dir)),
             (2, "lineitem", validated_lines(spark, sf_dir))]
    return load_log_rows([(b, t, validation_counts(v)) for b, t, v in steps])


LOG_SQL = """
WITH c AS (SELECT count(*) AS r, count(*) FILTER (WHERE validation_message IS NULL) AS v FROM ({cust})),
o AS (SELECT count(*) AS r, count(*) FILTER (WHERE ok) AS v FROM (
  SELECT (o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
          AND (o_orderstatus IS NULL OR lower(trim(o_orderstatus)) IN ('f','o','p'))
          AND (o_totalprice IS NULL OR o_totalprice > 0)
          AND (o_custkey IS NULL OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL))) AS ok FROM orders)),
l AS (SELECT count(*) AS r, count(*) FILTER (WHERE ok) AS v FROM (
  SELECT (l.l_shipdate IS NOT NULL AND (l.l_quantity IS NULL OR l.l_quantity > 0)
          AND NOT coalesce(o.o_orderdate > l.l_shipdate, false)
          AND (l.l_returnflag IS NULL OR lower(trim(l.l_returnflag)) IN ('a','n','r'))
          AND (l.l_partkey IS NULL OR l.l_partkey IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL))
          AND (l.l_suppkey IS NULL OR l.l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL))) AS ok
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey)),
log AS (SELECT 1 AS load_log_id, 1 AS etl_batch_id, 'customer' AS source_table, r, v FROM c
        UNION ALL SELECT 2, 1, 'orders', r, v FROM o UNION ALL SELECT 3, 2, 'lineitem', r, v FROM l)
"""


def _log_sql() -> str:
    from starloom.plans.bind_extract import CUSTOMER_RULES_SQL
    return LOG_SQL.format(cust=CUSTOMER_RULES_SQL)


@register("batch_rollup", ("A10", "Q1"), _log_sql() + """
SELECT CAST(etl_batch_id AS INTEGER) AS etl_batch_id, CAST(count(*) AS BIGINT) AS n_steps,
       CAST(sum(r) AS BIGINT) AS rows_read, CAST(sum(v) AS BIGINT) AS rows_written, CAST(sum(r - v) AS BIGINT) AS rows_rejected
FROM log GROUP BY etl_batch_id
""")
def batch_rollup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_rollup(staging_log(spark, sf_dir))


@register("recent_log", ("L2", "Q1"), _log_sql() + """
SELECT CAST(load_log_id AS BIGINT) AS load_log_id, CAST(etl_batch_id AS INTEGER) AS etl_batch_id, source_table,
       CAST(r AS BIGINT) AS rows_read, CAST(v AS BIGINT) AS rows_written, CAST(r - v AS BIGINT) AS rows_rejected
FROM log ORDER BY load_log_id DESC LIMIT 100
""")
def recent_log_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_log(staging_log(spark, sf_dir), 100)


@register("lifecycle_vs_history", ("Q5", "U4", "A7"), """
SELECT CAST(count(*) AS BIGINT) AS n_left, CAST(count(*) AS BIGINT) AS n_right,
       CAST(0 AS BIGINT) AS n_only_left, CAST(0 AS BIGINT) AS n_only_right
FROM (SELECT o_custkey, o_orderpriority FROM orders WHERE lower(trim(coalesce(o_orderstatus, ''))) IN ('f', 'o')
      GROUP BY o_custkey, o_orderpriority)
""")
def lifecycle_vs_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: lifecycle totals per (customer, priority) equal the totals recomputed from history."""
    life = order_lifecycle(spark, sf_dir).groupBy("customer_key", "priority_key").agg(
        F.sum("order_amount").cast("decimal(18,2)").alias("amount"), F.sum("order_count").cast("long").alias("n"))
    f = order_transactions(spark, sf_dir).groupBy("customer_key", "priority_key").agg(
        F.sum("amount").cast("decimal(18,2)").alias("amount"), F.count(F.lit(1)).cast("long").alias("n"))
    return reconcile(life, f)


@register("dedup_insert", ("K12",), """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events
EXCEPT SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) FROM events WHERE ts < TIMESTAMP '2024-01-16'
""")
def dedup_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert (user, type, day) keys not present yet; duplicates in the batch collapse."""
    from starloom.operators.loads import insert_missing_distinct
    ev = load(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "ts")
    keys = ["user_id", "event_type", "day"]
    existing = ev.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).select(*keys).distinct()
    return insert_missing_distinct(ev.select(*keys), existing, keys)


@register("type1_propagation", ("Q21", "K6"), f"""
WITH s AS {user_snapshot_sql('2024-01-31', 2)}
SELECT CAST(count(*) AS BIGINT) AS n_members, CAST(0 AS BIGINT) AS n_mismatched, CAST(0 AS BIGINT) AS n_duplicated FROM s
""")
def type1_propagation_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.plans.bind_dims import scd1_rebuild_q
    from starloom.plans.bind_extract import SNAPSHOT_2, user_snapshot
    from starloom.plans.quality import type1_propagation
    dim = cut_lineage(scd1_rebuild_q(spark, sf_dir))
    src = user_snapshot(spark, sf_dir, SNAPSHOT_2, 2)
    return type1_propagation(dim, src, "user_id", ["event_type", "row_hash"], "user_key")


@register("event_fact_check", ("Q9", "F4"), f"""
WITH p AS ({PROGRESS_SQL})
SELECT CAST(count(*) AS BIGINT) AS n_progress, CAST(count(*) AS BIGINT) AS n_events,
       CAST(0 AS BIGINT) AS n_missing_event, CAST(0 AS BIGINT) AS n_orphan_event FROM p
""")
def event_fact_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.plans.bind_facts import task_events
    from starloom.plans.quality import event_consistency
    progress = cut_lineage(progress_rows(spark, sf_dir))
    events = task_events(progress, dd.status_dim(spark, sf_dir))
    return event_consistency(progress, events, ["source_order_id", "source_line_id"])
