"""Fact-builder bindings: transaction fact, lineage append, null-safe append, event fact."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.text import norm_lower
from starloom.operators.loads import append_new
from starloom.operators.lookups import checked_broadcast, lookup_key
from starloom.operators.validation import settled
from starloom.plans import driver_dims as dd
from starloom.plans.driver_dims import STATUS_DIM_SQL
from starloom.plans.driver_sources import LINE_ID_SQL, with_line_id
from starloom.plans.registry import register
from starloom.sources.tables import load
from starloom.sources.watermark import business_window

# Window of the first load used by the bindings: it spans every order date.
FIRST_START = _dt.datetime(1990, 1, 1)
FIRST_END = _dt.datetime(2030, 1, 1)


def order_transactions(spark: SparkSession, sf_dir: str, start=FIRST_START, end=FIRST_END) -> DataFrame:
    """F7 on orders: one row per settled order in [start, end), dimension keys resolved."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    o = settled(business_window(orders, "o_orderdate", start, end), "o_orderstatus", dd.ORDER_SETTLED)
    o = o.withColumn("_status", norm_lower("o_orderstatus")).withColumn("_dk", date_key("o_orderdate"))
    dates = checked_broadcast(dd.order_calendar(spark, sf_dir).select("TimeKey"))  # calendar days
    o = lookup_key(o, dates, {"_dk": "TimeKey"}, "TimeKey", "date_key", pick=None)
    o = lookup_key(o, dd.customer_dim(spark, sf_dir), {"o_custkey": "customer_id"}, "customer_key")
    o = lookup_key(o, dd.priority_dim(spark, sf_dir), [(norm_lower("o_orderpriority"), "code")], "priority_key")
    st = dd.status_dim(spark, sf_dir).filter(F.col("status_type") == "order")
    o = lookup_key(o, st, {"_status": "code"}, "status_key")
    return o.select(
        "date_key", "customer_key", "priority_key", "status_key",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        (F.col("_status") == "f").cast("int").alias("is_fulfilled"),
        (F.col("_status") == "o").cast("int").alias("is_open"),
        F.col("o_orderkey").alias("source_order_id"))


TRANSACTION_FACT_SQL = """
WITH cust AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
prio AS (SELECT code, row_number() OVER (ORDER BY code) AS priority_key
         FROM (SELECT DISTINCT lower(trim(o_orderpriority)) AS code FROM orders) WHERE code IS NOT NULL AND code <> ''),
st AS (SELECT status_type, code, row_number() OVER (ORDER BY status_type, code) AS status_key
       FROM (SELECT 'order' AS status_type, c AS code FROM (VALUES ('f'), ('o'), ('p')) v(c)
             UNION SELECT 'line', lower(l_linestatus) FROM lineitem WHERE l_linestatus IS NOT NULL)),
o AS (SELECT * FROM orders
      WHERE o_orderdate >= TIMESTAMP '1990-01-01' AND o_orderdate < TIMESTAMP '2030-01-01'
        AND lower(trim(coalesce(o_orderstatus, ''))) IN ('f', 'o'))
SELECT CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER) AS date_key,
       CAST(coalesce(cust.customer_key, -1) AS BIGINT) AS customer_key,
       CAST(coalesce(prio.priority_key, -1) AS BIGINT) AS priority_key,
       CAST(coalesce(st.status_key, -1) AS BIGINT) AS status_key,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount,
       CAST(lower(trim(o.o_orderstatus)) = 'f' AS INTEGER) AS is_fulfilled,
       CAST(lower(trim(o.o_orderstatus)) = 'o' AS INTEGER) AS is_open,
       o.o_orderkey AS source_order_id
FROM o
LEFT JOIN cust ON cust.c_custkey = o.o_custkey
LEFT JOIN prio ON prio.code = lower(trim(o.o_orderpriority))
LEFT JOIN st ON st.status_type = 'order' AND st.code = lower(trim(o.o_orderstatus))
"""


@register("transaction_fact", ("F7", "SC6", "V11", "V12", "J2", "J3", "J4", "K7", "D15"), TRANSACTION_FACT_SQL)
def transaction_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_transactions(spark, sf_dir)


def order_transactions_sql(start: str, end: str) -> str:
    return TRANSACTION_FACT_SQL.replace("TIMESTAMP '1990-01-01'", f"TIMESTAMP '{start}'") \
                               .replace("TIMESTAMP '2030-01-01'", f"TIMESTAMP '{end}'")


PHASE_1_END = _dt.datetime(1998, 1, 1)


@register("append_antijoin", ("K3", "J13", "F7"), f"""
WITH phase1 AS ({order_transactions_sql('1990-01-01', '1998-01-01')}),
load_map AS (SELECT 'fact_order_transaction' AS fact_name, 'orders' AS source_table, source_order_id AS source_id FROM phase1),
phase2 AS ({TRANSACTION_FACT_SQL})
SELECT * FROM phase2 WHERE NOT EXISTS (
  SELECT 1 FROM load_map m WHERE m.fact_name = 'fact_order_transaction' AND m.source_table = 'orders'
    AND m.source_id = phase2.source_order_id)
""")
def append_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    phase1 = order_transactions(spark, sf_dir, FIRST_START, PHASE_1_END)
    load_map = lineage_map(phase1, "fact_order_transaction", "orders", "source_order_id")
    phase2 = order_transactions(spark, sf_dir)
    return append_with_map(phase2, load_map, "fact_order_transaction", "orders", "source_order_id")


def lineage_map(facts: DataFrame, fact_name: str, source_table: str, id_col: str) -> DataFrame:
    """The (fact_name, source_table, source_id) rows a load adds to the lineage map."""
    return facts.select(F.lit(fact_name).alias("fact_name"), F.lit(source_table).alias("source_table"),
                        F.col(id_col).alias("source_id"))


def append_with_map(candidates: DataFrame, load_map: DataFrame, fact_name: str, source_table: str,
                    id_col: str) -> DataFrame:
    """K3: candidate fact rows whose source id is not yet in the lineage map for this fact."""
    m = load_map.filter((F.col("fact_name") == fact_name) & (F.col("source_table") == source_table)) \
                .select(F.col("source_id").alias(id_col))
    return append_new(candidates, m, [id_col])


# --- F1/F2/F3 (U3 + K4) and F4 on orders (plans) and lineitem (assessments) -----------------
def progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan rows (one per settled order) UNION ALL assessment rows (one per line)."""
    o = settled(load(spark, sf_dir, "orders"), "o_orderstatus", dd.ORDER_SETTLED)
    status = norm_lower("o_orderstatus")
    plans = o.select(
        F.col("o_orderkey").alias("source_order_id"), F.lit(None).cast("long").alias("source_line_id"),
        date_key("o_orderdate").alias("date_key"), F.lit(-1).cast("long").alias("status_key"),
        F.lit(1).alias("is_planned"), F.lit(0).alias("is_assessed"),
        (status == "f").cast("int").alias("is_completed"), F.lit(0).alias("is_cancelled"),
        F.lit(0).alias("is_refused"), F.lit(0).alias("is_scored"), F.lit(0).alias("is_not_scored"),
        F.lit(None).cast("decimal(10,2)").alias("raw_score"), F.lit(None).cast("decimal(10,4)").alias("normalized_score"))
    li = with_line_id(load(spark, sf_dir, "lineitem"))
    # The line status code becomes a key of the status dimension (resolved back in F4, J18).
    line_status = dd.status_dim(spark, sf_dir).filter(F.col("status_type") == "line")
    li = lookup_key(li, line_status, [(norm_lower("l_linestatus"), "code")], "status_key")
    scored = F.col("l_linestatus") == "F"
    raw = F.col("l_quantity").cast("decimal(10,2)")
    assessments = li.select(
        F.col("l_orderkey").alias("source_order_id"), F.col("line_id").alias("source_line_id"),
        date_key("l_shipdate").alias("date_key"), "status_key",
        F.lit(0).alias("is_planned"), F.lit(1).alias("is_assessed"), F.lit(0).alias("is_completed"),
        F.lit(0).alias("is_cancelled"), (F.col("l_returnflag") == "R").cast("int").alias("is_refused"),
        scored.cast("int").alias("is_scored"), (~scored).cast("int").alias("is_not_scored"),
        F.when(scored, raw).alias("raw_score"),
        # Normalised score = raw / max * 100 with max score 50, NULL when the raw score is NULL.
        F.when(scored, (raw / F.lit(50) * 100).cast("decimal(10,4)")).alias("normalized_score"))
    return plans.unionByName(assessments)


PROGRESS_SQL = """
SELECT o_orderkey AS source_order_id, CAST(NULL AS BIGINT) AS source_line_id,
  CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key,
  CAST(-1 AS BIGINT) AS status_key, 1 AS is_planned, 0 AS is_assessed,
  CAST(lower(trim(o_orderstatus)) = 'f' AS INTEGER) AS is_completed, 0 AS is_cancelled, 0 AS is_refused,
  0 AS is_scored, 0 AS is_not_scored, CAST(NULL AS DECIMAL(10,2)) AS raw_score, CAST(NULL AS DECIMAL(10,4)) AS normalized_score
FROM orders WHERE lower(trim(coalesce(o_orderstatus, ''))) IN ('f', 'o')
UNION ALL
SELECT l_orderkey, {LINE_ID},
  CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER),
  CAST(coalesce((SELECT st.status_key FROM ({STATUS_KEYS}) st
                 WHERE st.status_type = 'line' AND st.code = lower(trim(l_linestatus))), -1) AS BIGINT),
  0, 1, 0, 0, CAST(l_returnflag = 'R' AS INTEGER), CAST(l_linestatus = 'F' AS INTEGER), CAST(NOT (l_linestatus = 'F') AS INTEGER),
  CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(10,2)) END,
  CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity AS DECIMAL(10,2)) * 2 AS DECIMAL(10,4)) END
FROM lineitem
""".replace("{LINE_ID}", LINE_ID_SQL).replace("{STATUS_KEYS}", """SELECT status_type, code, row_number() OVER (ORDER BY status_type, code) AS status_key
  FROM (SELECT 'order' AS status_type, c AS code FROM (VALUES ('f'), ('o'), ('p')) v(c)
        UNION SELECT 'line', lower(trim(l_linestatus)) FROM lineitem WHERE l_linestatus IS NOT NULL)""")

PHASE_1_KEY = 19980101


@register("nullsafe_append", ("K4", "U3", "F3", "F1", "F2"), f"""
WITH p AS ({PROGRESS_SQL}), existing AS (SELECT * FROM p WHERE date_key < {PHASE_1_KEY})
SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM existing e
  WHERE coalesce(e.source_order_id, -1) = coalesce(p.source_order_id, -1)
    AND coalesce(e.source_line_id, -1) = coalesce(p.source_line_id, -1))
""")
def nullsafe_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = progress_rows(spark, sf_dir)
    existing = rows.filter(F.col("date_key") < PHASE_1_KEY)
    return append_new(rows, existing, ["source_order_id", "source_line_id"], null_safe=True)


def task_events(progress: DataFrame, status_dim: DataFrame) -> DataFrame:
    """one event per progress row; status from the assessment's status code (J18: key -> code),
    else a flag priority chain."""
    f = lambda c: F.col(c) == 1
    codes = checked_broadcast(status_dim.select("status_key", F.col("code").alias("_code")))
    p = progress.join(codes, "status_key", "left")
    assessed = F.col("source_line_id").isNotNull()
    status = (F.when(assessed & F.col("_code").isNotNull(), F.col("_code"))
               .when(f("is_cancelled"), "CANCELLED").when(f("is_refused"), "REFUSED")
               .when(f("is_completed"), "COMPLETED").when(f("is_scored"), "SCORED")
               .when(f("is_not_scored"), "NOT_SCORED").when(f("is_assessed"), "ASSESSED")
               .when(f("is_planned"), "PLANNED").otherwise("UNKNOWN"))
    return p.filter(F.col("source_order_id").isNotNull() | assessed).select(
        F.when(assessed, F.lit("ASSESSMENT")).otherwise(F.lit("PLAN")).alias("event_type"),
        status.alias("event_status"), "source_order_id", "source_line_id", "date_key", "raw_score",
        "normalized_score")


@register("event_fact", ("F4", "J18", "K4"), f"""
WITH p AS ({PROGRESS_SQL}), st AS ({STATUS_DIM_SQL})
SELECT CASE WHEN source_line_id IS NOT NULL THEN 'ASSESSMENT' ELSE 'PLAN' END AS event_type,
  CASE WHEN source_line_id IS NOT NULL AND st.code IS NOT NULL THEN st.code
       WHEN is_cancelled = 1 THEN 'CANCELLED' WHEN is_refused = 1 THEN 'REFUSED'
       WHEN is_completed = 1 THEN 'COMPLETED' WHEN is_scored = 1 THEN 'SCORED'
       WHEN is_not_scored = 1 THEN 'NOT_SCORED' WHEN is_assessed = 1 THEN 'ASSESSED'
       WHEN is_planned = 1 THEN 'PLANNED' ELSE 'UNKNOWN' END AS event_status,
  source_order_id, source_line_id, date_key, raw_score, normalized_score
FROM p LEFT JOIN st ON st.status_key = p.status_key
WHERE source_order_id IS NOT NULL OR source_line_id IS NOT NULL
""")
def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return task_events(progress_rows(spark, sf_dir), dd.status_dim(spark, sf_dir))


# --- F10 + J10: factless event with a conditional parent ------------------------------------
@register("factless_event", ("F10", "J10", "K3"), """
WITH cust AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
prio AS (SELECT code, row_number() OVER (ORDER BY code) AS priority_key
         FROM (SELECT DISTINCT lower(trim(o_orderpriority)) AS code FROM orders) WHERE code IS NOT NULL AND code <> '')
SELECT l.l_orderkey, l.l_linenumber,
  CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS INTEGER) AS date_key,
  CASE WHEN l.l_returnflag = 'N' THEN 'order' ELSE 'internal' END AS source_type,
  CAST(coalesce(cust.customer_key, -1) AS BIGINT) AS customer_key, CAST(coalesce(prio.priority_key, -1) AS BIGINT) AS priority_key
FROM lineitem l
LEFT JOIN orders o ON l.l_returnflag = 'N' AND o.o_orderkey = l.l_orderkey
LEFT JOIN cust ON cust.c_custkey = o.o_custkey
LEFT JOIN prio ON prio.code = lower(trim(o.o_orderpriority))
""")
def factless_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    attached = F.col("l_returnflag") == "N"
    base = li.select("l_orderkey", "l_linenumber", date_key("l_shipdate").alias("date_key"),
                     F.when(attached, F.lit("order")).otherwise(F.lit("internal")).alias("source_type"))
    # Only rows whose source is an order are joined; the rest skip the join entirely
    # (a NULL join key would otherwise hash every such row into one shuffle partition).
    with_parent = base.filter(F.col("source_type") == "order")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = with_parent.join(orders, with_parent.l_orderkey == orders.o_orderkey, "left")
    j = lookup_key(j, dd.customer_dim(spark, sf_dir), {"o_custkey": "customer_id"}, "customer_key")
    j = lookup_key(j, dd.priority_dim(spark, sf_dir), [(norm_lower("o_orderpriority"), "code")], "priority_key")
    j = j.select(*base.columns, "customer_key", "priority_key")
    rest = base.filter(F.col("source_type") != "order").select(
        *base.columns, F.lit(-1).cast("long").alias("customer_key"), F.lit(-1).cast("long").alias("priority_key"))
    return j.unionByName(rest)
