"""Extract, hash, validation and staging-load bindings (SC*, V*, K1, K2)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import ts_lit

from starloom.functions.hashing import row_hash
from starloom.functions.text import norm_lower
from starloom.operators.loads import full_refresh, hash_upsert
from starloom.operators.lookups import latest_per_key
from starloom.operators.validation import (
    ForeignKey, greater_than, in_domain, ordered, required, split_valid, validate, validation_counts,
)
from starloom.plans.registry import register
from starloom.sources.lineage import stamp_lineage
from starloom.sources.tables import load
from starloom.sources.watermark import (
    business_window, change_window, created_watermark, date_watermark, history_before, inclusive_watermark, parent_watermark,
)

WATERMARK = _dt.datetime(1999, 6, 30)
# The domain of the customer market segment column.
SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
ORDER_STATUSES = ["f", "o", "p"]


def _dec(c, p=18, s=2):
    return F.col(c).cast(f"decimal({p},{s})")


# --- SC1 + V1 + SC10 -----------------------------------------------------------------------
@register("watermark_extract", ("SC1", "V1", "SC10"), """
SELECT l.l_orderkey, l.l_linenumber,
       sha256(concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
              CAST(CAST(l.l_quantity AS DECIMAL(18,2)) AS VARCHAR),
              CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR),
              l.l_returnflag, l.l_linestatus, CAST(l.l_shipdate AS VARCHAR))) AS row_hash,
       CAST(1 AS INTEGER) AS etl_batch_id, 'TPCH' AS source_system, 'tpch' AS source_database,
       'dbo' AS source_schema, 'lineitem' AS source_table,
       TIMESTAMP '1999-06-30 00:00:00' AS extracted_at,
       coalesce(l.l_shipdate, o.o_orderdate) AS source_updated_at
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE coalesce(l.l_shipdate, o.o_orderdate) <= TIMESTAMP '1999-06-30 00:00:00'
""")
def watermark_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey"), F.col("o_orderdate").alias("created_at"))
    src = li.join(o, li.l_orderkey == o.o_orderkey).withColumnRenamed("l_shipdate", "updated_at")
    x = inclusive_watermark(src, WATERMARK, "updated_at", "created_at")
    x = x.withColumn("row_hash", row_hash("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          _dec("l_quantity"), _dec("l_extendedprice"), "l_returnflag",
                                          "l_linestatus", "updated_at"))
    x = stamp_lineage(x, 1, "TPCH", "tpch", "dbo", "lineitem", WATERMARK,
                      F.coalesce("updated_at", "created_at"))
    return x.select("l_orderkey", "l_linenumber", "row_hash", "etl_batch_id", "source_system",
                    "source_database", "source_schema", "source_table", "extracted_at", "source_updated_at")


# --- SC4 / J12 -----------------------------------------------------------------------------
@register("parent_watermark", ("SC4", "SC2", "J12"), """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey
FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey
              AND o.o_orderdate <= TIMESTAMP '1999-06-30 00:00:00')
  AND EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey
              AND p.p_retailprice > 0 AND p.p_size BETWEEN 1 AND 50)
""")
def parent_watermark_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = created_watermark(load(spark, sf_dir, "orders"), WATERMARK, "o_orderdate")
    part = load(spark, sf_dir, "part").filter((F.col("p_retailprice") > 0) & F.col("p_size").between(1, 50))
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return parent_watermark(li, [(orders, "l_orderkey", "o_orderkey"), (part, "l_partkey", "p_partkey")])


# --- SC5 -----------------------------------------------------------------------------------
@register("change_window", ("SC5",), """
SELECT event_id, user_id, event_type, ts FROM events
WHERE coalesce(ts, TIMESTAMP '1900-01-01') >= TIMESTAMP '2024-01-10' AND coalesce(ts, TIMESTAMP '1900-01-01') < TIMESTAMP '2024-01-20'
""")
def change_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").withColumn("_floor", F.lit("1900-01-01").cast("timestamp_ntz"))
    x = change_window(ev, _dt.datetime(2024, 1, 10), _dt.datetime(2024, 1, 20), ["ts", "_floor"], prune_col="ts")
    return x.select("event_id", "user_id", "event_type", "ts")


# --- SC3, SC6, SC7 -------------------------------------------------------------------------
@register("date_windows", ("SC3", "SC6", "SC7"), """
SELECT o_orderstatus,
       CAST(count(*) FILTER (WHERE CAST(o_orderdate AS DATE) <= DATE '1998-12-31') AS BIGINT) AS n_upto,
       CAST(count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01') AS BIGINT) AS n_window,
       CAST(count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS BIGINT) AS n_history
FROM orders GROUP BY o_orderstatus
""")
def date_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus",
                                             F.to_date("o_orderdate").alias("order_day"), "o_orderdate")
    upto = date_watermark(o, _dt.datetime(1998, 12, 31), "order_day").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_upto"))
    win = business_window(o, "o_orderdate", _dt.datetime(1997, 1, 1), _dt.datetime(1998, 1, 1)) \
        .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_window"))
    hist = history_before(o, "o_orderdate", _dt.datetime(1998, 1, 1)).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_history"))
    statuses = o.select("o_orderstatus").distinct()
    out = statuses.join(upto, "o_orderstatus", "left").join(win, "o_orderstatus", "left") \
                  .join(hist, "o_orderstatus", "left")
    return out.select("o_orderstatus", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                         for c in ("n_upto", "n_window", "n_history")])


# --- V1 / V2 -------------------------------------------------------------------------------
@register("row_hash", ("V1",), """
SELECT c_custkey, sha256(concat_ws('|', c_custkey, c_name, c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), c_mktsegment)) AS row_hash
FROM customer
""")
def row_hash_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", row_hash("c_custkey", "c_name", "c_nationkey",
                                          _dec("c_acctbal", 12, 2), "c_mktsegment").alias("row_hash"))


@register("attribute_hash", ("V2", "A2"), """
SELECT p_brand, lower(trim(p_name)) AS title,
       sha256(concat_ws('|', p_brand, lower(trim(p_name)))) AS attr_hash, CAST(count(*) AS BIGINT) AS n_parts
FROM part GROUP BY p_brand, lower(trim(p_name))
""")
def attribute_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_brand", norm_lower("p_name").alias("title"))
    return p.groupBy("p_brand", "title").agg(F.count(F.lit(1)).alias("n_parts")) \
            .withColumn("attr_hash", row_hash("p_brand", "title"))


# --- V3-V8 ---------------------------------------------------------------------------------
def validated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    nation = load(spark, sf_dir, "nation")
    rules = [required("c_name"), required("c_mktsegment"), in_domain("c_mktsegment", SEGMENTS),
             greater_than("c_acctbal", 0, inclusive=True)]
    return validate(c, rules, [ForeignKey("c_nationkey", nation, "n_nationkey")])


CUSTOMER_RULES_SQL = """
SELECT *, nullif(concat(
          CASE WHEN c_name IS NULL THEN 'c_name missing; ' ELSE '' END,
          CASE WHEN c_mktsegment IS NULL THEN 'c_mktsegment missing; ' ELSE '' END,
          CASE WHEN c_mktsegment IS NOT NULL AND lower(trim(c_mktsegment)) NOT IN
               ('automobile','building','furniture','household','machinery') THEN 'c_mktsegment invalid; ' ELSE '' END,
          CASE WHEN c_acctbal IS NOT NULL AND NOT (c_acctbal >= 0) THEN 'c_acctbal out of range; ' ELSE '' END,
          CASE WHEN c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey IS NOT NULL)
               THEN 'c_nationkey not found; ' ELSE '' END), '') AS validation_message
FROM customer"""


@register("validation_message", ("V3", "V4", "V5", "V6", "V8"), f"""
SELECT c_custkey, validation_message IS NULL AS is_valid, validation_message FROM ({CUSTOMER_RULES_SQL})
""")
def validation_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated_customers(spark, sf_dir).select("c_custkey", "is_valid", "validation_message")


def validated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    x = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    rules = [required("l_shipdate"), greater_than("l_quantity", 0), ordered("o_orderdate", "l_shipdate"),
             in_domain("l_returnflag", ["a", "n", "r"])]
    return validate(x, rules, [ForeignKey("l_partkey", load(spark, sf_dir, "part"), "p_partkey"),
                               ForeignKey("l_suppkey", load(spark, sf_dir, "supplier"), "s_suppkey")])


def validated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    rules = [required("o_custkey"), required("o_orderdate"), in_domain("o_orderstatus", ORDER_STATUSES),
             greater_than("o_totalprice", 0)]
    return validate(o, rules, [ForeignKey("o_custkey", load(spark, sf_dir, "customer"), "c_custkey")])


@register("reject_counts", ("V10", "V7", "V4", "V5", "V6", "V8"), f"""
SELECT 'customer' AS source_table, CAST(count(*) AS BIGINT) AS rows_read,
       CAST(count(*) FILTER (WHERE validation_message IS NULL) AS BIGINT) AS rows_valid,
       CAST(count(*) FILTER (WHERE validation_message IS NOT NULL) AS BIGINT) AS rows_rejected
FROM ({CUSTOMER_RULES_SQL})
UNION ALL
SELECT 'orders', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM (
  SELECT (o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
          AND (o_orderstatus IS NULL OR lower(trim(o_orderstatus)) IN ('f','o','p'))
          AND (o_totalprice IS NULL OR o_totalprice > 0)
          AND (o_custkey IS NULL OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL))) AS ok
  FROM orders)
UNION ALL
SELECT 'lineitem', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM (
  SELECT (l.l_shipdate IS NOT NULL AND (l.l_quantity IS NULL OR l.l_quantity > 0)
          AND NOT coalesce(o.o_orderdate > l.l_shipdate, false)
          AND (l.l_returnflag IS NULL OR lower(trim(l.l_returnflag)) IN ('a','n','r'))
          AND (l.l_partkey IS NULL OR l.l_partkey IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL))
          AND (l.l_suppkey IS NULL OR l.l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL))) AS ok
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey)
""")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, v in (("customer", validated_customers(spark, sf_dir)), ("orders", validated_orders(spark, sf_dir)),
                    ("lineitem", validated_lines(spark, sf_dir))):
        parts.append(validation_counts(v).select(F.lit(name).alias("source_table"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- V9 ------------------------------------------------------------------------------------
@register("conditional_fk", ("V9", "J10"), """
SELECT event_id, event_type, msg IS NULL AS is_valid, msg AS validation_message FROM (
  SELECT e.event_id, e.event_type, nullif(concat(
     CASE WHEN lower(trim(e.event_type)) = 'purchase' AND e.user_id IS NOT NULL
               AND e.user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
          THEN 'user_id not found in customer; ' ELSE '' END,
     CASE WHEN lower(trim(e.event_type)) = 'view' AND e.user_id IS NOT NULL
               AND e.user_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
          THEN 'user_id not found in part; ' ELSE '' END,
     CASE WHEN lower(trim(e.event_type)) = 'click' AND e.user_id IS NOT NULL
               AND e.user_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)
          THEN 'user_id not found in supplier; ' ELSE '' END), '') AS msg
  FROM events e)
""")
def conditional_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    kind = norm_lower("event_type")
    fks = [ForeignKey("user_id", load(spark, sf_dir, "customer"), "c_custkey",
                      "user_id not found in customer; ", kind == "purchase"),
           ForeignKey("user_id", load(spark, sf_dir, "part"), "p_partkey",
                      "user_id not found in part; ", kind == "view"),
           ForeignKey("user_id", load(spark, sf_dir, "supplier"), "s_suppkey",
                      "user_id not found in supplier; ", kind == "click")]
    return validate(ev, [], fks).select("event_id", "event_type", "is_valid", "validation_message")


# --- K1 ------------------------------------------------------------------------------------
@register("full_refresh", ("K1", "V10", "V11"), f"""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id, c_mktsegment AS segment
FROM ({CUSTOMER_RULES_SQL}) WHERE validation_message IS NULL AND c_custkey IS NOT NULL
""")
def full_refresh_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid(validated_customers(spark, sf_dir))
    valid = valid.filter(F.col("c_custkey").isNotNull())
    return full_refresh(valid).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                      F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("segment"))


# --- K2 over two snapshots of the users derived from events ---------------------------------
SNAPSHOT_1 = _dt.datetime(2024, 1, 15)
SNAPSHOT_2 = _dt.datetime(2024, 1, 31)


def user_snapshot(spark: SparkSession, sf_dir: str, before, batch_id: int) -> DataFrame:
    """The state of each user as of ``before``: its latest event (J1), hashed (V1)."""
    ev = load(spark, sf_dir, "events").filter(F.col("ts") < ts_lit(before))
    latest = latest_per_key(ev.select("user_id", "ts", "event_id", "event_type", "value", "props"),
                            ["user_id"], ["ts", "event_id"])
    return latest.select(
        "user_id", "event_id", "event_type",
        row_hash("user_id", "event_id", "event_type", _dec("value", 12, 2), "props").alias("row_hash"),
        F.lit(batch_id).cast("int").alias("etl_batch_id"), F.lit(True).alias("is_valid"))


def user_snapshot_sql(before: str, batch_id: int) -> str:
    return f"""(SELECT user_id, event_id, event_type,
       sha256(concat_ws('|', user_id, event_id, event_type, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), props)) AS row_hash,
       CAST({batch_id} AS INTEGER) AS etl_batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE ts < TIMESTAMP '{before}') WHERE rn = 1)"""


@register("hash_upsert", ("K2", "J1", "V1"), f"""
WITH o AS {user_snapshot_sql('2024-01-15', 1)}, n AS {user_snapshot_sql('2024-01-31', 2)}
SELECT coalesce(n.user_id, o.user_id) AS user_id,
       CASE WHEN n.user_id IS NOT NULL AND (o.user_id IS NULL OR o.row_hash <> n.row_hash) THEN n.event_id ELSE o.event_id END AS event_id,
       CASE WHEN n.user_id IS NOT NULL AND (o.user_id IS NULL OR o.row_hash <> n.row_hash) THEN n.event_type ELSE o.event_type END AS event_type,
       CASE WHEN n.user_id IS NOT NULL AND (o.user_id IS NULL OR o.row_hash <> n.row_hash) THEN n.row_hash ELSE o.row_hash END AS row_hash,
       CASE WHEN n.user_id IS NOT NULL AND (o.user_id IS NULL OR o.row_hash <> n.row_hash) THEN n.etl_batch_id ELSE o.etl_batch_id END AS etl_batch_id,
       CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NOT NULL AND o.row_hash <> n.row_hash THEN 'update'
            ELSE 'unchanged' END AS upsert_action
FROM o FULL OUTER JOIN n ON o.user_id = n.user_id
""")
def hash_upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = user_snapshot(spark, sf_dir, SNAPSHOT_1, 1)
    new = user_snapshot(spark, sf_dir, SNAPSHOT_2, 2)
    return hash_upsert(old, new, ["user_id"]).drop("is_valid")


# --- the staging job itself (SC3 + V1 + V3-V8 + K2 + K7 + SC10) on whole orders ---------------
def _orders_spec():
    from starloom.plans.staging import FK, TableSpec
    return TableSpec(
        "orders", "tpch", "upsert", watermark="date:o_orderdate",
        required=("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"),
        domains=(("o_orderstatus", ("f", "o", "p")),), positive=("o_totalprice",),
        fks=(FK("o_custkey", "customer", "c_custkey"),), key="o_orderkey",
        columns=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))


STAGING_ENVELOPE_SQL = """o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  CAST({batch} AS INTEGER) AS etl_batch_id, 'TPCH' AS source_system, 'tpch' AS source_database,
  'tpch' AS source_schema, 'orders' AS source_table, TIMESTAMP '{ts}' AS extracted_at,
  CAST(NULL AS TIMESTAMP) AS source_updated_at, row_hash, true AS is_valid, CAST(NULL AS VARCHAR) AS validation_message"""


@register("staging_upsert", ("K2", "K7", "SC3", "V1", "V3", "V8", "V10", "SC10"), f"""
WITH src AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
                    o_orderdate, o_orderpriority FROM orders),
chk AS (SELECT *, (o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderstatus IS NOT NULL
          AND lower(trim(o_orderstatus)) IN ('f', 'o', 'p') AND (o_totalprice IS NULL OR o_totalprice > 0)
          AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)) AS ok,
          sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR),
                           CAST(o_orderdate AS VARCHAR), o_orderpriority)) AS row_hash FROM src),
r1 AS (SELECT * FROM chk WHERE ok AND o_orderdate <= TIMESTAMP '1998-01-01'),
r2 AS (SELECT * FROM chk WHERE ok AND o_orderdate <= TIMESTAMP '2030-01-01'
       AND o_orderkey NOT IN (SELECT o_orderkey FROM r1))
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS stg_row_id,
       {STAGING_ENVELOPE_SQL.format(batch=1, ts='1998-01-01 00:00:00')} FROM r1
UNION ALL
SELECT CAST((SELECT count(*) FROM r1) + row_number() OVER (ORDER BY o_orderkey) AS BIGINT),
       {STAGING_ENVELOPE_SQL.format(batch=2, ts='2030-01-01 00:00:00')} FROM r2
""")
def staging_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the generic staging job over whole orders: first up to 1998, then everything."""
    from starloom.plans.staging import stage_table
    from starloom.session import cut_lineage
    spec = _orders_spec()
    orders = load(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    sources = {"orders": orders, "customer": load(spark, sf_dir, "customer")}
    first, _, _ = stage_table(spec, sources, None, _dt.datetime(1998, 1, 1), batch_id=1)
    first = cut_lineage(first)
    second, _, _ = stage_table(spec, sources, first, _dt.datetime(2030, 1, 1), batch_id=2)
    return second
