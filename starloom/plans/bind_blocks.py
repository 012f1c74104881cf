"""Staging over tables in blocks (K2, K3) on whole tables: three loads, the second with planted changes and faults, the third a repetition."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash
from starloom.plans.bind_extract import _orders_spec
from starloom.plans.blocks import BlockTable, HashBlocks, IdRanges
from starloom.plans.change_days import ChangeDays
from starloom.plans.registry import register
from starloom.plans.staging import stage_into, staging_blocks
from starloom.session import ensure_checkpoint_dir
from starloom.sources.tables import load

#: (batch, extract up to)
LOADS = ((1, _dt.datetime(1998, 1, 1)), (2, _dt.datetime(2030, 1, 1)), (3, _dt.datetime(2030, 1, 1)))


def _loaded(spark: SparkSession, sf_dir: str, layout) -> tuple[BlockTable, list]:
    """The table after three loads of orders, and each load's counts. From the second load on every hundredth order costs 1 more and
    every ninety-seventh has a status that does not exist."""
    spec, key = _orders_spec(), F.col("o_orderkey")
    first = load(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    later = first.withColumns({
        "o_totalprice": F.when(key % 100 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast("decimal(18,2)"),
        "o_orderstatus": F.when(key % 97 == 0, "x").otherwise(F.col("o_orderstatus"))})
    customer = load(spark, sf_dir, "customer")
    table = staging_blocks(spark, spec, f"{ensure_checkpoint_dir(spark)}/blocks-{uuid.uuid4().hex}", layout)
    counts = []
    for batch, to_date in LOADS:
        done, row, _ = stage_into(spec, {"orders": first if batch == 1 else later, "customer": customer}, table, to_date, batch)
        counts.append((batch, done, row))
        table.remove_versions(keep=1)
    return table, counts


_STAGED_SQL = """
WITH src AS (SELECT o_orderkey, o_custkey, o_orderstatus AS s1, CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE o_orderstatus END AS s2,
    CAST(o_totalprice AS DECIMAL(18,2)) AS p1,
    CAST(CASE WHEN o_orderkey % 100 = 7 THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS p2,
    o_orderdate, o_orderpriority FROM orders),
chk AS (SELECT *, (o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
          AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)) AS ok,
    coalesce(lower(trim(s1)) IN ('f', 'o', 'p'), false) AND coalesce(p1 > 0, true) AS ok1,
    coalesce(lower(trim(s2)) IN ('f', 'o', 'p'), false) AND coalesce(p2 > 0, true) AS ok2,
    sha256(concat_ws('|', o_orderkey, o_custkey, s1, CAST(p1 AS VARCHAR), CAST(o_orderdate AS VARCHAR), o_orderpriority)) AS h1,
    sha256(concat_ws('|', o_orderkey, o_custkey, s2, CAST(p2 AS VARCHAR), CAST(o_orderdate AS VARCHAR), o_orderpriority)) AS h2 FROM src),
x1 AS (SELECT *, ok AND ok1 AS v FROM chk WHERE o_orderdate <= TIMESTAMP '1998-01-01'),
x2 AS (SELECT *, ok AND ok2 AS v FROM chk WHERE o_orderdate <= TIMESTAMP '2030-01-01'),
r1 AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rid FROM x1 WHERE v),
n2 AS (SELECT *, (SELECT count(*) FROM r1) + row_number() OVER (ORDER BY o_orderkey) AS rid FROM x2
       WHERE v AND o_orderkey NOT IN (SELECT o_orderkey FROM r1)),
u2 AS (SELECT r1.rid, x2.* FROM x2 JOIN r1 USING (o_orderkey) WHERE x2.v AND x2.h2 <> r1.h1)
"""


@register("blocks_staged_orders", ("K2", "K7", "K9", "V10", "SC10"), _STAGED_SQL + """
SELECT CAST(rid AS BIGINT) AS stg_row_id, o_orderkey, s1 AS o_orderstatus, p1 AS o_totalprice, CAST(1 AS INTEGER) AS etl_batch_id, h1 AS row_hash
FROM r1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u2)
UNION ALL SELECT CAST(rid AS BIGINT), o_orderkey, s2, p2, CAST(2 AS INTEGER), h2 FROM u2
UNION ALL SELECT CAST(rid AS BIGINT), o_orderkey, s2, p2, CAST(2 AS INTEGER), h2 FROM n2
""")
def blocks_staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _loaded(spark, sf_dir, IdRanges(10_000))
    return table.read().select("stg_row_id", "o_orderkey", "o_orderstatus", "o_totalprice", "etl_batch_id", "row_hash")


@register("blocks_load_log", ("Q1", "K2", "V10", "A10"), _STAGED_SQL + """
SELECT CAST(1 AS INTEGER) AS etl_batch_id, (SELECT count(*) FROM x1) AS rows_read, (SELECT count(*) FROM r1) AS rows_valid,
  (SELECT count(*) FROM x1 WHERE NOT v) AS rows_rejected, (SELECT count(*) FROM r1) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
  CAST(0 AS BIGINT) AS rows_unchanged
UNION ALL SELECT CAST(b AS INTEGER), (SELECT count(*) FROM x2), (SELECT count(*) FROM x2 WHERE v), (SELECT count(*) FROM x2 WHERE NOT v),
  CASE b WHEN 2 THEN (SELECT count(*) FROM n2) ELSE 0 END, CASE b WHEN 2 THEN (SELECT count(*) FROM u2) ELSE 0 END,
  (SELECT count(*) FROM x2 WHERE v) - CASE b WHEN 2 THEN (SELECT count(*) FROM n2) + (SELECT count(*) FROM u2) ELSE 0 END
FROM (VALUES (2), (3)) AS t(b)
""")
def blocks_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load read, rejected, inserted, updated and left as it was, as the jobs that did it observed."""
    _, counts = _loaded(spark, sf_dir, HashBlocks(64))
    out = None
    for batch, done, row in counts:
        row = row.select(F.lit(batch).cast("int").alias("etl_batch_id"), "*", F.lit(done.rows_unchanged).cast("long").alias("rows_unchanged"))
        out = row if out is None else out.unionByName(row)
    return out


@register("blocks_appended_events", ("K3", "K12"), """
SELECT event_id, user_id, event_type, CAST(CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS INTEGER) AS etl_batch_id FROM events
""")
def blocks_appended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended by their id in two loads, the second of which brings all of the first again, and a third that brings nothing new."""
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    table = BlockTable(spark, f"{ensure_checkpoint_dir(spark)}/events-{uuid.uuid4().hex}", ("event_id",), HashBlocks(32))
    early = F.col("ts") < F.lit(_dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    for batch, rows in ((1, events.where(early)), (2, events), (3, events)):
        table.append(rows.drop("ts").withColumn("etl_batch_id", F.lit(batch).cast("int")))
    return table.read()


@register("change_day_window", ("SC5", "SC1", "K2"), """
WITH t AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 3 THEN o_orderdate + INTERVAL 45 DAY ELSE o_orderdate END AS changed_at FROM orders)
SELECT o_orderkey, o_orderstatus, CAST(changed_at AS TIMESTAMP) AS changed_at FROM t
WHERE changed_at >= TIMESTAMP '1997-11-20 00:00:00' AND changed_at < TIMESTAMP '1998-03-01 12:00:00'
""")
def change_day_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the fortnight of their change, of which every tenth then changes 45 days later and moves; a window of 102 days is read from its fortnights."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"))
    hashed = lambda df: df.withColumn("row_hash", row_hash("o_orderkey", "o_orderstatus", "updated_at", "created_at"))
    none = F.lit(None).cast("timestamp_ntz")
    table = ChangeDays(spark, f"{ensure_checkpoint_dir(spark)}/change-days-{uuid.uuid4().hex}", ("o_orderkey",), index_blocks=64, days_per_block=14)
    table.load(hashed(orders.withColumn("updated_at", none)))
    later = F.when(F.col("o_orderkey") % 10 == 3, F.col("created_at") + F.expr("INTERVAL 45 DAYS")).otherwise(none)
    table.load(hashed(orders.withColumn("updated_at", later)))
    table.remove_versions(keep=1)
    return table.window(_dt.datetime(1997, 11, 20), _dt.datetime(1998, 3, 1, 12)).select(
        "o_orderkey", "o_orderstatus", F.coalesce("updated_at", "created_at").alias("changed_at"))
