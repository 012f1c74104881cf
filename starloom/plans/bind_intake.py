"""Polymorphic references (Q17, V9) and CSV intake with a reject channel (SC9) on whole tables, with planted faults."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.references import PolymorphicKey, polymorphic_orphans
from starloom.plans.driver_sources import LINE_ID_SQL, with_line_id
from starloom.plans.registry import register
from starloom.session import cut_lineage, ensure_checkpoint_dir
from starloom.sources.csv_rejects import check_manifest, read_checked, write_checked
from starloom.sources.tables import load


@register("polymorphic_orphans", ("Q17", "V9"), f"""
WITH li AS (SELECT {LINE_ID_SQL} AS id FROM lineitem l),
t AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'donation' WHEN 1 THEN 'customer' WHEN 2 THEN 'line' ELSE 'thing' END AS entity_type,
        CASE WHEN o_orderkey % 50 = 0 THEN -o_orderkey - 1 WHEN o_orderkey % 50 = 1 THEN NULL WHEN o_orderkey % 4 = 0 THEN o_orderkey
             WHEN o_orderkey % 4 = 1 THEN o_custkey ELSE o_orderkey END AS entity_id FROM orders)
SELECT entity_type, count(*) AS n_rows, count(*) FILTER (entity_id IS NULL) AS n_without_id,
  count(*) FILTER (entity_type = 'thing' OR (entity_id IS NOT NULL AND (
    (entity_type = 'donation' AND entity_id NOT IN (SELECT o_orderkey FROM orders)) OR
    (entity_type = 'customer' AND entity_id NOT IN (SELECT c_custkey FROM customer)) OR
    (entity_type = 'line' AND entity_id NOT IN (SELECT id FROM li))))) AS n_orphans
FROM t GROUP BY 1
""")
def polymorphic_orphans_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that each refer to an order, a customer, a line or something unknown: every fiftieth to an id that does not exist, and
    those after them to none."""
    key = F.col("o_orderkey")
    kind = F.when(key % 4 == 0, " Donation").when(key % 4 == 1, "customer").when(key % 4 == 2, "LINE").otherwise("thing")
    ref = (F.when(key % 50 == 0, -key - 1).when(key % 50 == 1, F.lit(None).cast("long")).when(key % 4 == 1, F.col("o_custkey")).otherwise(key))
    rows = load(spark, sf_dir, "orders").select(kind.alias("kind"), ref.alias("ref"))
    lines = with_line_id(load(spark, sf_dir, "lineitem")).select("line_id")
    parents = {"donation": (load(spark, sf_dir, "orders"), "o_orderkey"), "customer": (load(spark, sf_dir, "customer"), "c_custkey"),
               "line": (lines, "line_id")}
    return polymorphic_orphans(rows, PolymorphicKey("kind", "ref", parents))


_ORDERS = "o_orderkey bigint not null, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2), o_orderdate date"


@register("csv_rejects", ("SC9",), """
WITH t AS (SELECT o_orderkey, o_orderkey % 50 AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
SELECT CASE k WHEN 0 THEN 'o_totalprice: not a decimal(18,2)' WHEN 1 THEN '4 columns instead of 5' WHEN 2 THEN 'o_orderdate: not a date'
            WHEN 3 THEN 'o_orderkey: empty' WHEN 4 THEN '6 columns instead of 5' ELSE 'loaded' END AS outcome,
  count(*) AS n_rows, CAST(sum(CASE WHEN k > 4 THEN price ELSE 0 END) AS DECIMAL(38,2)) AS amount,
  (SELECT count(*) FROM orders) AS rows_written, CAST(true AS BOOLEAN) AS changed
FROM t GROUP BY 1
""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV, spoilt in five ways in every fiftieth line, and read again: what was loaded, what was rejected and why, and that
    the manifest tells the files were changed."""
    folder = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
                                                  F.col("o_orderdate").cast("date").alias("o_orderdate"))
    write_checked({"orders": orders}, folder)
    parts = F.split("value", ",")
    key = F.expr("try_cast(split(value, ',')[0] AS BIGINT)") % 50
    spoilt = (F.when(key == 0, F.concat_ws(",", parts[0], parts[1], parts[2], F.lit("3x"), parts[4]))
              .when(key == 1, F.concat_ws(",", parts[0], parts[1], parts[2], parts[3]))
              .when(key == 2, F.concat_ws(",", parts[0], parts[1], parts[2], parts[3], F.lit("soon")))
              .when(key == 3, F.concat_ws(",", F.lit(""), parts[1], parts[2], parts[3], parts[4]))
              .when(key == 4, F.concat_ws(",", F.col("value"), F.lit("more"))).otherwise(F.col("value")))
    lines = spark.read.text(f"{folder}/orders").where(~F.col("value").startswith("o_orderkey")).select(spoilt.alias("value"))
    bad = f"{folder}-spoilt"
    spark.read.json(f"{folder}/_checksums").write.json(f"{bad}/_checksums")
    lines.write.text(f"{bad}/orders")
    good, rejects = read_checked(spark, bad, "orders", _ORDERS, header=False)
    found = cut_lineage(good.select(F.lit("loaded").alias("outcome"), "o_totalprice").unionByName(
        rejects.select(F.col("reason").alias("outcome"), F.lit(None).cast("decimal(18,2)").alias("o_totalprice"))))
    state = check_manifest(spark, bad).first()
    return found.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("o_totalprice"), F.lit(0)).cast("decimal(38,2)").alias("amount")).withColumns(
        {"rows_written": F.lit(state.rows_written).cast("long"), "changed": F.lit(not state.unchanged)})
