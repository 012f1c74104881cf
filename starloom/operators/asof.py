"""As-of join of two tables on a time column, for any skew of the equality keys.

Both sides are united and range-partitioned by (keys, time), so a key that holds most rows is spread over many partitions. Inside a partition
the last value is carried forward; what a partition starts with is the last value of the partitions before it for the same keys,
one small row per partition and key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, values: list[str],
              partitions: int | None = None) -> DataFrame:
    """``left`` with ``values`` of the latest ``right`` row of the same ``by`` at or before ``left_time``; null where there is none, where a
    key is null or where the time is null. Of right rows with equal keys and time the one with the greatest values counts."""
    from starloom.session import cut_lineage
    spark = left.sparkSession
    held = F.struct(*[F.col(v) for v in values])
    known = right.where(F.col(right_time).isNotNull()).groupBy(*by, F.col(right_time).alias("_t")).agg(F.max(held).alias("_v"))
    rows = left.select(*by, F.col(left_time).alias("_t"), F.struct("*").alias("_row"))
    # Nulls in keys sort together but match nothing; values come before rows of the same time.
    both = rows.withColumn("_side", F.lit(1)).unionByName(known.dropna(subset=by).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = cut_lineage(both.repartitionByRange(n, *by, "_t", "_side").withColumn("_part", F.spark_partition_id()))
    latest = placed.where(F.col("_v").isNotNull()).groupBy(*by, "_part").agg(F.max_by("_v", "_t").alias("_end"))
    # Parts that hold a key, also those without a value of it.
    seen = placed.dropna(subset=by).select(*by, "_part").distinct().join(latest, [*by, "_part"], "left")
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = seen.select(*by, "_part", F.last("_end", ignorenulls=True).over(before).alias("_start"))
    inside = Window.partitionBy(*by, "_part").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = placed.withColumn("_carried", F.last("_v", ignorenulls=True).over(inside)).where(F.col("_side") == 1)
    out = carried.join(start, [*by, "_part"], "left")
    value = F.when(F.col("_t").isNotNull(), F.coalesce("_carried", "_start"))
    return out.select("_row.*", *[value[v].alias(v) for v in values])


def convert_amounts(amounts: DataFrame, rates: DataFrame, amount: str = "amount", currency: str = "currency", date: str = "date",
                    partitions: int | None = None) -> DataFrame:
    """``amounts`` with the rate of the latest rate date at or before ``date`` and the converted amount, four decimals, rounded half
    up. Before a currency's first rate, and for currencies without one, both are null: such rows are reported, not dropped."""
    found = asof_join(amounts, rates.select(F.col("from_currency").alias(currency), "rate_date", "rate"), [currency], date, "rate_date", ["rate"], partitions)
    exact = F.col(amount).cast("decimal(18,2)") * F.col("rate").cast("decimal(18,8)")
    return found.withColumn("converted", F.round(exact, 4).cast("decimal(38,4)"))
