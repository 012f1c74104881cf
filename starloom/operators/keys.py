"""K7: gap-free surrogate keys ordered by a natural key, without a one-partition window.

``row_number() OVER (ORDER BY nk)`` moves every row through one task. Instead:
  1. range-partition on the total order (natural key first) and sort inside each partition;
  2. tag rows with ``monotonically_increasing_id`` (partition id in the high bits,
     position in the low 33 bits) and write them to a work table, so a lost executor cannot re-sample
     the range bounds and renumber rows differently;
  3. count rows per partition (one row per partition reaches the driver), turn the
     counts into offsets and broadcast that partition-sized table back.
key = base + offset(partition) + position + 1, identical to the global row_number.

Rows are ordered by the natural key and then by every other column: a total order, so ties are numbered the same way
on any recomputation and whatever the size. Inputs that a bounded count proves tiny (at most ``SMALL_MAX_ROWS``) are sorted in one
partition instead, in the same order and so with the same keys, which saves the sampling and the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_in_parts, holding

_POS_BITS = 33
SMALL_MAX_ROWS = 10_000
#: Rows that one task of a wide sort gets; the session's number of shuffle partitions holds up to so many rows each.
ROWS_PER_TASK = 2_000_000


def tasks_for(spark, rows: int) -> int | None:
    """The number of partitions for a sort or join of so many rows, if the session's number would give a task more than ROWS_PER_TASK."""
    n = -(-rows // ROWS_PER_TASK)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


#: Rows that are moved at a time by a job that writes its rows range by range, if that makes no more than MOST_RANGES: then a range holds
#: more. The job's shuffles are those of one range; every range scans what the job reads, so their number is bounded.
ROWS_PER_RANGE = 4_000_000
MOST_RANGES = 6


@dataclass(frozen=True)
class KeyRange:
    """Whole-number keys above ``low`` and up to ``high``, None for no bound; NULLs are below all."""

    low: int | None = None
    high: int | None = None

    def of(self, df: DataFrame, col: str) -> DataFrame:
        return df if self.low is None and self.high is None else df.filter(self.holds(F.col(col)))

    def holds(self, key: Column) -> Column:
        if self.low is None:
            return F.lit(True) if self.high is None else key.isNull() | (key <= self.high)
        return key > self.low if self.high is None else (key > self.low) & (key <= self.high)


def key_ranges(df: DataFrame, col: str, rows: int) -> list[KeyRange]:
    """Ranges in ascending order that hold every key once, with about as many of the ``rows`` of ``df`` each. One range if the rows are
    few or the key is no whole number."""
    n = min(-(-rows // ROWS_PER_RANGE), MOST_RANGES)
    if n <= 1 or df.schema[col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        return [KeyRange()]
    cuts = df.agg(F.percentile_approx(col, [i / n for i in range(1, n)], F.lit(10_000))).first()[0]
    cuts = sorted({int(c) for c in cuts or ()})
    return [KeyRange(low, high) for low, high in zip([None, *cuts], [*cuts, None])]


def sortable_columns(df: DataFrame) -> list[str]:
    simple = ("string", "int", "bigint", "smallint", "tinyint", "boolean", "date", "timestamp", "timestamp_ntz",
              "double", "float", "binary")
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in simple or f.dataType.simpleString().startswith("decimal")]


def assign_keys(df: DataFrame, order_cols: list[str], key_col: str, base: int = 0,
                num_partitions: int | None = None, known_rows: int | None = None, stored: bool = False,
                parts: Sequence[DataFrame] = (), written: Callable[[int], None] = lambda i: None) -> DataFrame:
    """``stored``: ``df`` is read from a work table or a source, so it may be read several times: large ones are sorted range by range.
    ``parts``: the rows of ``df`` by such ranges, where they lie apart; ``written`` is told the place of each that is not read again."""
    from starloom.operators.lookups import bounded_count
    spark = df.sparkSession
    order = list(order_cols) + [c for c in sortable_columns(df) if c not in order_cols]
    rows = known_rows if known_rows is not None else (
        bounded_count(df, SMALL_MAX_ROWS) if num_partitions is None else None)
    if num_partitions is None and rows is not None and rows <= SMALL_MAX_ROWS:
        one = df.repartition(1).sortWithinPartitions(*order)
        return one.withColumn(key_col, (F.lit(base) + F.monotonically_increasing_id() + 1).cast("long"))
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    apart = list(parts) if len(parts) > 1 else [r.of(df, order[0]) for r in (key_ranges(df, order[0], rows) if stored and rows else [KeyRange()])]
    if len(apart) > 1:
        n = max(-(-n // len(apart)), min(n, spark.sparkContext.defaultParallelism))

    def sorted_rows():
        for i, part in enumerate(apart):
            yield (part.repartitionByRange(max(1, n), *order)
                       .sortWithinPartitions(*order)
                       .withColumn("_sl_mid", F.monotonically_increasing_id() + F.lit((i * max(1, n)) << _POS_BITS)))
            written(i)
    ranged = cut_in_parts(sorted_rows())
    pid = F.shiftright("_sl_mid", _POS_BITS)
    counts = sorted(ranged.groupBy(pid.alias("p")).count().collect())  # <= n rows
    offsets, running = [], 0
    for row in counts:
        offsets.append((int(row["p"]), running))
        running += int(row["count"])
    if not offsets:
        return holding(ranged.drop("_sl_mid").withColumn(key_col, F.lit(None).cast("long")), ranged)
    off = spark.createDataFrame(offsets, "_sl_p long, _sl_off long")
    pos = F.col("_sl_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    keyed = (ranged.join(F.broadcast(off), pid == F.col("_sl_p"))  # partition-count rows
                   .withColumn(key_col, (F.lit(base) + F.col("_sl_off") + pos + 1).cast("long"))
                   .drop("_sl_mid", "_sl_p", "_sl_off"))
    return holding(keyed, ranged)


def max_key(df: DataFrame, key_col: str) -> int:
    """Largest existing key (0 when empty). One scalar aggregate."""
    v = df.agg(F.max(key_col)).first()[0]
    return int(v) if v is not None and v > 0 else 0
