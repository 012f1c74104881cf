"""Q1-Q3: batch and step audit records as DataFrames (no database, no mutable state).

A job builds its step rows from the metrics DataFrames it already computes (one-row
``validation_counts`` etc.), so logging adds no extra pass over the data.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("load_log_id long, etl_batch_id int, source_table string, target_table string, load_status string, "
              "rows_read long, rows_written long, rows_rejected long, message string")


def load_log_rows(steps: list[tuple[int, str, DataFrame]]) -> DataFrame:
    """Turn [(batch_id, table, one-row counts frame)] into load-log rows with sequential ids."""
    out = None
    for i, (batch, table, counts) in enumerate(steps, start=1):
        row = counts.select(F.lit(i).cast("long").alias("load_log_id"), F.lit(batch).cast("int").alias("etl_batch_id"),
                            F.lit(table).alias("source_table"), F.col("rows_read").cast("long"),
                            F.col("rows_valid").cast("long").alias("rows_written"),
                            F.col("rows_rejected").cast("long"))
        out = row if out is None else out.unionByName(row)
    return out


def batch_rollup(log: DataFrame) -> DataFrame:
    """A10: per batch totals of the step rows."""
    return log.groupBy("etl_batch_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_steps"), F.sum("rows_read").cast("long").alias("rows_read"),
        F.sum("rows_written").cast("long").alias("rows_written"),
        F.sum("rows_rejected").cast("long").alias("rows_rejected"))


def recent_log(log: DataFrame, n: int = 100) -> DataFrame:
    """L2: the newest ``n`` log rows (TakeOrdered: a bounded top-k, not a global sort)."""
    return log.orderBy(F.col("load_log_id").desc()).limit(n)


@dataclass
class BatchLog:
    """Q1/Q2: accumulate batch and step records for one job run; ``frames`` returns DataFrames.

    Timestamps are supplied by the caller (``load_ts``) so reruns are reproducible.
    """
    spark: SparkSession
    source_system: str
    target_layer: str
    mart_name: str
    load_ts: _dt.datetime
    batch_id: int = 1
    steps: list = field(default_factory=list)
    status: str = "running"
    error: str | None = None

    def step(self, source_table: str, target_table: str, rows_read: int, rows_written: int,
             rows_rejected: int = 0, status: str = "succeeded", message: str | None = None) -> None:
        self.steps.append((len(self.steps) + 1, self.batch_id, source_table, target_table, status,
                           int(rows_read), int(rows_written), int(rows_rejected), message))

    def finish(self, status: str = "succeeded", error: str | None = None) -> None:
        self.status, self.error = status, error

    def frames(self) -> tuple[DataFrame, DataFrame]:
        log = self.spark.createDataFrame(self.steps, LOG_SCHEMA)
        totals = (sum(s[5] for s in self.steps), sum(s[6] for s in self.steps), sum(s[7] for s in self.steps))
        batch = self.spark.createDataFrame(
            [(self.batch_id, self.source_system, self.target_layer, self.mart_name, self.status, self.load_ts,
              self.load_ts, *totals, self.error)],
            "etl_batch_id int, source_system string, target_layer string, mart_name string, batch_status string, "
            "started_at timestamp_ntz, ended_at timestamp_ntz, rows_read long, rows_written long, "
            "rows_rejected long, error_message string")
        return batch, log


def run_logged(log: BatchLog, step_name: str, fn, *args, **kwargs):
    """Q2: run ``fn``; on failure record a failed step and batch, then re-raise."""
    try:
        return fn(*args, **kwargs)
    except Exception as exc:  # noqa: BLE001
        log.step(step_name, step_name, 0, 0, 0, status="failed", message=str(exc))
        log.finish("failed", str(exc))
        raise


def assert_tables(spark: SparkSession, paths: dict[str, str]) -> None:
    """Q3: every prerequisite table must be readable before a mart run starts."""
    missing = []
    for name, path in paths.items():
        try:
            spark.read.parquet(path).schema  # noqa: B018
        except Exception:  # noqa: BLE001
            missing.append(name)
    if missing:
        raise RuntimeError("missing prerequisite tables: " + ", ".join(sorted(missing)))
