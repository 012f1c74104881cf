"""What one task of a sort or join gets does not grow with the table."""

import pytest

from pyspark.sql import functions as F

from starloom.operators import keys
from starloom.operators.loads import append_new
from starloom.plans.driver_sources import LINE_ORDER, with_line_id


def test_lines_are_numbered_by_more_tasks_when_there_are_more(spark, monkeypatch):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 40 * few
    lines = spark.range(n).select((F.col("id") % (n // 4)).alias("l_orderkey"), *[(F.col("id") * 7 % 5).cast("string").alias(c) for c in LINE_ORDER])
    before = with_line_id(lines)
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 10)
    after = with_line_id(lines)
    assert after.rdd.getNumPartitions() == 4 * few
    assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty()


@pytest.mark.parametrize("null_safe", [True, False])
def test_an_append_is_dealt_to_more_tasks_when_there_are_more_rows(spark, monkeypatch, null_safe):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(60).select(F.when(F.col("id") % 5 > 0, F.col("id") % 20).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"), F.lit("x").alias("c"))
    there = rows.where("b % 2 = 0 or b is null and a > 10")
    plain = append_new(rows, there, ["a", "b"], null_safe)
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 1)
    wide = append_new(rows, there, ["a", "b"], null_safe, rows=60 * few)
    assert wide.columns == plain.columns and wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty()
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 10 * few)
    assert "hashpartitioning(_deal" in append_new(rows, there, ["a", "b"], null_safe, rows=10 * few * (few + 1))._jdf.queryExecution().toString()
