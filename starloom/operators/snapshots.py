"""Snapshot builders without per-day loops or range joins.

Cumulative daily snapshot (A5): for each day D of [start, end) and group g, aggregate every
fact row dated <= D (or with no date). A row-per-day loop or a ``date <= D`` range join costs
O(days x rows). Here each row gets an effective day ``eff = max(coalesce(day, start), start)``:
  * distinct counts: the first effective day of each (g, id) adds 1 on that day only;
  * sums / counts / min / max: per (g, eff) partial aggregates;
then one running window per group over a day spine gives every day. Work is O(rows + groups x days)
and the window partitions hold at most one row per day, so a hot group cannot blow up a task.
"""

from __future__ import annotations

import datetime as _dt
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cond(c: Column | None) -> Column:
    return F.lit(True) if c is None else F.coalesce(c, F.lit(False))


def cumulative_daily_snapshot(facts: DataFrame, group_cols: list[str], day_col: str,
                              start: _dt.date, end: _dt.date,
                              distinct: dict[str, tuple[str, Column | None]] | None = None,
                              sums: dict[str, tuple[str, Column | None]] | None = None,
                              mins: dict[str, tuple[str, Column | None]] | None = None,
                              maxs: dict[str, tuple[str, Column | None]] | None = None,
                              day_out: str = "snapshot_date") -> DataFrame:
    """Rows (day_out, *group_cols, metrics) for every day in [start, end) on which the group
    has at least one qualifying fact row. ``sums`` produce ``<name>_sum`` and ``<name>_n``."""
    distinct, sums, mins, maxs = distinct or {}, sums or {}, mins or {}, maxs or {}
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.col(day_col)
    base = (facts.filter(day.isNull() | (day < e))
                 .withColumn("_eff", F.greatest(F.coalesce(day, s), s)))

    # Per (group, eff) partial aggregates for sums, counts, min and max.
    aggs = []
    for name, (c, cond) in sums.items():
        v = F.when(_cond(cond), F.col(c))
        aggs += [F.sum(v).alias(f"{name}_sum"), F.count(v).alias(f"{name}_n")]
    for name, (c, cond) in mins.items():
        aggs.append(F.min(F.when(_cond(cond), F.col(c))).alias(name))
    for name, (c, cond) in maxs.items():
        aggs.append(F.max(F.when(_cond(cond), F.col(c))).alias(name))
    if not aggs:
        aggs.append(F.count(F.lit(1)).alias("_rows"))
    parts = [base.groupBy(*group_cols, "_eff").agg(*aggs)]

    # First occurrence per (group, id): one aggregation per id column for all its metrics, then
    # one row per (group, first day, metric) through a stack, counted in the merge below.
    by_id = defaultdict(list)
    for name, (idc, cond) in distinct.items():
        by_id[idc].append((name, cond))
    for idc, metrics in by_id.items():
        firsts = base.filter(F.col(idc).isNotNull()).groupBy(*group_cols, idc).agg(
            *[F.min(F.when(_cond(cond), F.col("_eff"))).alias(name) for name, cond in metrics])
        stacked = firsts.select(*group_cols, F.explode(F.array(*[
            F.struct(F.lit(name).alias("m"), F.col(name).alias("d")) for name, _ in metrics])).alias("_x"))
        stacked = stacked.filter(F.col("_x.d").isNotNull())
        parts.append(stacked.groupBy(*group_cols, F.col("_x.d").alias("_eff")).agg(
            *[F.sum((F.col("_x.m") == name).cast("long")).alias(f"_new_{name}") for name, _ in metrics]))

    inc = parts[0]
    for p in parts[1:]:
        inc = inc.unionByName(p, allowMissingColumns=True)
    merge = []
    for name in sums:
        merge += [F.sum(f"{name}_sum").alias(f"{name}_sum"), F.sum(f"{name}_n").alias(f"{name}_n")]
    merge += [F.min(n).alias(n) for n in mins] + [F.max(n).alias(n) for n in maxs]
    merge += [F.sum(f"_new_{n}").alias(f"_new_{n}") for n in distinct]
    daily = inc.groupBy(*group_cols, "_eff").agg(*merge)

    # One window pass: running values on the days that change, then each such row is repeated
    # for every day until the group's next change (or the end of the window). No spine join.
    order = Window.partitionBy(*group_cols).orderBy("_eff")
    w = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = [F.col("_eff"), *[F.col(g) for g in group_cols]]
    for n in distinct:
        run.append(F.coalesce(F.sum(f"_new_{n}").over(w), F.lit(0)).cast("long").alias(n))
    for n in sums:
        run.append(F.sum(f"{n}_sum").over(w).alias(f"{n}_sum"))
        run.append(F.coalesce(F.sum(f"{n}_n").over(w), F.lit(0)).cast("long").alias(f"{n}_n"))
    run += [F.min(n).over(w).alias(n) for n in mins] + [F.max(n).over(w).alias(n) for n in maxs]
    run.append(F.coalesce(F.date_sub(F.lead("_eff").over(order), 1), F.date_sub(e, 1)).alias("_until"))
    running = daily.select(*run)
    out = [F.explode(F.sequence(F.col("_eff"), F.col("_until"))).alias(day_out), *group_cols]
    out += [c for c in running.columns if c not in ("_eff", "_until", *group_cols)]
    return running.select(*out)


def latest_row_per_group(df: DataFrame, group_cols: list[str], order_col: str) -> DataFrame:
    """The row with the greatest ``order_col`` per group (argmax, combined map-side)."""
    others = [c for c in df.columns if c not in group_cols]
    best = F.max_by(F.struct(*others), F.col(order_col)).alias("_sl_best")
    return df.groupBy(*group_cols).agg(best).select(*group_cols, "_sl_best.*")


def first_last_keys(df: DataFrame, group_cols: list[str], date_key_col: str,
                    flags: dict[str, str]) -> DataFrame:
    """Per group, MIN/MAX(CASE WHEN id IS NOT NULL THEN COALESCE(date_key, -1) END) per id column.
    ``flags`` maps an output prefix to the id column."""
    dk = F.coalesce(F.col(date_key_col), F.lit(-1))
    aggs = []
    for prefix, idc in flags.items():
        v = F.when(F.col(idc).isNotNull(), dk)
        aggs += [F.min(v).alias(f"first_{prefix}_date_key"), F.max(v).alias(f"last_{prefix}_date_key")]
    return df.groupBy(*group_cols).agg(*aggs)


def member_months(members: DataFrame, lo: _dt.date, hi: _dt.date) -> DataFrame:
    """J15 scaffold: every member row repeated for each month start in [trunc(lo), trunc(hi)].
    Built by exploding a literal month sequence per member row, so no join is involved."""
    if lo is None or hi is None:
        return members.withColumn("month_start", F.lit(None).cast("date")).limit(0)
    months = F.sequence(F.trunc(F.lit(lo).cast("date"), "month"), F.trunc(F.lit(hi).cast("date"), "month"),
                        F.expr("INTERVAL 1 MONTH"))
    return members.withColumn("month_start", F.explode(months))


def scaffold_measures(scaffold: DataFrame, keys: list[str], measures: list[DataFrame]) -> DataFrame:
    """Left-attach pre-aggregated measure frames (each unique on ``keys``) to the scaffold."""
    out = scaffold
    for m in measures:
        out = out.join(m, keys, "left")
    return out
