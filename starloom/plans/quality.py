"""Reconciliation and data-quality checks (Q4-Q21) as aggregate DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scd2_current_check(dim: DataFrame, nk: str, key_col: str) -> DataFrame:
    """Q10: exactly one current version per member; closed versions carry an end."""
    per = (dim.filter(F.col(key_col) != -1).groupBy(nk).agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.sum(F.col("is_current").cast("int")).alias("n_current"),
        F.sum((~F.col("is_current") & F.col("effective_to").isNull()).cast("int")).alias("n_closed_missing_end")))
    return per.agg(F.count(F.lit(1)).cast("long").alias("n_members"),
                   F.sum((F.col("n_current") == 1).cast("int")).cast("long").alias("n_one_current"),
                   F.sum("n_versions").cast("long").alias("n_versions"),
                   F.sum("n_closed_missing_end").cast("long").alias("n_closed_missing_end"))


def scalars_row(values: dict[str, DataFrame]) -> DataFrame:
    """Combine one-row, one-column count frames into a single row without a Cartesian join:
    stack them as (name, value) rows, then fold with one conditional aggregate."""
    stacked = None
    for name, df in values.items():
        r = df.select(F.lit(name).alias("_n"), F.col(df.columns[0]).cast("long").alias("_v"))
        stacked = r if stacked is None else stacked.unionByName(r)
    return stacked.agg(*[F.max(F.when(F.col("_n") == n, F.col("_v"))).alias(n) for n in values])


def reconcile(left: DataFrame, right: DataFrame, materialize: bool = True) -> DataFrame:
    """Q4/Q5 (U4): two-way EXCEPT ALL. One row: sizes and the rows found on one side only.

    Each side feeds four aggregates; ``materialize`` writes each side once to the checkpoint
    folder so neither is recomputed four times."""
    from starloom.session import cut_lineage
    cols = sorted(left.columns)
    a, b = left.select(*cols), right.select(*cols)
    if materialize:
        a, b = cut_lineage(a), cut_lineage(b)
    cnt = lambda df: df.agg(F.count(F.lit(1)))
    return scalars_row({"n_left": cnt(a), "n_right": cnt(b),
                        "n_only_left": cnt(a.exceptAll(b)), "n_only_right": cnt(b.exceptAll(a))})


def date_signature(fact: DataFrame, date_col: str, amount_cols: list[str], flag_cols: list[str]) -> DataFrame:
    """Q6: per date: row count, sums scaled to integers (x100), flag sums. Stable across reruns."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.sum((F.col(c) * 100).cast("long")).alias(f"{c}_x100") for c in amount_cols]
    aggs += [F.sum(F.col(c)).cast("long").alias(f"{c}_sum") for c in flag_cols]
    return fact.groupBy(date_col).agg(*aggs)


def completeness(source: DataFrame, fact: DataFrame, id_col: str, date_col: str) -> DataFrame:
    """Q7: per date: source rows, fact rows, source ids missing from the fact."""
    missing = source.join(fact.select(id_col), id_col, "left_anti").groupBy(date_col) \
                    .agg(F.count(F.lit(1)).alias("n_missing"))
    s = source.groupBy(date_col).agg(F.count(F.lit(1)).alias("n_source"))
    f = fact.groupBy(date_col).agg(F.count(F.lit(1)).alias("n_fact"))
    out = s.join(f, date_col, "full_outer").join(missing, date_col, "left")
    return out.select(date_col, *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                  for c in ("n_source", "n_fact", "n_missing")])


def duplicate_groups(df: DataFrame, grain: list[str]) -> DataFrame:
    """Q19: number of grain values that occur more than once (one row)."""
    return df.groupBy(*grain).count().filter(F.col("count") > 1) \
             .agg(F.count(F.lit(1)).cast("long").alias("n_duplicate_groups"))


def count_where(df: DataFrame, checks: dict[str, "F.Column"]) -> DataFrame:
    """Q8/Q13: one row of counts, one column per named condition."""
    return df.agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(n) for n, c in checks.items()]) \
             .select(*[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in checks])


def orphan_counts(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Q17: one row per FK check: (check_name, problem_count) via left anti joins."""
    out = None
    for name, child, fk, parent, pk in checks:
        c = child.select(F.col(fk).alias("_k")).filter(F.col("_k").isNotNull())
        p = parent.select(F.col(pk).alias("_k"))
        row = c.join(p, "_k", "left_anti").agg(F.count(F.lit(1)).cast("long").alias("problem_count")) \
               .select(F.lit(name).alias("check_name"), "problem_count")
        out = row if out is None else out.unionByName(row)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of per-table row counts, ordered by table name."""
    out = None
    for name in sorted(tables):
        row = tables[name].agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
                          .select(F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out.orderBy("table_name")


def schema_contract(df: DataFrame, required: list[str], forbidden: list[str] = ()) -> list[str]:
    """Q12: problems with a table's column contract (empty list = contract holds)."""
    cols = set(df.columns)
    return [f"missing column {c}" for c in required if c not in cols] + \
           [f"unexpected column {c}" for c in forbidden if c in cols]


def invalid_staged_rows(staging: DataFrame) -> DataFrame:
    """Q14: one row: staged rows that are not valid (must be 0 after a load)."""
    return staging.agg(F.sum((~F.coalesce(F.col("is_valid"), F.lit(False))).cast("long")).alias("n_invalid")) \
                  .select(F.coalesce("n_invalid", F.lit(0)).cast("long").alias("n_invalid"))


def type1_propagation(dim: DataFrame, source: DataFrame, nk: str, attrs: list[str], key_col: str) -> DataFrame:
    """Q21: every source member appears once in the Type 1 dimension with current attributes."""
    d = dim.filter(F.col(key_col) != -1)
    dup = d.groupBy(nk).count().filter(F.col("count") > 1).agg(F.count(F.lit(1)))
    j = source.select(nk, *attrs).join(d.select(nk, *[F.col(a).alias(f"_d_{a}") for a in attrs]), nk, "left")
    mismatch = None
    for a in attrs:
        c = ~F.col(a).eqNullSafe(F.col(f"_d_{a}"))
        mismatch = c if mismatch is None else mismatch | c
    return scalars_row({"n_members": source.agg(F.count(F.lit(1))),
                        "n_mismatched": j.filter(mismatch).agg(F.count(F.lit(1))),
                        "n_duplicated": dup})


def event_consistency(progress: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Q9: every progress row has exactly one event and every event has its progress row."""
    p = progress.select(*[F.coalesce(F.col(k), F.lit(-1)).alias(k) for k in keys])
    e = events.select(*[F.coalesce(F.col(k), F.lit(-1)).alias(k) for k in keys])
    return scalars_row({"n_progress": p.agg(F.count(F.lit(1))), "n_events": e.agg(F.count(F.lit(1))),
                        "n_missing_event": p.join(e, keys, "left_anti").agg(F.count(F.lit(1))),
                        "n_orphan_event": e.join(p, keys, "left_anti").agg(F.count(F.lit(1)))})


def documented_dq(program: dict[str, DataFrame], finance: dict[str, DataFrame]) -> DataFrame:
    """Q15: the data-quality problems the design notes name, one row per check:
    children whose center does not exist, non-positive donation amounts, and assessment
    scores outside their score scale (via the assignment's scale)."""
    orphans = orphan_counts([("child_without_center", program["children"], "center_id", program["centers"], "id")])
    bad_amount = finance["donations"].filter(F.col("amount") <= 0).agg(
        F.count(F.lit(1)).cast("long").alias("problem_count")).select(
        F.lit("non_positive_donation").alias("check_name"), "problem_count")
    ta = program["task_assessments"].select("daily_task_assignment_id", "score")
    dta = program["daily_task_assignments"].select(F.col("id").alias("_a"), "score_scale_id")
    sc = program["score_scales"].select(F.col("id").alias("_s"), "min_score", "max_score")
    scored = ta.filter(F.col("score").isNotNull()).join(dta, F.col("daily_task_assignment_id") == F.col("_a")) \
               .join(sc, F.col("score_scale_id") == F.col("_s"))
    outside = scored.filter((F.col("score") < F.col("min_score")) | (F.col("score") > F.col("max_score"))).agg(
        F.count(F.lit(1)).cast("long").alias("problem_count")).select(
        F.lit("score_outside_scale").alias("check_name"), "problem_count")
    return orphans.unionByName(bad_amount).unionByName(outside)


# ----------------------------------------------------------------- checks of Mart 1's facts
def _named_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """check_name and problem_count of several conditions, in one pass over ``df``."""
    counts = count_where(df, checks)
    pairs = ", ".join(f"'{n}', `{n}`" for n in checks)
    return counts.select(F.expr(f"stack({len(checks)}, {pairs}) AS (check_name, problem_count)"))


def flag_problems(progress: DataFrame) -> DataFrame:
    """Q8: rows of the task-progress fact that break a rule of its flags (a missing flag counts as 0)."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(0))
    has_score, assessment = F.col("raw_score").isNotNull(), F.col("source_task_assessment_id").isNotNull()
    classes = ("is_scored", "is_not_scored", "is_refused", "is_cancelled", "is_incomplete")
    none = F.lit(True)
    for c in classes:
        none = none & (flag(c) == 0)
    return _named_counts(progress, {
        "scored_and_not_scored": (flag("is_scored") == 1) & (flag("is_not_scored") == 1),
        "score_without_flag": has_score & (flag("is_scored") != 1), "flag_without_score": (flag("is_scored") == 1) & ~has_score,
        "not_scored_with_score": (flag("is_not_scored") == 1) & has_score, "assessment_not_assessed": assessment & (flag("is_assessed") != 1),
        "plan_assessed": ~assessment & F.col("source_daily_task_assignment_id").isNotNull() & (flag("is_assessed") != 0),
        "assessment_unclassified": assessment & (flag("is_assessed") == 1) & none})


def duplicate_grains(task_rows: DataFrame, task_events: DataFrame, assessed_rows: DataFrame, assessed_events: DataFrame, daily_spans: DataFrame,
                     runs: list, accumulation: DataFrame, group: tuple[str, ...] = ("child_id", "center_id", "teacher_id")) -> DataFrame:
    """Q19: check_name and problem_count for every grain of Mart 1's facts. Plan rows and events are one per assignment, assessment rows
    and events one per assessment; ``daily_spans`` hold a (day, group) once; ``accumulation`` holds a group once."""
    from starloom.operators.intervals import repeated_days
    plan, assessed = "source_daily_task_assignment_id", "source_task_assessment_id"
    planned = F.col(assessed).isNull() & F.col(plan).isNotNull()
    given = F.col(assessed).isNotNull()
    grains = {"planned rows": (task_rows.where(planned), [plan]), "assessment rows": (assessed_rows.where(given), [assessed]),
              "PLAN events": (task_events.where(planned & (F.col("event_type") == "PLAN")), [plan]),
              "ASSESSMENT events": (assessed_events.where(given & (F.col("event_type") == "ASSESSMENT")), [assessed]),
              "accumulation rows": (accumulation, list(group))}
    out = repeated_days(daily_spans, runs, group).select(F.lit("daily rows").alias("check_name"), F.col("n").alias("problem_count"))
    for name, (df, grain) in grains.items():
        out = out.unionByName(duplicate_groups(df.select(*grain), grain).select(F.lit(name).alias("check_name"), F.col("n_duplicate_groups").alias("problem_count")))
    return out


def one_sided(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row, ``problem_count``: distinct rows found on one side only (EXCEPT both ways), by one aggregate over both sides."""
    cols = left.columns
    both = left.withColumn("_l", F.lit(1)).unionByName(right.select(*cols).withColumn("_l", F.lit(0)))
    sides = both.groupBy(*cols).agg(F.max("_l").alias("_in_left"), F.min("_l").alias("_all_left"))
    return sides.where(F.col("_in_left") == F.col("_all_left")).agg(F.count(F.lit(1)).cast("long").alias("problem_count"))


def accumulation_problems(accumulation: DataFrame, last_day: DataFrame, progress: DataFrame,
                          group: tuple[str, ...] = ("child_id", "center_id", "teacher_id")) -> DataFrame:
    """Q5: the accumulation's counts against the daily snapshot's rows of its last day, and its first and last days against the fact."""
    keys = [F.coalesce(c, F.lit(-1)).alias(c) for c in group]
    counts = ["planned_task_count", "assessment_count", "completed_task_count", "scored_task_count"]
    day = F.coalesce("date_key", F.lit(-1))
    dates = {f"{edge}_{kind}_date_key": agg(F.when(F.col(col).isNotNull(), day))
             for kind, col in (("plan", "source_daily_task_assignment_id"), ("assessment", "source_task_assessment_id"))
             for edge, agg in (("first", F.min), ("last", F.max))}
    history = progress.groupBy(*keys).agg(*[e.alias(n) for n, e in dates.items()])
    of_day = one_sided(accumulation.select(*keys, *counts), last_day.select(*keys, *counts))
    of_history = one_sided(accumulation.select(*keys, *dates), history)
    return of_day.select(F.lit("counts of the last day").alias("check_name"), "problem_count").unionByName(
        of_history.select(F.lit("first and last days").alias("check_name"), "problem_count"))
