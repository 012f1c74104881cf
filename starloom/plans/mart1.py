"""Program mart (Mart 1): dimensions D1-D8, facts F1-F6, runner ``run_mart1``.

Dimensions read the program staging tables; SCD2 dimensions (center, teacher) only see
members changed in the run window [start, end) (SC5). Facts resolve keys with equi-joins
(J2-J9), append new grain rows null-safely (K4/K5) and rebuild derived snapshots.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import ts_lit
from starloom.functions.hashing import row_hash
from starloom.functions.numeric import exact_avg
from starloom.functions.text import blank_to_null, concat_nulls_as_empty, keyword_flags, norm_lower
from starloom.operators.keys import key_ranges
from starloom.operators.loads import append_new, replace_touched, untouched
from starloom.operators.intervals import Measures, Run, expand, fold, last_days, publish
from starloom.operators.lookups import (
    DIM_BROADCAST_MAX_ROWS, bounded_count, checked_broadcast, latest_per_key, latest_value, lookup_key,
)
from starloom.operators.scd import scd1_rebuild, scd2_merge
from starloom.operators.snapshots import first_last_keys, latest_row_per_group
from starloom.operators.validation import require_params, valid_rows
from starloom.plans.audit import BatchLog, run_logged
from starloom.session import cut_in_parts, cut_lineage, discard, holding, run_concurrently
from starloom.sources.watermark import change_window

# Assessment status categories and the reason keyword groups.
SUCCESS_CODES = ["scored", "completed"]
FAILURE_CODES = ["not_scored", "refused", "absent", "incomplete", "cancelled"]
REASON_KEYWORDS = [("child", ["child", "absent", "refus"]), ("teacher", ["teacher"]),
                   ("center", ["center", "closed"]), ("system", ["system"])]
CHANGE_COLS = ["source_updated_at", "updated_at", "created_at", "extracted_at"]


def latest(stg: DataFrame) -> DataFrame:
    """V11 + J1: the valid version of every id. Staging holds one row per id (K1 replaces it, K2 reduces an extract to its latest row
    per id before the upsert), so no aggregate over the history is needed, and the filters of a run's window reach the scan."""
    return valid_rows(stg)


def changed(stg: DataFrame, start, end) -> DataFrame:
    """SC5 + J1: latest valid version of the members changed in [start, end)."""
    cols = [c for c in CHANGE_COLS if c in stg.columns]
    return latest(change_window(stg, start, end, cols))


def _status(active: Column) -> Column:
    return F.when(F.coalesce(active, F.lit(False)), F.lit("active")).otherwise(F.lit("inactive"))


# ----------------------------------------------------------------------------------- dims
def dim_center(stg, old, start, end, first_load=False):
    src = changed(stg["centers"], start, end) if not first_load else latest(
        change_window(stg["centers"], _dt.datetime(1900, 1, 1), end, [c for c in CHANGE_COLS if c in stg["centers"].columns]))
    src = src.select(F.col("id").alias("center_id"), F.trim("name").alias("center_name"), F.trim("city").alias("city"),
                     F.trim("address").alias("address"), _status(F.col("is_active")).alias("center_status"),
                     "source_system", "row_hash")
    return scd2_merge(None if first_load else old, src, ["center_id"], "center_key", "row_hash", start, end,
                      unknown={"center_id": -1, "center_name": "Unknown", "center_status": "unknown",
                               "source_system": "PROGRAM_OPS"})


def dim_teacher(stg, old, centers, start, end, first_load=False):
    t = stg["teachers"]
    src = changed(t, start, end) if not first_load else latest(
        change_window(t, _dt.datetime(1900, 1, 1), end, [c for c in CHANGE_COLS if c in t.columns]))
    cur = centers.filter(F.col("is_current") & (F.col("center_key") != -1)) \
                 .groupBy("center_id").agg(F.max_by("center_name", "center_key").alias("center_name"))
    src = src.join(cur, "center_id", "left")   # J17: current center name
    status = F.when(F.coalesce(F.col("is_active"), F.lit(False)),
                    F.coalesce(blank_to_null("employment_status"), F.lit("active"))).otherwise(F.lit("inactive"))
    src = src.select(F.col("id").alias("teacher_id"), F.trim("first_name").alias("first_name"),
                     F.trim("last_name").alias("last_name"),
                     F.trim(concat_nulls_as_empty("first_name", F.lit(" "), "last_name")).alias("full_name"),
                     "center_id", "center_name", status.alias("employment_status"), "source_system",
                     row_hash("id", "first_name", "last_name", "center_id", "center_name", "employment_status",
                              "is_active").alias("row_hash"))
    return scd2_merge(None if first_load else old, src, ["teacher_id"], "teacher_key", "row_hash", start, end,
                      unknown={"teacher_id": -1, "full_name": "Unknown", "employment_status": "unknown",
                               "source_system": "PROGRAM_OPS"})


def dim_child(stg, old):
    c = latest(stg["children"])
    src = c.select(F.col("id").alias("child_id"), F.trim("first_name").alias("first_name"),
                   F.trim("last_name").alias("last_name"),
                   F.trim(concat_nulls_as_empty("first_name", F.lit(" "), "last_name")).alias("full_name"),
                   "birth_date", "gender", "center_id", "status", "enrollment_date", "source_system",
                   row_hash("id", "first_name", "last_name", "birth_date", "gender", "center_id", "status",
                            "enrollment_date").alias("row_hash"))
    return scd1_rebuild(src, old, ["child_id"], "child_key",
                        unknown={"child_id": -1, "full_name": "Unknown", "status": "unknown",
                                 "source_system": "PROGRAM_OPS"})


def dim_domain(stg, old):
    d = latest(stg["domains"])
    src = d.select(F.col("id").alias("domain_id"), F.trim("name").alias("domain_name"),
                   F.col("description").alias("domain_description"), _status(F.col("is_active")).alias("domain_status"),
                   "source_system", row_hash("id", "name", "description", "is_active").alias("row_hash"))
    return scd1_rebuild(src, old, ["domain_id"], "domain_key",
                        unknown={"domain_id": -1, "domain_name": "Unknown", "domain_status": "unknown"})


def dim_score_scale(stg, old):
    s = latest(stg["score_scales"])
    src = s.select(F.col("id").alias("score_scale_id"), F.trim("name").alias("scale_name"), "min_score", "max_score",
                   F.col("description").alias("scale_description"), _status(F.col("is_active")).alias("scale_status"),
                   "source_system",
                   row_hash("id", "name", "min_score", "max_score", "description", "is_active").alias("row_hash"))
    return scd1_rebuild(src, old, ["score_scale_id"], "score_scale_key",
                        unknown={"score_scale_id": -1, "scale_name": "Unknown", "scale_status": "unknown"})


def dim_assessment_status(stg, old):
    ta = valid_rows(stg["task_assessments"]).filter(blank_to_null("assessment_status").isNotNull())
    code = norm_lower("assessment_status")
    # One row per code (the minimum title when spellings differ), so lookups cannot fan out.
    src = ta.groupBy(code.alias("assessment_status_code")).agg(
        F.min(F.trim("assessment_status")).alias("assessment_status_title"))
    c = F.col("assessment_status_code")
    src = src.select("assessment_status_code", "assessment_status_title",
                     F.when(c.isin(*SUCCESS_CODES), "success").when(c.isin(*FAILURE_CODES), "failure")
                      .otherwise("other").alias("assessment_status_category"),
                     c.isin(*SUCCESS_CODES).cast("int").alias("is_successful_assessment"),
                     c.isin(*FAILURE_CODES).cast("int").alias("is_failure_assessment"))
    return scd1_rebuild(src, old, ["assessment_status_code"], "assessment_status_key",
                        unknown={"assessment_status_code": "unknown", "assessment_status_title": "Unknown",
                                 "assessment_status_category": "unknown", "is_successful_assessment": 0,
                                 "is_failure_assessment": 0})


def dim_no_score_reason(stg, old):
    r = latest(stg["no_score_reasons"])
    text = concat_nulls_as_empty("title", F.lit(" "), "description")
    category, flags = keyword_flags(text, REASON_KEYWORDS)
    src = r.select(F.col("id").alias("no_score_reason_id"), F.trim("title").alias("reason_title"),
                   F.col("description").alias("reason_description"), category.alias("reason_category"),
                   flags["child"].alias("is_child_related"), flags["teacher"].alias("is_teacher_related"),
                   flags["center"].alias("is_center_related"), flags["system"].alias("is_system_related"),
                   "source_system", row_hash("id", "title", "description", "is_active").alias("row_hash"))
    return scd1_rebuild(src, old, ["no_score_reason_id"], "no_score_reason_key",
                        unknown={"no_score_reason_id": -1, "reason_title": "Unknown", "reason_category": "unknown",
                                 "is_child_related": 0, "is_teacher_related": 0, "is_center_related": 0,
                                 "is_system_related": 0})


def dim_task(stg, old, domains):
    dn = domains.filter(F.col("domain_key") != -1).select("domain_id", "domain_name")
    t = latest(stg["task_templates"]).join(dn, "domain_id", "left")
    templates = t.select(
        F.concat(F.lit("TEMPLATE:"), F.col("id").cast("string")).alias("natural_task_code"),
        F.col("id").alias("task_template_id"), F.trim("title").alias("task_title"), "domain_id", "domain_name",
        F.lit(True).alias("is_template_based"), F.col("description").alias("task_description"),
        _status(F.col("is_active")).alias("task_status"), "source_system",
        row_hash("id", "title", "domain_id", "description", "is_active").alias("row_hash"))
    plans = valid_rows(stg["child_task_plans"]).filter(
        F.col("task_template_id").isNull() & blank_to_null("task_title").isNotNull())
    custom = latest_per_key(plans.withColumn("_t", F.trim("task_title")), ["domain_id", "_t"], ["stg_row_id"]) \
        .join(dn, "domain_id", "left")
    customs = custom.select(
        F.concat(F.lit("CUSTOM:"), F.col("domain_id").cast("string"), F.lit(":"), norm_lower("task_title"))
        .alias("natural_task_code"),
        F.lit(None).cast("int").alias("task_template_id"), F.col("_t").alias("task_title"), "domain_id", "domain_name",
        F.lit(False).alias("is_template_based"), F.lit(None).cast("string").alias("task_description"),
        _status(F.col("is_active")).alias("task_status"), "source_system",
        row_hash(F.lit("CUSTOM"), "domain_id", "_t", "is_active").alias("row_hash"))
    # Counted, sampled and sorted when it is keyed: the aggregate over all plans is made once.
    src = cut_lineage(templates.unionByName(customs).dropDuplicates(["natural_task_code"]))
    return holding(scd1_rebuild(src, old, ["natural_task_code"], "task_key", unknown={
        "natural_task_code": "UNKNOWN", "task_template_id": -1, "task_title": "Unknown",
        "domain_id": -1, "domain_name": "Unknown", "is_template_based": False, "task_status": "unknown", "source_system": "SYSTEM"}), src)


# ---------------------------------------------------------------------------------- facts
FACT_COLUMNS = ["date_key", "child_key", "center_key", "teacher_key", "domain_key", "task_key", "score_scale_key",
                "assessment_status_key", "no_score_reason_key", "attempt_no", "raw_score", "normalized_score",
                "is_completed", "is_planned", "is_scored", "is_not_scored", "is_cancelled", "is_incomplete",
                "is_refused", "is_absent", "is_center_closed", "is_assessed", "source_daily_task_assignment_id",
                "source_task_assessment_id", "source_assessment_session_id", "source_child_task_plan_id",
                "source_system"]


def _current(df, dim, fact_col, nk, key, out):
    """Newest current version key (TOP 1 ... is_current ORDER BY key DESC)."""
    return lookup_key(df, dim, {fact_col: nk}, key, out, pick="max", dim_filter=F.col("is_current"))


def _lookup_sides(stg, dims) -> dict[str, DataFrame]:
    """Sides that every range of rows looks up: frames made once, so that each is counted once."""
    d = dims["dim_task"].filter(F.col("task_key") != -1).withColumn("_title", norm_lower("task_title"))
    return {"template_tasks": d.filter(F.col("task_template_id").isNotNull()), "custom_tasks": d.filter(F.col("task_template_id").isNull()),
            "days": _days(dims), "users": latest(stg["users"]).select(F.col("id").alias("_uid"), F.col("teacher_id").alias("_planner_teacher"))}


def _task_key(df, sides):
    """Template id, else (domain, trimmed lower title) among custom tasks; never an OR join."""
    a = lookup_key(df, sides["template_tasks"], {"task_template_id": "task_template_id"}, "task_key", "_k1", pick="max")
    b = lookup_key(a.withColumn("_ft", norm_lower("task_title")), sides["custom_tasks"],
                   {"domain_id": "domain_id", "_ft": "_title"}, "task_key", "_k2", pick="max")
    return b.withColumn("task_key", F.when(F.col("_k1") != -1, F.col("_k1"))
                        .when(F.col("task_template_id").isNull(), F.col("_k2")).otherwise(F.lit(-1))) \
            .drop("_k1", "_k2", "_ft")


def _day_status(stg_status: DataFrame, entity: str) -> DataFrame:
    """Latest valid status per (entity, date) by staging row id."""
    s = stg_status.filter(F.col("is_valid"))
    return latest_value(s.select(entity, "date", "status", "stg_row_id"), [entity, "date"], ["status"], "stg_row_id")


def _day_statuses(stg) -> tuple[DataFrame, DataFrame]:
    """Of children and of centers."""
    return (_day_status(stg["child_daily_status"], "child_id").withColumnRenamed("status", "_child_day"),
            _day_status(stg["center_daily_status"], "center_id").withColumnRenamed("status", "_center_day"))


def progress_candidates(stg, dims, start, end, day_statuses: tuple[DataFrame, DataFrame] | None = None,
                        sides: dict[str, DataFrame] | None = None) -> DataFrame:
    """F1 (plan rows) UNION ALL F2 (assessment rows) for rows changed in [start, end). Members and a center's days are
    broadcast where a count proves them few, as in lookups; only a child's days, assignments and sessions meet the rows in a shuffle."""
    cols = lambda df: [c for c in CHANGE_COLS if c in df.columns]
    dta_all = latest(stg["daily_task_assignments"])
    dta = change_window(dta_all, start, end, cols(dta_all))
    sides = sides or _lookup_sides(stg, dims)
    users, dd = checked_broadcast(sides["users"]), sides["days"]
    child = checked_broadcast(dims["dim_child"].filter(F.col("child_key") != -1).select(
        "child_id", "child_key", F.col("center_id").alias("_child_center")), bound_by=dims["dim_child"])
    cds, cen = day_statuses or _day_statuses(stg)
    few_cen = bounded_count(cen, DIM_BROADCAST_MAX_ROWS) <= DIM_BROADCAST_MAX_ROWS

    def center_days(center: str) -> DataFrame:
        days = cen.withColumnRenamed("center_id", center)
        return F.broadcast(days) if few_cen else days

    # ---- plan branch
    p = dta.join(child, "child_id", "left")
    p = lookup_key(p, dd, {"date": "FullDateAlternateKey"}, "TimeKey", "date_key", pick="min")
    p = _current(p, dims["dim_center"], "_child_center", "center_id", "center_key", "center_key")
    p = p.join(users, F.col("planned_by") == F.col("_uid"), "left")                    # J8 step 1
    p = _current(p, dims["dim_teacher"], "_planner_teacher", "teacher_id", "teacher_key", "teacher_key")
    p = lookup_key(p, dims["dim_domain"], {"domain_id": "domain_id"}, "domain_key")
    p = _task_key(p, sides)
    p = lookup_key(p, dims["dim_score_scale"], {"score_scale_id": "score_scale_id"}, "score_scale_key")
    p = p.join(cds, ["child_id", "date"], "left")
    p = p.join(center_days("_child_center"), ["_child_center", "date"], "left")
    st = norm_lower("status")
    plan_rows = p.select(
        "date_key", F.coalesce("child_key", F.lit(-1)).alias("child_key"), "center_key", "teacher_key", "domain_key",
        "task_key", "score_scale_key", F.lit(-1).alias("assessment_status_key"), F.lit(-1).alias("no_score_reason_key"),
        F.lit(None).cast("int").alias("attempt_no"), F.lit(None).cast("decimal(10,2)").alias("raw_score"),
        F.lit(None).cast("decimal(10,4)").alias("normalized_score"),
        (st == "completed").cast("int").alias("is_completed"), F.lit(1).alias("is_planned"),
        F.lit(0).alias("is_scored"), F.lit(0).alias("is_not_scored"), (st == "cancelled").cast("int").alias("is_cancelled"),
        (st == "incomplete").cast("int").alias("is_incomplete"), F.lit(0).alias("is_refused"),
        F.coalesce(norm_lower("_child_day") == "absent", F.lit(False)).cast("int").alias("is_absent"),
        F.coalesce(norm_lower("_center_day") == "closed", F.lit(False)).cast("int").alias("is_center_closed"),
        F.lit(0).alias("is_assessed"), F.col("id").alias("source_daily_task_assignment_id"),
        F.lit(None).cast("int").alias("source_task_assessment_id"),
        F.lit(None).cast("int").alias("source_assessment_session_id"),
        F.col("child_task_plan_id").alias("source_child_task_plan_id"), "source_system")

    # ---- assessment branch
    ta_all = latest(stg["task_assessments"])
    ta = change_window(ta_all, start, end, cols(ta_all))
    dta_cols = dta_all.select(F.col("id").alias("_dta_id"), F.col("child_task_plan_id").alias("_plan_id"),
                              F.col("task_template_id"), F.col("domain_id"), F.col("task_title"),
                              F.col("score_scale_id"))
    sess = latest(stg["assessment_sessions"]).select(F.col("id").alias("_sess_id"), F.col("center_id").alias("_sess_center"))
    scales = latest(stg["score_scales"]).select(F.col("id").alias("_ss_id"), F.col("max_score").alias("_max"))
    a = ta.join(dta_cols, F.col("daily_task_assignment_id") == F.col("_dta_id"), "left") \
          .join(sess, F.col("assessment_session_id") == F.col("_sess_id"), "left") \
          .join(child, "child_id", "left") \
          .withColumn("_center_id", F.coalesce("_sess_center", "_child_center"))          # J9
    a = lookup_key(a, dd, {"date": "FullDateAlternateKey"}, "TimeKey", "date_key", pick="min")
    a = _current(a, dims["dim_center"], "_center_id", "center_id", "center_key", "center_key")
    a = _current(a, dims["dim_teacher"], "teacher_id", "teacher_id", "teacher_key", "teacher_key")
    a = lookup_key(a, dims["dim_domain"], {"domain_id": "domain_id"}, "domain_key")
    a = _task_key(a, sides)
    a = lookup_key(a, dims["dim_score_scale"], {"score_scale_id": "score_scale_id"}, "score_scale_key")
    a = a.join(scales, F.col("score_scale_id") == F.col("_ss_id"), "left")
    a = lookup_key(a, dims["dim_assessment_status"], [(norm_lower("assessment_status"), "assessment_status_code")],
                   "assessment_status_key")
    a = lookup_key(a, dims["dim_no_score_reason"], {"no_score_reason_id": "no_score_reason_id"}, "no_score_reason_key")
    a = a.join(cds, ["child_id", "date"], "left")
    a = a.join(center_days("_center_id"), ["_center_id", "date"], "left")
    s = norm_lower("assessment_status")
    norm = (F.when(F.col("score").isNull(), F.lit(None))
             .when(F.col("normalized_score").isNotNull(), F.col("normalized_score"))
             .when(F.col("_max").isNull() | (F.col("_max") == 0), F.lit(None))
             .otherwise(F.col("score") / F.col("_max") * 100)).cast("decimal(10,4)")
    assess_rows = a.select(
        "date_key", F.coalesce("child_key", F.lit(-1)).alias("child_key"), "center_key", "teacher_key", "domain_key",
        "task_key", "score_scale_key", "assessment_status_key", "no_score_reason_key", "attempt_no",
        F.col("score").alias("raw_score"), norm.alias("normalized_score"),
        s.isin(*SUCCESS_CODES).cast("int").alias("is_completed"), F.lit(1).alias("is_planned"),
        (F.col("score").isNotNull() | (s == "scored")).cast("int").alias("is_scored"),
        (s == "not_scored").cast("int").alias("is_not_scored"), (s == "cancelled").cast("int").alias("is_cancelled"),
        (s == "incomplete").cast("int").alias("is_incomplete"), (s == "refused").cast("int").alias("is_refused"),
        F.coalesce(norm_lower("_child_day") == "absent", F.lit(False)).cast("int").alias("is_absent"),
        F.coalesce(norm_lower("_center_day") == "closed", F.lit(False)).cast("int").alias("is_center_closed"),
        F.lit(1).alias("is_assessed"), F.col("daily_task_assignment_id").alias("source_daily_task_assignment_id"),
        F.col("id").alias("source_task_assessment_id"),
        F.col("assessment_session_id").alias("source_assessment_session_id"),
        F.col("_plan_id").alias("source_child_task_plan_id"), "source_system")
    types = {f.name: f.dataType for f in assess_rows.schema.fields}
    return plan_rows.select(*[F.col(c).cast(types[c]).alias(c) for c in FACT_COLUMNS]).unionByName(
        assess_rows.select(*FACT_COLUMNS))


def fact_tran_student_task_progress(stg, dims, start, end, existing, batch_id, load_ts):
    """append candidates whose (assignment, assessment) key is new (null-safe, K4)."""
    cand = progress_candidates(stg, dims, start, end).withColumns(
        {"etl_batch_id": F.lit(batch_id), "loaded_at": ts_lit(load_ts)})
    return _unseen_progress(cand, existing)


def written_progress(stg, dims, start, end, existing, batch_id, load_ts) -> DataFrame:
    """The rows that F3 appends, as a work table. Both kinds of rows belong to an assignment: they are made and written by ranges of its id,
    so that the disk holds the shuffles of one range, and in its order, in which ids take little room."""
    assigned, plan = stg["daily_task_assignments"], "source_daily_task_assignment_id"
    days, sides = tuple(cut_lineage(d) for d in _day_statuses(stg)), _lookup_sides(stg, dims)

    def part(within):
        assessed = within.of(stg["task_assessments"], "daily_task_assignment_id")
        # Of the sessions only ids between the range's least and greatest can meet its rows.
        least, greatest = assessed.agg(F.min("assessment_session_id"), F.max("assessment_session_id")).first()
        some = dict(stg, daily_task_assignments=within.of(assigned, "id"), task_assessments=assessed,
                    assessment_sessions=stg["assessment_sessions"].filter(F.col("id").between(least, greatest)))
        cand = progress_candidates(some, dims, start, end, days, sides).withColumns({"etl_batch_id": F.lit(batch_id), "loaded_at": ts_lit(load_ts)})
        return _unseen_progress(cand, None if existing is None else within.of(existing, plan)).sortWithinPartitions(plan)
    out = cut_in_parts(part(r) for r in key_ranges(assigned, "id", assigned.count()))
    for d in days:
        discard(d)
    return out


def _unseen_progress(cand: DataFrame, existing: DataFrame | None) -> DataFrame:
    if existing is None:
        return cand
    return append_new(cand, existing, ["source_daily_task_assignment_id", "source_task_assessment_id"], null_safe=True)


def fact_child_task_event(progress, status_dim, existing, batch_id, load_ts):
    """one event per progress row, status from the assessment code else a flag priority chain."""
    codes = status_dim.select("assessment_status_key", F.col("assessment_status_code").alias("_code"))
    p = progress.filter(F.col("source_daily_task_assignment_id").isNotNull() |
                        F.col("source_task_assessment_id").isNotNull()).join(codes, "assessment_status_key", "left")
    f = lambda c: F.col(c) == 1
    assessed = F.col("source_task_assessment_id").isNotNull()
    status = (F.when(assessed & F.col("_code").isNotNull(), F.col("_code"))
               .when(f("is_cancelled"), "CANCELLED").when(f("is_absent"), "ABSENT").when(f("is_refused"), "REFUSED")
               .when(f("is_incomplete"), "INCOMPLETE").when(f("is_completed"), "COMPLETED")
               .when(f("is_scored"), "SCORED").when(f("is_not_scored"), "NOT_SCORED")
               .when(f("is_assessed"), "ASSESSED").when(f("is_planned"), "PLANNED").otherwise("UNKNOWN"))
    ev = p.select("child_key", "task_key", "teacher_key", "center_key", "domain_key", "date_key",
                  F.when(assessed, "ASSESSMENT").otherwise("PLAN").alias("event_type"), status.alias("event_status"),
                  "raw_score", "normalized_score", "source_daily_task_assignment_id", "source_task_assessment_id",
                  "source_assessment_session_id", "source_system",
                  F.lit(batch_id).alias("etl_batch_id"), ts_lit(load_ts).alias("loaded_at"))
    if existing is None:
        return ev
    return append_new(ev, existing, ["event_type", "source_daily_task_assignment_id", "source_task_assessment_id"],
                      null_safe=True)


_GRAIN = ("child_key", "center_key", "teacher_key")


def _daily_measures() -> Measures:
    scored = F.col("is_scored") == 1
    aid = "source_daily_task_assignment_id"
    return Measures(
        _GRAIN, "day",
        distinct={"planned_task_count": (aid, None), "assessment_count": ("source_task_assessment_id", None),
                  "completed_task_count": (aid, F.col("is_completed") == 1),
                  "scored_task_count": (aid, scored), "not_scored_task_count": (aid, F.col("is_not_scored") == 1)},
        sums={"raw": ("raw_score", scored), "norm": ("normalized_score", scored)},
        mins={"min_score": ("_min", scored)}, maxs={"max_score": ("_max", scored)})


def _days(dims) -> DataFrame:
    return dims["dim_date"].filter(F.col("TimeKey") != -1).select("TimeKey", "FullDateAlternateKey")


def _dated_progress(progress: DataFrame, dims) -> DataFrame:
    """Progress rows with their day (null if unknown), whole group keys and the bounds of their score scale."""
    scales = dims["dim_score_scale"].select("score_scale_key", F.col("min_score").alias("_min"), F.col("max_score").alias("_max"))
    day = F.when(F.coalesce(F.col("date_key"), F.lit(-1)) == -1, F.lit(None).cast("date")).otherwise(F.col("FullDateAlternateKey"))
    # A date_key that the calendar lacks has no day, so its rows are in no snapshot, unlike undated ones.
    return (progress.join(_days(dims), F.col("date_key") == F.col("TimeKey"), "left")
            .where(F.col("TimeKey").isNotNull() | (F.coalesce(F.col("date_key"), F.lit(-1)) == -1))
            .join(scales, "score_scale_key", "left").withColumn("day", day)
            .withColumns({c: F.coalesce(c, F.lit(-1)) for c in _GRAIN}))


@dataclass
class DailyState:
    """F5 between runs: spans by all facts, the first-seen index, what is published, and the runs that published it."""

    spans: DataFrame | None = None
    firsts: DataFrame | None = None
    published: DataFrame | None = None
    runs: list[Run] = field(default_factory=list)
    loaded: dict[int, _dt.datetime] = field(default_factory=dict)

    #: Names of the tables that hold a state.
    TABLES = ("daily_spans", "daily_first_seen", "daily_published", "daily_runs")

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        runs = [(r.batch, r.first, r.last, self.loaded.get(r.batch)) for r in self.runs]
        frames = (self.spans, self.firsts, self.published,
                  spark.createDataFrame(runs, "batch int, first date, last date, loaded_at timestamp_ntz"))
        return {name: df for name, df in zip(self.TABLES, frames, strict=True) if df is not None}

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> DailyState:
        """The state in ``tables`` (empty if they hold none); a run is one row, so their list is collected."""
        if tables.get("daily_runs") is None:
            return cls()
        runs = sorted(tables["daily_runs"].collect(), key=lambda r: r.batch)
        return cls(*(tables.get(n) for n in cls.TABLES[:3]), [Run(r.batch, r.first, r.last) for r in runs], {r.batch: r.loaded_at for r in runs})


def roll_daily_snapshot(progress: DataFrame, dims, start, end, state: DailyState | None, batch_id: int, load_ts,
                        undated_first: _dt.date | None = None) -> DailyState:
    """fold the progress rows of batches after the last run's into the state, then publish the days from the earliest one affected by
    the fact's last batch (or start) to the day before end. ``undated_first`` is the day that undated rows of that batch
    affect first; by default none. Only new rows and the groups they touch are read and rewritten."""
    state = state if state is not None else DailyState()
    start_d = start.date() if isinstance(start, _dt.datetime) else start
    end_d = end.date() if isinstance(end, _dt.datetime) else end
    last_batch = progress.agg(F.max("etl_batch_id")).first()[0]
    measures, touched = _daily_measures(), None
    spans, firsts = state.spans, state.firsts
    folded = max((r.batch for r in state.runs), default=None)
    new = progress if folded is None else progress.filter(F.col("etl_batch_id") > folded)
    if folded is None or (last_batch is not None and last_batch > folded):
        spans, firsts, touched = fold(measures, spans, firsts, _dated_progress(new, dims))
    affected = progress.filter(F.col("etl_batch_id") == last_batch).join(_days(dims), F.col("date_key") == F.col("TimeKey"), "left") \
        .agg(F.min("FullDateAlternateKey"), F.count_if(F.coalesce(F.col("date_key"), F.lit(-1)) == -1)).first()
    days = [d for d in (affected[0], undated_first if affected[1] else None) if d is not None]
    run = Run(batch_id, min([start_d, *days]), end_d - _dt.timedelta(days=1))
    published, runs = publish(measures, spans, touched, state.published, state.runs, run)
    return DailyState(spans, firsts, published, runs, {**state.loaded, batch_id: load_ts})


def _daily_columns(rows: DataFrame) -> list[Column]:
    return [exact_avg(F.col("raw_sum"), F.col("raw_n"), 2, 10).alias("raw_score"),
            F.col("min_score").cast("decimal(10,2)").alias("min_score"), F.col("max_score").cast("decimal(10,2)").alias("max_score"),
            exact_avg(F.col("norm_sum"), F.col("norm_n"), 4, 10).alias("normalized_score"),
            *[F.col(c).cast("int").alias(c) for c in _daily_measures().distinct]]


def _as_daily_rows(rows: DataFrame, dims, loaded: dict[int, _dt.datetime]) -> DataFrame:
    rows = lookup_key(rows, _days(dims), {"snapshot_date": "FullDateAlternateKey"}, "TimeKey", "date_key", pick="min")
    loaded_at = F.lit(None).cast("timestamp_ntz")
    for batch, ts in loaded.items():
        loaded_at = F.when(F.col("batch") == batch, ts_lit(ts)).otherwise(loaded_at)
    return rows.select("date_key", *_GRAIN, *_daily_columns(rows), F.lit("PROGRAM_OPS").alias("source_system"),
                       F.col("batch").alias("etl_batch_id"), loaded_at.alias("loaded_at"))


def daily_snapshot_rows(state: DailyState, dims, first: _dt.date | None = None, last: _dt.date | None = None) -> DataFrame:
    """The daily snapshot's rows of the published days in [first, last], made when they are read."""
    return _as_daily_rows(expand(state.published, state.runs, first, last), dims, state.loaded)


def last_daily_rows(state: DailyState, dims, start: _dt.date, end: _dt.date) -> DataFrame:
    """Each group's last published row in [start, end), as far as the calendar goes."""
    lo, hi = _days(dims).agg(F.min("FullDateAlternateKey"), F.max("FullDateAlternateKey")).first()
    start, end = (d.date() if isinstance(d, _dt.datetime) else d for d in (start, end))
    rows = last_days(_daily_measures(), state.published, state.runs, max(start, lo), min(end - _dt.timedelta(days=1), hi))
    return _as_daily_rows(rows, dims, state.loaded)


def fact_child_snapshot_accumulation(daily, progress, start, end, old, batch_id, load_ts):
    """counts of the latest daily row in the window + first/last plan and assessment keys (A8),
    merged over the previous accumulation (K11)."""
    g = ["child_key", "center_key", "teacher_key"]
    s_key, e_key = int(start.strftime("%Y%m%d")), int(end.strftime("%Y%m%d"))
    period = daily.filter((F.col("date_key") >= s_key) & (F.col("date_key") < e_key)).withColumns(
        {c: F.coalesce(c, F.lit(-1)) for c in g})
    latest_rows = latest_row_per_group(
        period.select(*g, "date_key", "planned_task_count", "assessment_count", "completed_task_count",
                      "scored_task_count"), g, "date_key").withColumnRenamed("date_key", "snapshot_date_key")
    tx = first_last_keys(progress.withColumns({c: F.coalesce(c, F.lit(-1)) for c in g}), g, "date_key",
                         {"plan": "source_daily_task_assignment_id", "assessment": "source_task_assessment_id"})
    recomputed = latest_rows.join(tx, g).withColumns(
        {"source_system": F.lit("PROGRAM_OPS"), "etl_batch_id": F.lit(batch_id),
         "loaded_at": ts_lit(load_ts)})
    if old is None:
        return recomputed
    return replace_touched(old, recomputed, g)


def written_accumulation(daily, progress, start, end, old, batch_id, load_ts) -> DataFrame:
    """The accumulation that F6 leaves, as a work table. A group is one child's: the recomputed groups are written by ranges of the
    children, then the old rows that they do not replace, so that each is worked out once and the disk holds the shuffles of one range."""
    child = F.coalesce("child_key", F.lit(-1))
    progress, daily = (df.withColumn("child_key", child) for df in (progress, daily))
    ranges = key_ranges(progress, "child_key", progress.count())
    recomputed = cut_in_parts(fact_child_snapshot_accumulation(r.of(daily, "child_key"), r.of(progress, "child_key"), start, end, None,
                                                               batch_id, load_ts) for r in ranges)
    if old is None:
        return recomputed
    kept = cut_in_parts(untouched(r.of(old, "child_key"), r.of(recomputed, "child_key"), list(_GRAIN)) for r in ranges)
    return holding(recomputed.unionByName(kept), recomputed, kept)


# --------------------------------------------------------------------------------- runner
def build_dims(builders: dict) -> dict:
    """Materialise independent dimension builders concurrently: name -> (frame, row count)."""
    def one(build):
        def run():
            made = build()
            df = cut_lineage(made)
            discard(made)
            return df, df.count()
        return run
    return run_concurrently({name: one(b) for name, b in builders.items()})


def run_mart1(spark: SparkSession, staging: dict, dw: dict, start: _dt.datetime, end: _dt.datetime,
              load_ts: _dt.datetime | None = None, batch_id: int = 1, first_load: bool = False,
              log: BatchLog | None = None) -> dict:
    """One Mart 1 run; order matters (teacher reads center, task reads domain, facts read dims,
    events/snapshots read the transaction fact, accumulation reads the daily snapshot).

    Each step runs under ``run_logged``: a failing step leaves a failed step and batch in ``log`` (pass one to
    read it after an exception) and the exception goes on. Steps count the rows they add, not the table's."""
    require_params(start_time=start, end_time=end)
    if "dim_date" not in dw:
        raise RuntimeError("prerequisite table dim_date is missing")
    load_ts = load_ts or end
    prev = {} if first_load else dw
    log = log or BatchLog(spark, "PROGRAM_OPS", "DW", "MART1", load_ts, batch_id)
    out = {}

    # Dimensions in two waves: independent ones side by side, then the two that read a
    # dimension of the first wave (teacher <- center, task <- domain).
    wave1 = run_logged(log, "dimensions", build_dims, {
        "dim_center": lambda: dim_center(staging, prev.get("dim_center"), start, end, first_load),
        "dim_domain": lambda: dim_domain(staging, prev.get("dim_domain")),
        "dim_score_scale": lambda: dim_score_scale(staging, prev.get("dim_score_scale")),
        "dim_no_score_reason": lambda: dim_no_score_reason(staging, prev.get("dim_no_score_reason")),
        "dim_assessment_status": lambda: dim_assessment_status(staging, prev.get("dim_assessment_status")),
        "dim_child": lambda: dim_child(staging, prev.get("dim_child"))})
    for name, (df, n) in wave1.items():
        out[name] = df
        log.step("staging", name, n, n)
    wave2 = run_logged(log, "dimensions", build_dims, {
        "dim_teacher": lambda: dim_teacher(staging, prev.get("dim_teacher"), out["dim_center"], start, end,
                                           first_load),
        "dim_task": lambda: dim_task(staging, prev.get("dim_task"), out["dim_domain"])})
    for name, (df, n) in wave2.items():
        out[name] = df
        log.step("staging", name, n, n)
    dims = dict(out, dim_date=dw["dim_date"])

    def add(name, build):
        """Append a fact's new rows: materialise them once, count them, log them."""
        new = run_logged(log, name, lambda: build(prev.get(name)))
        n = new.count()
        log.step("dw", name, n, n)
        out[name] = new if prev.get(name) is None else prev[name].unionByName(new)
        return out[name]

    progress = add("fact_tran_student_task_progress",
                   lambda old: written_progress(staging, dims, start, end, old, batch_id, load_ts))
    add("fact_child_task_event",
        lambda old: cut_lineage(fact_child_task_event(progress, out["dim_assessment_status"], old, batch_id, load_ts)))
    name = "fact_daily_student_task_progress"
    state = run_logged(log, name, lambda: roll_daily_snapshot(progress, dims, start, end, DailyState.of(prev), batch_id, load_ts))
    out.update(state.tables(spark))
    n = state.published.filter(F.col("since") == batch_id).count()
    log.step("dw", name, n, n)      # spans, not days
    out[name] = daily_snapshot_rows(state, dims)
    name = "fact_child_snapshot_accumulation"
    out[name] = run_logged(log, name, lambda: written_accumulation(
        last_daily_rows(state, dims, start, end), progress, start, end, prev.get(name), batch_id, load_ts))
    n = out[name].filter(F.col("etl_batch_id") == batch_id).count()
    log.step("dw", name, n, n)
    log.finish("succeeded")
    out["etl_batch"], out["etl_load_log"] = log.frames()
    return out
