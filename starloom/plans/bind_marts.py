"""The real staging + Mart 2 jobs on whole driver tables (see ``driver_sources`` for the mapping)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.dim_date import build_dim_date
from starloom.plans.driver_sources import (
    LINE_ID_SQL, TEMPLATE_MAX_SIZE, finance_sources, forget_lines, program_sources, program_task_sources,
)
from starloom.plans.mart1 import dim_center, dim_child
from starloom.plans.mart2 import run_mart2
from starloom.operators.lookups import checked_broadcast
from starloom.plans.registry import register
from starloom.plans.staging import run_staging
from starloom.session import discard
from starloom.sources.tables import load

RUN_START, RUN_END, TO_DATE = _dt.datetime(1995, 1, 1), _dt.datetime(2002, 1, 1), _dt.datetime(2030, 1, 1)
_RUNS: dict = {}


def _spent(staged: dict[str, DataFrame]) -> None:
    """Staged tables are read by the mart run only: once it, or the next staging run, has written what it makes of them, they go."""
    for df in staged.values():
        discard(df)


def finance_run(spark: SparkSession, sf_dir: str) -> dict:
    """Stage both systems up to TO_DATE, build the shared dimensions, first-load Mart 2 over
    [RUN_START, RUN_END). Memoised per (application, folder): the outputs are checkpointed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _RUNS:
        return _RUNS[key]
    prog, _ = run_staging(spark, "program_ops", program_sources(spark, sf_dir), {}, TO_DATE, batch_id=1,
                          specs=("centers", "children"))
    fin, log = run_staging(spark, "finance_ops", finance_sources(spark, sf_dir), {}, TO_DATE, batch_id=1)
    forget_lines(spark, sf_dir, "finance_lines")
    o = load(spark, sf_dir, "orders")
    # The calendar covers whole years around the order dates (two scalars).
    lo, hi = o.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    bounds = spark.range(1).select(F.lit(_dt.date(lo, 1, 1)).alias("lo"), F.lit(_dt.date(hi, 12, 31)).alias("hi"))
    dw = {"dim_date": build_dim_date(bounds), "dim_center": dim_center(prog, None, RUN_START, RUN_END, True),
          "dim_child": dim_child(prog, None)}
    discard(fin["financial_transactions"])      # no mart reads them
    out = run_mart2(spark, fin, dw, RUN_START, RUN_END, batch_id=1, first_load=True, spent=lambda name: discard(fin[name]))
    _spent(fin)
    out.update(dw)
    out["staging_log"] = log
    _RUNS[key] = out
    return out


MART_SNAPSHOT_SQL = """
WITH don AS (SELECT o_orderkey AS id, o_custkey AS donor_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS campaign_id,
                    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS d,
                    CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'rejected' ELSE 'pending' END AS status
             FROM orders WHERE o_totalprice > 0),
lines AS (SELECT l.*, s.s_nationkey AS center_id, CAST(l.l_shipdate AS DATE) AS d,
                 CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS exp_amt,
                 CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS pay_amt
          FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey),
alloc AS (SELECT center_id, d, l_returnflag, l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt FROM lines
          WHERE l_returnflag IN ('N', 'A') AND center_id IS NOT NULL AND l_extendedprice > 0
            AND (l_returnflag = 'A' OR l_orderkey IN (SELECT id FROM don))),
months AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS m),
centers AS (SELECT n_nationkey AS center_id FROM nation UNION ALL SELECT -1),
a1 AS (SELECT a.center_id, date_trunc('month', a.d) AS m,
              sum(CASE WHEN a.l_returnflag = 'N' AND cd.id IS NOT NULL THEN a.amt END) AS don_amt,
              count(DISTINCT CASE WHEN a.l_returnflag = 'N' AND cd.id IS NOT NULL THEN a.l_orderkey END) AS don_n,
              count(*) AS alloc_n
       FROM alloc a LEFT JOIN (SELECT id, d FROM don WHERE status = 'confirmed') cd
         ON cd.id = a.l_orderkey AND {phase_filter}
       GROUP BY 1, 2),
e1 AS (SELECT center_id, date_trunc('month', d) AS m, sum(exp_amt) AS exp_amt, count(*) AS exp_n FROM lines
       WHERE l_returnflag = 'A' AND exp_amt > 0 AND d >= DATE '1995-01-01' AND d < DATE '2002-01-01' GROUP BY 1, 2),
p1 AS (SELECT center_id, date_trunc('month', d) AS m, sum(pay_amt) AS pay_amt, count(*) AS pay_n FROM lines
       WHERE l_linestatus = 'F' AND pay_amt > 0 AND d >= DATE '1995-01-01' AND d < DATE '2002-01-01' GROUP BY 1, 2)
SELECT CAST(year(last_day(months.m)) * 10000 + month(months.m) * 100 + day(last_day(months.m)) AS INTEGER) AS month_key,
  centers.center_id,
  CAST(coalesce(a1.don_amt, 0) AS DECIMAL(18,2)) AS total_donation_amount,
  CAST(coalesce(e1.exp_amt, 0) AS DECIMAL(18,2)) AS total_expense_amount,
  CAST(coalesce(p1.pay_amt, 0) AS DECIMAL(18,2)) AS total_payment_amount,
  CAST(coalesce(a1.don_amt, 0) - coalesce(e1.exp_amt, 0) - coalesce(p1.pay_amt, 0) AS DECIMAL(18,2)) AS net_balance,
  CAST(coalesce(a1.don_n, 0) AS INTEGER) AS donation_count, CAST(coalesce(e1.exp_n, 0) AS INTEGER) AS expense_count,
  CAST(coalesce(p1.pay_n, 0) AS INTEGER) AS payment_count, CAST(coalesce(a1.alloc_n, 0) AS INTEGER) AS allocation_count
FROM months CROSS JOIN centers
LEFT JOIN a1 ON a1.center_id = centers.center_id AND a1.m = months.m
LEFT JOIN e1 ON e1.center_id = centers.center_id AND e1.m = months.m
LEFT JOIN p1 ON p1.center_id = centers.center_id AND p1.m = months.m
"""


@register("finance_mart_snapshot", ("F11", "D15", "K9", "staging"),
          MART_SNAPSHOT_SQL.replace("{phase_filter}", "TRUE"))
def finance_mart_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    centers = out["dim_center"].select("center_key", "center_id")
    snap = out["fact_monthly_financial_snapshot"].join(checked_broadcast(centers), "center_key")  # dimension rows: nations
    return snap.select("month_key", "center_id", "total_donation_amount", "total_expense_amount",
                       "total_payment_amount", "net_balance", "donation_count", "expense_count", "payment_count",
                       "allocation_count")


MART_LIFECYCLE_SQL = """
WITH don AS (SELECT o_orderkey AS id, o_custkey AS donor_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS campaign_id,
                    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS d,
                    CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'rejected' ELSE 'pending' END AS status
             FROM orders WHERE o_totalprice > 0 AND o_orderdate < TIMESTAMP '2002-01-01'),
alloc AS (SELECT l_orderkey AS donation_id,
                 min(CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER)) AS k
          FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
          WHERE l_returnflag = 'N' AND l_extendedprice > 0 GROUP BY 1),
base AS (SELECT don.*, alloc.k AS allocated_key,
                CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS created_key,
                CASE WHEN status = 'rejected' THEN 'rejected' WHEN alloc.k IS NOT NULL THEN 'allocated' ELSE 'confirmed' END AS stage
         FROM don LEFT JOIN alloc ON alloc.donation_id = don.id WHERE status IN ('confirmed', 'rejected'))
SELECT donor_id, campaign_id, stage AS current_stage,
  CAST(min(created_key) AS INTEGER) AS created_date_key,
  CAST(coalesce(min(CASE WHEN status = 'confirmed' THEN created_key END), -1) AS INTEGER) AS confirmed_date_key,
  CAST(coalesce(min(allocated_key), -1) AS INTEGER) AS allocated_date_key,
  CAST(sum(amount) AS DECIMAL(18,2)) AS donation_amount, min(amount) AS min_donation, max(amount) AS max_donation,
  CAST(CAST((2 * CAST(sum(amount) * 100 AS HUGEINT) + count(*)) // (2 * count(*)) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS avg_donation
FROM base GROUP BY donor_id, campaign_id, stage
"""


@register("finance_mart_lifecycle", ("F12", "A7", "A9"), MART_LIFECYCLE_SQL)
def finance_mart_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    donors = out["dim_donor"].select("donor_key", "donor_id")
    camps = out["dim_campaign"].select("campaign_key", "campaign_id")
    life = out["fact_donation_lifecycle"].join(donors, "donor_key", "left").join(checked_broadcast(camps), "campaign_key", "left")
    return life.select("donor_id", "campaign_id", "current_stage", "created_date_key", "confirmed_date_key",
                       "allocated_date_key", "donation_amount", "min_donation", "max_donation", "avg_donation")


# ---------------------------------------------------------------- Mart 1 on the driver tables
PROGRAM_SPECS = ("centers", "children", "teachers", "users", "domains", "score_scales", "task_templates",
                 "no_score_reasons", "center_daily_status", "child_daily_status", "child_task_plans",
                 "daily_task_assignments", "assessment_sessions", "task_assessments")


def program_run(spark: SparkSession, sf_dir: str) -> dict:
    """Stage the program tables mapped from the driver's tables, build D1-D8 (first load) and
    the task-progress (F1-F3) and event (F4) facts for [RUN_START, RUN_END). Memoised."""
    key = ("program", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _RUNS:
        return _RUNS[key]
    from starloom.plans import mart1, schemas
    sources = program_task_sources(spark, sf_dir)
    for t in schemas.PROGRAM_OPS:            # parents of referential checks may be empty
        sources.setdefault(t, schemas.empty(spark, t))
    stg, _ = run_staging(spark, "program_ops", sources, {}, TO_DATE, batch_id=1, specs=PROGRAM_SPECS)
    forget_lines(spark, sf_dir, "program_lines")
    o = load(spark, sf_dir, "orders")
    lo, hi = o.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    bounds = spark.range(1).select(F.lit(_dt.date(lo, 1, 1)).alias("lo"), F.lit(_dt.date(hi, 12, 31)).alias("hi"))
    wave1 = mart1.build_dims({
        "dim_date": lambda: build_dim_date(bounds),
        "dim_center": lambda: mart1.dim_center(stg, None, RUN_START, RUN_END, first_load=True),
        "dim_domain": lambda: mart1.dim_domain(stg, None),
        "dim_score_scale": lambda: mart1.dim_score_scale(stg, None),
        "dim_no_score_reason": lambda: mart1.dim_no_score_reason(stg, None),
        "dim_assessment_status": lambda: mart1.dim_assessment_status(stg, None),
        "dim_child": lambda: mart1.dim_child(stg, None)})
    dims = {name: df for name, (df, _) in wave1.items()}
    wave2 = mart1.build_dims({
        "dim_teacher": lambda: mart1.dim_teacher(stg, None, dims["dim_center"], RUN_START, RUN_END, True),
        "dim_task": lambda: mart1.dim_task(stg, None, dims["dim_domain"])})
    dims.update({name: df for name, (df, _) in wave2.items()})
    progress = mart1.written_progress(stg, dims, RUN_START, RUN_END, None, 1, RUN_END)
    _spent(stg)
    events = mart1.fact_child_task_event(progress, dims["dim_assessment_status"], None, 1, RUN_END)
    out = dict(dims, fact_tran_student_task_progress=progress, fact_child_task_event=events)
    _RUNS[key] = out
    return out


def _natural_ids(df: DataFrame, out: dict) -> DataFrame:
    """Replace surrogate keys by the natural ids of their dimension rows (for comparison)."""
    pairs = [("child_key", "dim_child", "child_id"), ("center_key", "dim_center", "center_id"),
             ("teacher_key", "dim_teacher", "teacher_id"), ("domain_key", "dim_domain", "domain_id"),
             ("task_key", "dim_task", "natural_task_code")]
    for key, dim, nat in pairs:
        if key not in df.columns:
            continue
        d = checked_broadcast(out[dim].select(F.col(key).alias(f"_{key}"), F.col(nat)))
        df = df.join(d, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
    return df


PROGRESS_MART_SQL = f"""
WITH li AS (SELECT l.*, {LINE_ID_SQL} AS line_id FROM lineitem l),
closed AS (SELECT c.c_nationkey AS center_id, CAST(o.o_orderdate AS DATE) AS d, arg_max(o.o_orderkey % 2 = 0, o.o_orderkey) AS is_closed
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus = 'P' GROUP BY 1, 2),
x AS (SELECT li.*, o.o_custkey, c.c_nationkey, p.p_size, s.s_nationkey,
             CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS date_key,
             EXISTS (SELECT 1 FROM orders po WHERE po.o_orderstatus = 'P' AND po.o_custkey = o.o_custkey
                     AND CAST(po.o_orderdate AS DATE) = CAST(li.l_shipdate AS DATE)) AS absent,
             coalesce(cc.is_closed, false) AS child_center_closed, coalesce(sc.is_closed, false) AS session_center_closed,
             CASE WHEN p.p_size <= {TEMPLATE_MAX_SIZE} THEN 'TEMPLATE:' || CAST(li.l_partkey AS VARCHAR)
                  ELSE 'CUSTOM:' || CAST(p.p_size % 5 AS VARCHAR) || ':' || lower(trim(p.p_name)) END AS task_code,
             CASE WHEN p.p_size > {TEMPLATE_MAX_SIZE} THEN li.line_id END AS plan_id,
             CASE WHEN l_returnflag = 'A' THEN 'scored' WHEN l_linenumber % 2 = 0 THEN 'not_scored' ELSE 'refused' END AS assessed_as
      FROM li LEFT JOIN orders o ON o.o_orderkey = li.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
      LEFT JOIN part p ON p.p_partkey = li.l_partkey LEFT JOIN supplier s ON s.s_suppkey = li.l_suppkey
      LEFT JOIN closed cc ON cc.center_id = c.c_nationkey AND cc.d = CAST(li.l_shipdate AS DATE)
      LEFT JOIN closed sc ON sc.center_id = s.s_nationkey AND sc.d = CAST(li.l_shipdate AS DATE)),
progress AS (
  SELECT line_id AS source_daily_task_assignment_id, CAST(NULL AS BIGINT) AS source_task_assessment_id,
         CAST(NULL AS BIGINT) AS source_assessment_session_id, plan_id AS source_child_task_plan_id, date_key,
         o_custkey AS child_id, c_nationkey AS center_id, l_suppkey AS teacher_id, p_size % 5 AS domain_id, 1 AS score_scale_id,
         task_code AS natural_task_code, 'unknown' AS status_code, -1 AS no_score_reason_id, CAST(NULL AS INTEGER) AS attempt_no,
         CAST(NULL AS DECIMAL(10,2)) AS raw_score,
         CAST(NULL AS DECIMAL(10,4)) AS normalized_score, CAST(l_linestatus = 'F' AS INTEGER) AS is_completed,
         1 AS is_planned, 0 AS is_scored, 0 AS is_not_scored, CAST(l_linestatus <> 'F' AND l_linenumber % 4 = 1 AS INTEGER) AS is_cancelled,
         CAST(l_linestatus <> 'F' AND l_linenumber % 4 = 2 AS INTEGER) AS is_incomplete, 0 AS is_refused,
         CAST(absent AS INTEGER) AS is_absent, CAST(child_center_closed AS INTEGER) AS is_center_closed, 0 AS is_assessed
  FROM x
  UNION ALL
  SELECT line_id, line_id, line_id, plan_id, date_key, o_custkey, s_nationkey, l_suppkey, p_size % 5, 1, task_code,
         assessed_as, CASE WHEN assessed_as = 'not_scored' THEN l_suppkey % 5 ELSE -1 END, 1,
         CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(10,2)) END,
         CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_quantity AS DECIMAL(10,2)) * 2 AS DECIMAL(10,4)) END,
         CAST(assessed_as = 'scored' AS INTEGER), 1, CAST(assessed_as = 'scored' AS INTEGER), CAST(assessed_as = 'not_scored' AS INTEGER),
         0, 0, CAST(assessed_as = 'refused' AS INTEGER), CAST(absent AS INTEGER), CAST(session_center_closed AS INTEGER), 1
  FROM x WHERE l_returnflag IN ('A', 'R'))
"""
PROGRESS_COLUMNS = ("source_daily_task_assignment_id", "source_task_assessment_id", "source_assessment_session_id", "source_child_task_plan_id",
                    "date_key", "child_id", "center_id", "teacher_id", "domain_id", "score_scale_id", "natural_task_code", "status_code",
                    "no_score_reason_id", "attempt_no", "raw_score", "normalized_score", "is_completed", "is_planned", "is_scored",
                    "is_not_scored", "is_cancelled", "is_incomplete", "is_refused", "is_absent", "is_center_closed", "is_assessed")
_LONGS = ("source_daily_task_assignment_id", "source_task_assessment_id", "source_assessment_session_id", "source_child_task_plan_id",
          "no_score_reason_id")


@register("program_mart_progress", ("F1", "F2", "F3", "D5", "D8", "J5", "J6", "J7", "J8", "J9", "S12", "staging"),
          PROGRESS_MART_SQL + "SELECT * REPLACE (CAST(no_score_reason_id AS BIGINT) AS no_score_reason_id) FROM progress")
def program_mart_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every measure, flag and source id of the task-progress fact, surrogate keys resolved to natural ids."""
    out = program_run(spark, sf_dir)
    f = _natural_ids(out["fact_tran_student_task_progress"], out)
    for key, dim, nat in (("assessment_status_key", "dim_assessment_status", "assessment_status_code"),
                          ("score_scale_key", "dim_score_scale", "score_scale_id"),
                          ("no_score_reason_key", "dim_no_score_reason", "no_score_reason_id")):
        d = checked_broadcast(out[dim].select(F.col(key).alias("_k"), F.col(nat).alias(f"_{nat}")))
        f = f.join(d, F.col(key) == F.col("_k"), "left").drop("_k").withColumnRenamed(f"_{nat}", nat)
    f = f.withColumnRenamed("assessment_status_code", "status_code")
    return f.select(*[F.col(c).cast("long").alias(c) if c in _LONGS else c for c in PROGRESS_COLUMNS])


@register("program_mart_events", ("F4", "J18", "K4"), PROGRESS_MART_SQL + """
SELECT CASE WHEN source_task_assessment_id IS NOT NULL THEN 'ASSESSMENT' ELSE 'PLAN' END AS event_type,
  CASE WHEN source_task_assessment_id IS NOT NULL AND status_code IS NOT NULL AND status_code <> 'unknown' THEN status_code
       WHEN is_cancelled = 1 THEN 'CANCELLED'
       WHEN is_absent = 1 THEN 'ABSENT' WHEN is_refused = 1 THEN 'REFUSED' WHEN is_incomplete = 1 THEN 'INCOMPLETE'
       WHEN is_completed = 1 THEN 'COMPLETED' WHEN is_scored = 1 THEN 'SCORED' WHEN is_not_scored = 1 THEN 'NOT_SCORED'
       WHEN is_assessed = 1 THEN 'ASSESSED' WHEN is_planned = 1 THEN 'PLANNED'
       ELSE 'UNKNOWN' END AS event_status, raw_score,
  source_daily_task_assignment_id, source_task_assessment_id, date_key, child_id, teacher_id
FROM progress
""")
def program_mart_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = program_run(spark, sf_dir)
    ev = _natural_ids(out["fact_child_task_event"], out)
    return ev.select("event_type", "event_status", "raw_score", "source_daily_task_assignment_id", "source_task_assessment_id",
                     "date_key", "child_id", "teacher_id")


PHASE_SPLIT = _dt.datetime(1998, 1, 1)


def finance_run_incremental(spark: SparkSession, sf_dir: str) -> dict:
    """The same data loaded in two phases: staging up to 1998 + first load of [1995, 1998), then
    staging of everything (hash-diff upserts) + an incremental run over [1998, 2002).
    Memoised per (application, folder)."""
    key = ("finance-2", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _RUNS:
        return _RUNS[key]
    prog, _ = run_staging(spark, "program_ops", program_sources(spark, sf_dir), {}, TO_DATE, batch_id=1,
                          specs=("centers", "children"))
    sources = finance_sources(spark, sf_dir)
    stg1, _ = run_staging(spark, "finance_ops", sources, {}, PHASE_SPLIT, batch_id=1)
    o = load(spark, sf_dir, "orders")
    lo, hi = o.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    bounds = spark.range(1).select(F.lit(_dt.date(lo, 1, 1)).alias("lo"), F.lit(_dt.date(hi, 12, 31)).alias("hi"))
    dw = {"dim_date": build_dim_date(bounds), "dim_center": dim_center(prog, None, RUN_START, RUN_END, True),
          "dim_child": dim_child(prog, None)}
    first = run_mart2(spark, stg1, dw, RUN_START, PHASE_SPLIT, batch_id=1, first_load=True)
    stg2, log2 = run_staging(spark, "finance_ops", sources, stg1, TO_DATE, batch_id=2)
    _spent(stg1)
    forget_lines(spark, sf_dir, "finance_lines")
    second = run_mart2(spark, stg2, dict(dw, **first), PHASE_SPLIT, RUN_END, batch_id=2)
    _spent(stg2)
    second.update(dw)
    second["staging_log"] = log2
    _RUNS[key] = second
    return second


# A month is written once, by the run that covers it (K5). Months before the phase split were
# computed from phase-1 staging, where only donations dated up to the split exist.
@register("finance_mart_incremental", ("K2", "K5", "F11", "V12", "staging"), MART_SNAPSHOT_SQL.replace(
    "{phase_filter}", "(cd.d <= DATE '1998-01-01' OR a.d >= DATE '1998-01-01')"))
def finance_mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-phase load; the final monthly snapshot equals the one-run snapshot (append-only facts,
    K5 appends only the new months)."""
    out = finance_run_incremental(spark, sf_dir)
    centers = checked_broadcast(out["dim_center"].select("center_key", "center_id"))
    snap = out["fact_monthly_financial_snapshot"].join(centers, "center_key")
    return snap.select("month_key", "center_id", "total_donation_amount", "total_expense_amount",
                       "total_payment_amount", "net_balance", "donation_count", "expense_count", "payment_count",
                       "allocation_count")


# ------------------------------------------- Mart 1 in two phases: Type 2 teacher changes at scale
def program_run_two_phase(spark: SparkSession, sf_dir: str) -> dict:
    """The mart job run twice. Phase 1: all teachers active; stage to 1998 and first-load [1995, 1998). Phase 2: suppliers
    with a negative balance become inactive and every other center is renamed (both updated at the split); upsert staging and run
    the incremental load over [1998, 2002): current versions of what changed close and new ones open. ``run_logs`` holds both
    runs' load logs. Memoised."""
    key = ("program-2", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _RUNS:
        return _RUNS[key]
    from starloom.plans import schemas
    from starloom.plans.mart1 import run_mart1
    from starloom.session import cut_lineage

    def sources(change):
        src = program_task_sources(spark, sf_dir, teacher_change=change, center_change=change)
        for t in schemas.PROGRAM_OPS:
            src.setdefault(t, schemas.empty(spark, t))
        return src
    o = load(spark, sf_dir, "orders")
    lo, hi = o.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    bounds = spark.range(1).select(F.lit(_dt.date(lo, 1, 1)).alias("lo"), F.lit(_dt.date(hi, 12, 31)).alias("hi"))
    dw = {"dim_date": cut_lineage(build_dim_date(bounds))}
    stg1, _ = run_staging(spark, "program_ops", sources(None), {}, PHASE_SPLIT, batch_id=1, specs=PROGRAM_SPECS)
    first = run_mart1(spark, stg1, dw, RUN_START, PHASE_SPLIT, batch_id=1, first_load=True)
    stg2, _ = run_staging(spark, "program_ops", sources(PHASE_SPLIT.isoformat(sep=" ")), stg1, TO_DATE, batch_id=2,
                          specs=PROGRAM_SPECS)
    _spent(stg1)
    forget_lines(spark, sf_dir, "program_lines")
    second = run_mart1(spark, stg2, {**dw, **first}, PHASE_SPLIT, RUN_END, batch_id=2)
    _spent(stg2)
    _RUNS[key] = {**dw, **second, "run_logs": first["etl_load_log"].unionByName(second["etl_load_log"])}
    return _RUNS[key]


def _teacher_versions(dim_teacher: DataFrame) -> DataFrame:
    """Version number of each teacher row: its rank among that teacher's keys (keys grow per run)."""
    from pyspark.sql import Window
    w = Window.partitionBy("teacher_id").orderBy("teacher_key")   # a teacher's few versions
    return dim_teacher.filter(F.col("teacher_key") != -1).withColumn("version", F.row_number().over(w))


TEACHER_VERSIONS_SQL = """
WITH t AS (SELECT s_suppkey AS teacher_id, s_acctbal < 0 AS changed FROM supplier)
SELECT teacher_id, 1 AS version, NOT changed AS is_current, 'active' AS employment_status,
       TIMESTAMP '1995-01-01 00:00:00' AS effective_from,
       CASE WHEN changed THEN TIMESTAMP '2002-01-01 00:00:00' END AS effective_to FROM t
UNION ALL
SELECT teacher_id, 2, true, 'inactive', TIMESTAMP '2002-01-01 00:00:00', CAST(NULL AS TIMESTAMP) FROM t WHERE changed
"""


@register("program_scd2_teachers", ("K8", "D2", "K2", "SC5", "Q10"), TEACHER_VERSIONS_SQL)
def program_scd2_teachers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = program_run_two_phase(spark, sf_dir)
    v = _teacher_versions(out["dim_teacher"])
    return v.select(F.col("teacher_id").cast("long").alias("teacher_id"), F.col("version").cast("int").alias("version"),
                    "is_current", "employment_status", "effective_from", "effective_to")


@register("program_scd2_facts", ("J5", "J8", "K4", "F3", "K8"), PROGRESS_MART_SQL + """
SELECT p.source_daily_task_assignment_id, p.source_task_assessment_id, p.teacher_id,
       CAST(CASE WHEN p.date_key >= 19980101 AND s.s_acctbal < 0 THEN 2 ELSE 1 END AS INTEGER) AS teacher_version
FROM progress p JOIN supplier s ON s.s_suppkey = p.teacher_id
WHERE p.date_key >= 19950101 AND p.date_key < 20020101
""")
def program_scd2_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each progress row points at the teacher version current when its phase loaded it."""
    out = program_run_two_phase(spark, sf_dir)
    v = checked_broadcast(_teacher_versions(out["dim_teacher"]).select(
        F.col("teacher_key").alias("_tk"), "teacher_id", "version"))
    f = out["fact_tran_student_task_progress"].join(v, F.col("teacher_key") == F.col("_tk"), "left")
    return f.select("source_daily_task_assignment_id", "source_task_assessment_id",
                    F.col("teacher_id").cast("long").alias("teacher_id"),
                    F.col("version").cast("int").alias("teacher_version"))


def _exact_avg_sql(col: str, scale: int, precision: int = 10) -> str:
    s = f"sum(CASE WHEN is_scored = 1 THEN {col} END)"
    n = f"count(CASE WHEN is_scored = 1 THEN {col} END)"
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST((2 * CAST({s} * {10 ** scale} AS HUGEINT) + {n}) // (2 * {n}) "
            f"AS DECIMAL(24,0)) * {1 / 10 ** scale:.{scale}f} AS DECIMAL({precision},{scale})) END")


#: A group's values as of each day on which it has a fact row, by the definition (every fact dated on or before it); a day between has those of
#: the last such day. ``span_days`` has a row for each day and group then.
DAILY_SQL = PROGRESS_MART_SQL + f""",
changes AS (SELECT DISTINCT child_id, center_id, teacher_id, date_key AS day_key FROM progress WHERE date_key > 0),
states AS (
SELECT day_key, c.child_id, c.center_id, c.teacher_id,
  {_exact_avg_sql('raw_score', 2)} AS raw_score,
  CAST(min(CASE WHEN is_scored = 1 THEN 0 END) AS DECIMAL(10,2)) AS min_score,
  CAST(max(CASE WHEN is_scored = 1 THEN 50 END) AS DECIMAL(10,2)) AS max_score,
  {_exact_avg_sql('normalized_score', 4)} AS normalized_score,
  CAST(count(DISTINCT source_daily_task_assignment_id) AS INTEGER) AS planned_task_count,
  CAST(count(DISTINCT source_task_assessment_id) AS INTEGER) AS assessment_count,
  CAST(count(DISTINCT CASE WHEN is_completed = 1 THEN source_daily_task_assignment_id END) AS INTEGER) AS completed_task_count,
  CAST(count(DISTINCT CASE WHEN is_scored = 1 THEN source_daily_task_assignment_id END) AS INTEGER) AS scored_task_count,
  CAST(count(DISTINCT CASE WHEN is_not_scored = 1 THEN source_daily_task_assignment_id END) AS INTEGER) AS not_scored_task_count
FROM changes c JOIN progress p ON p.child_id IS NOT DISTINCT FROM c.child_id AND p.center_id IS NOT DISTINCT FROM c.center_id
  AND p.teacher_id IS NOT DISTINCT FROM c.teacher_id AND p.date_key <= c.day_key
GROUP BY 1, 2, 3, 4),
spans AS (
SELECT *, strptime(CAST(day_key AS VARCHAR), '%Y%m%d') AS day_from,
  coalesce(lead(strptime(CAST(day_key AS VARCHAR), '%Y%m%d')) OVER (PARTITION BY child_id, center_id, teacher_id ORDER BY day_key) - INTERVAL 1 DAY,
           (SELECT strptime(CAST(max(date_key) AS VARCHAR), '%Y%m%d') FROM progress)) AS day_to
FROM states)
"""

#: Per day: how many rows the snapshot has and sums that tell its columns and keys apart.
DIGEST = {
    "child_sum": "child_id", "place_sum": "center_id * teacher_id", "raw_by_child": "raw_score * child_id", "min_sum": "min_score",
    "max_by_teacher": "max_score * teacher_id", "norm_by_child": "normalized_score * child_id", "planned_by_child": "planned_task_count * child_id",
    "assessed_by_teacher": "assessment_count * teacher_id", "completed_by_child": "completed_task_count * child_id",
    "scored_by_child": "scored_task_count * child_id", "not_scored_by_child": "not_scored_task_count * child_id"}
#: Four decimals for all, as 64-bit integers.
_SCALED = "CAST(({}) * 10000 AS BIGINT)"


def _whole_windows(out: dict) -> tuple:
    """Two windows that share a day and cover the fact's dates from the first to the last (two scalars)."""
    days = out["dim_date"].filter(F.col("TimeKey") != -1).select("TimeKey", "FullDateAlternateKey")
    lo, hi = (out["fact_tran_student_task_progress"].join(checked_broadcast(days), F.col("date_key") == F.col("TimeKey"))
              .agg(F.min("FullDateAlternateKey"), F.max("FullDateAlternateKey")).first())
    if lo is None:
        return ((RUN_START, RUN_END),) * 2
    day = _dt.timedelta(days=1)
    lo, hi = (_dt.datetime(d.year, d.month, d.day) for d in (lo, hi))
    middle = lo + day * ((hi - lo).days // 2)
    return (lo, middle + day), (middle, hi + day)


def daily_runs(spark: SparkSession, sf_dir: str) -> tuple:
    """F5 run twice on the fact as the mart wrote it, batch ids included: every day from the first fact date on."""
    from starloom.plans.mart1 import roll_daily_snapshot
    key = ("daily", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RUNS:
        out = program_run(spark, sf_dir)
        windows, state = _whole_windows(out), None
        for batch, (start, end) in enumerate(windows, 1):
            state = roll_daily_snapshot(out["fact_tran_student_task_progress"], out, start, end, state, batch, RUN_END)
        _RUNS[key] = (state, windows, out)
    return _RUNS[key]


@register("program_daily_snapshot_whole", ("F5", "A5", "A3", "A4", "J14", "K5"), DAILY_SQL + f"""
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS n_rows,
  {", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in DIGEST)}
FROM (SELECT unnest(generate_series(day_from, day_to, INTERVAL 1 DAY)) AS day,
        {", ".join(f"coalesce({_SCALED.format(e)}, 0) AS {n}" for n, e in DIGEST.items())} FROM spans)
GROUP BY 1
""")
def program_daily_snapshot_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping runs of F5 over all days of the fact, as one row of digests per day: the snapshot's rows number groups times days
    (1.2 billion on sf0.1), its spans only the changes."""
    from starloom.operators.intervals import daily_totals
    from starloom.plans.mart1 import _daily_columns
    state, _, out = daily_runs(spark, sf_dir)
    spans = _natural_ids(state.published, out)
    spans = spans.select("since", "valid_from", "valid_to", "child_id", "center_id", "teacher_id", *_daily_columns(spans))
    totals = {n: F.coalesce(F.expr(_SCALED.format(e)), F.lit(0)) for n, e in DIGEST.items()}
    days = daily_totals(spans, state.runs, totals)
    return days.select(F.date_format("snapshot_date", "yyyyMMdd").cast("int").alias("date_key"), *[F.col(n).cast("long").alias(n) for n in ("n_rows", *DIGEST)])


@register("program_accumulation_whole", ("F6", "J16", "A8", "K11"), DAILY_SQL + """
, seen AS (SELECT child_id, center_id, teacher_id, min(date_key) AS first_plan_date_key, max(date_key) AS last_plan_date_key,
       min(CASE WHEN source_task_assessment_id IS NOT NULL THEN date_key END) AS first_assessment_date_key,
       max(CASE WHEN source_task_assessment_id IS NOT NULL THEN date_key END) AS last_assessment_date_key, max(date_key) AS day_key
     FROM progress GROUP BY ALL)
SELECT d.child_id, d.center_id, d.teacher_id, (SELECT max(date_key) FROM progress) AS snapshot_date_key, planned_task_count, assessment_count,
       completed_task_count, scored_task_count, first_plan_date_key, last_plan_date_key, first_assessment_date_key, last_assessment_date_key
FROM states d JOIN seen s USING (child_id, center_id, teacher_id, day_key)
""")
def program_accumulation_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 after both windows of the daily snapshot: the second run's recomputed groups replace the first run's rows."""
    return whole_accumulation(spark, sf_dir)


def whole_accumulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 after each run of ``daily_runs``, by natural ids. Memoised."""
    from starloom.plans.mart1 import last_daily_rows, written_accumulation
    key = ("accumulation", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RUNS:
        state, windows, out = daily_runs(spark, sf_dir)
        acc = None
        for batch, (start, end) in enumerate(windows, 1):
            before, acc = acc, written_accumulation(last_daily_rows(state, out, start, end), out["fact_tran_student_task_progress"],
                                                    start, end, acc, batch, RUN_END)
            if before is not None:
                discard(before)
        _RUNS[key] = _natural_ids(acc, out).select(
            "child_id", "center_id", "teacher_id", "snapshot_date_key", "planned_task_count", "assessment_count", "completed_task_count",
            "scored_task_count", "first_plan_date_key", "last_plan_date_key", "first_assessment_date_key", "last_assessment_date_key")
    return _RUNS[key]
