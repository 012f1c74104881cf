"""Reports over the marts' facts (R1-R4), and checks that must find planted defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.lookups import checked_broadcast
from starloom.operators.loads import append_new
from starloom.plans import quality, reports
from starloom.plans.bind_mart_tables import _CALENDAR_KEY, _LINES_CTE, _WINDOW
from starloom.plans.bind_marts import PROGRESS_MART_SQL, _natural_ids, finance_run, program_run
from starloom.plans.registry import register
from starloom.session import cut_lineage
from starloom.sources.tables import load


def _named(df: DataFrame, out: dict, key: str, dim: str, nat: str) -> DataFrame:
    """Exchange a report's surrogate key for the natural id (null where the key is rolled up)."""
    d = checked_broadcast(out[dim].select(F.col(key).alias("_k"), F.col(nat).cast("long").alias(nat)))
    return df.join(d, F.col(key) == F.col("_k"), "left").drop("_k", key)


@register("report_assessment_cube", ("R1",), PROGRESS_MART_SQL + """
SELECT CAST(center_id AS BIGINT) AS center_id, CAST(domain_id AS BIGINT) AS domain_id, CAST(grouping_id(center_id, domain_id) AS INTEGER) AS grouping_level,
  count(*) AS n_rows, CAST(sum(is_planned) AS BIGINT) AS n_planned, CAST(sum(is_completed) AS BIGINT) AS n_completed,
  CAST(sum(is_absent) AS BIGINT) AS n_absent, CAST(sum(is_refused) AS BIGINT) AS n_refused, CAST(sum(is_scored) AS BIGINT) AS n_scored,
  CAST(sum(is_cancelled) AS BIGINT) AS n_cancelled, CAST(sum(normalized_score) AS DECIMAL(38,4)) AS score_sum, count(normalized_score) AS n_scores,
  CASE WHEN sum(is_planned) > 0 THEN CAST(sum(is_completed) AS DOUBLE) / CAST(sum(is_planned) AS DOUBLE) END AS completion_rate,
  CAST(sum(is_absent) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS absence_rate
FROM progress GROUP BY CUBE (center_id, domain_id)
""")
def report_assessment_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = program_run(spark, sf_dir)
    cube = reports.assessment_cube(out["fact_tran_student_task_progress"], ["center_key", "domain_key"])
    return _named(_named(cube, out, "center_key", "dim_center", "center_id"), out, "domain_key", "dim_domain", "domain_id")


@register("report_finance_cube", ("R2",), _LINES_CTE + f""",
facts AS (
  SELECT 'expense' AS fact, {_CALENDAR_KEY.format('l_shipdate')} // 10000 AS year, CAST(center_id AS BIGINT) AS center_id, expense AS amount
  FROM li WHERE l_returnflag IN ('A', 'R') AND expense > 0 AND center_id IS NOT NULL AND {_WINDOW.format('l_shipdate')}
  UNION ALL
  SELECT 'payment', {_CALENDAR_KEY.format('l_shipdate')} // 10000, CAST(center_id AS BIGINT), payment
  FROM li WHERE payment > 0 AND center_id IS NOT NULL AND {_WINDOW.format('l_shipdate')})
SELECT fact, CAST(year AS INTEGER) AS year, center_id, CAST(grouping_id(year, center_id) AS INTEGER) AS grouping_level, count(*) AS n_rows,
  CAST(sum(amount) AS DECIMAL(38,2)) AS amount
FROM (SELECT * REPLACE (CASE WHEN year = 0 THEN -1 ELSE year END AS year) FROM facts) GROUP BY fact, ROLLUP (year, center_id)
""")
def report_finance_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    cube = reports.finance_cube({"expense": out["fact_expense_transaction"], "payment": out["fact_payment_transaction"]}, ["center_key"])
    return _named(cube, out, "center_key", "dim_center", "center_id")


@register("report_cost_per_task", ("R3",), PROGRESS_MART_SQL + f""",
done AS (SELECT CAST(center_id AS BIGINT) AS center_id, CAST(sum(is_completed) AS BIGINT) AS n FROM progress GROUP BY 1),
cost AS (SELECT CAST(s_nationkey AS BIGINT) AS center_id,
           sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))) AS amount
         FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'A' AND {_WINDOW.format('l_shipdate')}
           AND CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) > 0 GROUP BY 1)
SELECT coalesce(done.center_id, cost.center_id) AS center_id, coalesce(n, 0) AS completed_tasks, CAST(coalesce(amount, 0) AS DECIMAL(38,2)) AS approved_expense,
  CASE WHEN n > 0 THEN CAST(coalesce(amount, 0) AS DOUBLE) / n END AS cost_per_completed_task
FROM done FULL OUTER JOIN cost ON done.center_id = cost.center_id
""")
def report_cost_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drill across both marts on the conformed center."""
    prog, fin = program_run(spark, sf_dir), finance_run(spark, sf_dir)
    progress = _named(prog["fact_tran_student_task_progress"], prog, "center_key", "dim_center", "center_id")
    expenses = _named(fin["fact_expense_transaction"], fin, "center_key", "dim_center", "center_id")
    return reports.cost_per_completed_task(progress, expenses, "center_id")


@register("report_score_trend", ("R4",), PROGRESS_MART_SQL + """
SELECT CAST(date_key // 100 AS INTEGER) AS month, count(*) AS n_scored, CAST(sum(normalized_score) AS DECIMAL(38,4)) AS score_sum,
  CAST(CAST(sum(normalized_score) AS DECIMAL(38,4)) AS DOUBLE) / count(*) AS mean_score
FROM progress WHERE normalized_score IS NOT NULL GROUP BY 1
""")
def report_score_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.score_trend(program_run(spark, sf_dir)["fact_tran_student_task_progress"])


@register("report_status_funnel", ("R4",), PROGRESS_MART_SQL + """
SELECT unnest(['1 planned', '2 assessed', '3 completed', '4 scored']) AS step,
  unnest([CAST(sum(is_planned) AS BIGINT), CAST(sum(is_assessed) AS BIGINT), CAST(sum(is_completed) AS BIGINT), CAST(sum(is_scored) AS BIGINT)]) AS n_tasks
FROM progress
""")
def report_status_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_funnel(program_run(spark, sf_dir)["fact_tran_student_task_progress"])


# --------------------------------------------------------------- checks with planted defects
_GRAIN = ["child_id", "center_id", "teacher_id"]


@register("reconcile_planted", ("Q4", "U4"), PROGRESS_MART_SQL + """,
g AS (SELECT child_id, center_id, teacher_id FROM progress WHERE date_key <= 20010101 GROUP BY ALL)
SELECT count(*) AS n_left, count(*) AS n_right, count(*) FILTER (WHERE child_id % 50 = 0) AS n_only_left,
  count(*) FILTER (WHERE child_id % 50 = 0) AS n_only_right FROM g
""")
def reconcile_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot operator's rows of one day against a plain aggregate of the fact, after raising the count of every
    fiftieth child by one: the two-way EXCEPT must find exactly those."""
    import datetime as dt

    from starloom.operators.snapshots import cumulative_daily_snapshot
    out = program_run(spark, sf_dir)
    f = _natural_ids(out["fact_tran_student_task_progress"], out).withColumn(
        "day", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    snap = cumulative_daily_snapshot(f, _GRAIN, "day", dt.date(2001, 1, 1), dt.date(2001, 1, 2),
                                     distinct={"n": ("source_daily_task_assignment_id", None)}, sums={}, mins={}, maxs={})
    snap = snap.select(*_GRAIN, (F.col("n") + F.when(F.col("child_id") % 50 == 0, 1).otherwise(0)).cast("long").alias("n"))
    plain = f.filter("date_key <= 20010101").groupBy(*_GRAIN).agg(F.countDistinct("source_daily_task_assignment_id").alias("n"))
    return quality.reconcile(snap, plain)


@register("event_check_planted", ("Q9",), PROGRESS_MART_SQL + """
SELECT count(*) FILTER (WHERE child_id % 51 <> 0) AS n_progress, count(*) FILTER (WHERE child_id % 50 <> 0) AS n_events,
  count(*) FILTER (WHERE child_id % 51 <> 0 AND child_id % 50 = 0) AS n_missing_event,
  count(*) FILTER (WHERE child_id % 51 = 0 AND child_id % 50 <> 0) AS n_orphan_event FROM progress
""")
def event_check_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of every fiftieth child are taken away, and progress rows of every fifty-first."""
    out = program_run(spark, sf_dir)
    keys = ["source_daily_task_assignment_id", "source_task_assessment_id"]
    progress = _natural_ids(out["fact_tran_student_task_progress"], out).filter("child_id % 51 <> 0")
    events = _natural_ids(out["fact_child_task_event"], out).filter("child_id % 50 <> 0")
    return quality.event_consistency(progress, events, keys)


@register("rerun_planted", ("Q11", "K4"), PROGRESS_MART_SQL + """
SELECT source_daily_task_assignment_id, source_task_assessment_id FROM progress WHERE child_id % 50 = 0
""")
def rerun_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun over a fact that lost the rows of every fiftieth child appends exactly those."""
    out = program_run(spark, sf_dir)
    f = _natural_ids(out["fact_tran_student_task_progress"], out)
    keys = ["source_daily_task_assignment_id", "source_task_assessment_id"]
    new = append_new(f, f.filter("child_id % 50 <> 0"), keys, null_safe=True)
    return new.select(*[F.col(k).cast("long").alias(k) for k in keys])


@register("type1_planted", ("Q21",), """
SELECT count(*) AS n_members, count(*) FILTER (WHERE c_nationkey = 3) AS n_mismatched, CAST(0 AS BIGINT) AS n_duplicated FROM customer
""")
def type1_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The child dimension against a source in which one nation's children have another name."""
    dim = program_run(spark, sf_dir)["dim_child"].select(F.col("child_id").cast("long").alias("child_id"), "child_key", "first_name")
    c = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("child_id"),
        F.when(F.col("c_nationkey") == 3, F.concat("c_name", F.lit("!"))).otherwise(F.trim("c_name")).alias("first_name"))
    return quality.type1_propagation(dim, c, "child_id", ["first_name"], "child_key")


@register("documented_dq_planted", ("Q15", "V8"), """
SELECT 'child_without_center' AS check_name, count(*) FILTER (WHERE c_custkey % 50 = 0) AS problem_count FROM customer
UNION ALL SELECT 'non_positive_donation', count(*) FILTER (WHERE o_orderkey % 50 = 0) FROM orders
UNION ALL SELECT 'score_outside_scale', count(*) FILTER (WHERE l_quantity > 25) FROM lineitem WHERE l_returnflag = 'A'
""")
def documented_dq_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with children of no center, donations of nothing, and scores doubled beyond their scale."""
    from starloom.plans.driver_sources import finance_sources, program_task_sources
    prog, fin = program_task_sources(spark, sf_dir), finance_sources(spark, sf_dir)
    # The mapping's scale id is a literal; as stored columns the scale is joined by its id and not as a constant.
    prog["score_scales"] = cut_lineage(prog["score_scales"])
    prog["daily_task_assignments"] = cut_lineage(prog["daily_task_assignments"].select("id", "score_scale_id"))
    prog["children"] = prog["children"].withColumn("center_id", F.when(F.col("id") % 50 == 0, -9).otherwise(F.col("center_id")))
    prog["task_assessments"] = prog["task_assessments"].withColumn("score", F.col("score") * 2)
    fin["donations"] = fin["donations"].withColumn("amount", F.when(F.col("id") % 50 == 0, 0).otherwise(F.col("amount")))
    return quality.documented_dq(prog, fin)


@register("staging_validity_planted", ("Q14",), """
SELECT 'donors' AS table_name, count(*) FILTER (WHERE c_custkey % 50 = 0) AS n_invalid FROM customer
""")
def staging_validity_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged table in which every fiftieth row is marked invalid or unknown."""
    from starloom.plans.bind_mart_tables import _staged
    staged = _staged(spark, sf_dir, "donors").withColumn(
        "is_valid", F.when(F.col("id") % 100 == 0, F.lit(False)).when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("is_valid")))
    return quality.invalid_staged_rows(staged).select(F.lit("donors").alias("table_name"), "n_invalid")


@register("duplicate_grains", ("Q19",), """
SELECT unnest(['fact_child_task_event', 'fact_donation_transaction', 'fact_tran_student_task_progress', 'planted']) AS fact,
  unnest([0, 0, 0, (SELECT count(*) FROM customer WHERE c_custkey % 50 = 0)]) AS n_duplicate_groups
""")
def duplicate_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grains that occur more than once in the facts (none), and in a dimension with every fiftieth member doubled."""
    prog, fin = program_run(spark, sf_dir), finance_run(spark, sf_dir)
    ids = ["source_daily_task_assignment_id", "source_task_assessment_id"]
    donations = fin["fact_source_load_map"].filter("fact_name = 'fact_donation_transaction'")
    child = prog["dim_child"].filter("child_key <> -1")
    checks = [("fact_tran_student_task_progress", prog["fact_tran_student_task_progress"], ids),
              ("fact_child_task_event", prog["fact_child_task_event"], ["event_type", *ids]),
              ("fact_donation_transaction", donations, ["source_table", "source_id"]),
              ("planted", child.unionByName(child.filter("child_id % 50 = 0")), ["child_id"])]
    out = None
    for name, df, grain in checks:
        row = quality.duplicate_groups(df, grain).select(F.lit(name).alias("fact"), "n_duplicate_groups")
        out = row if out is None else out.unionByName(row)
    return out


@register("status_distribution_facts", ("Q20",), PROGRESS_MART_SQL + f""",
d AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'confirmed' ELSE 'rejected' END AS status FROM orders
      WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 0 AND {_WINDOW.format('o_orderdate')}),
p AS (SELECT CASE l_linestatus WHEN 'F' THEN 'paid' ELSE 'approved' END AS status FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
      WHERE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) > 0 AND {_WINDOW.format('l_shipdate')})
SELECT 'assessment' AS fact, status_code AS status, count(*) AS n FROM progress GROUP BY 2
UNION ALL SELECT 'donation', status, count(*) FROM d GROUP BY 2
UNION ALL SELECT 'payment', status, count(*) FROM p GROUP BY 2
""")
def status_distribution_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fact is counted by its status key, then the few counts get their codes."""
    prog, fin = program_run(spark, sf_dir), finance_run(spark, sf_dir)
    parts = [("assessment", prog["fact_tran_student_task_progress"], "assessment_status_key", prog["dim_assessment_status"], "assessment_status_code"),
             ("donation", fin["fact_donation_transaction"], "status_key", fin["dim_status"], "code"),
             ("payment", fin["fact_payment_transaction"], "status_key", fin["dim_status"], "code")]
    out = None
    for name, fact, key, dim, code in parts:
        n = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(dim.select(key, F.col(code).alias("status")), key, "left")
        row = n.select(F.lit(name).alias("fact"), "status", "n")
        out = row if out is None else out.unionByName(row)
    return out
