"""The mart and staging tables that the jobs write, each with all its columns (surrogate keys resolved to natural ids), and
staging of an extract with repeated ids. The oracles restate the mapping of ``driver_sources`` in SQL."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import ts_lit
from starloom.operators.lookups import checked_broadcast
from starloom.plans import schemas
from starloom.plans.bind_marts import finance_run, program_run
from starloom.plans.driver_sources import LINE_ID_SQL, REASON_TITLES, finance_sources, program_task_sources
from starloom.plans.registry import register
from starloom.plans.staging import SPEC_BY_NAME, stage_table
from starloom.sources.tables import load

FAR = _dt.datetime(2100, 1, 1)


def _resolved(fact: DataFrame, out: dict, *pairs: tuple[str, str, str]) -> DataFrame:
    """Replace surrogate keys by a natural column of their dimension: (key, dimension, natural column)."""
    for key, dim, nat in pairs:
        d = checked_broadcast(out[dim].select(F.col(key).alias("_k"), F.col(nat).alias(f"{key.removesuffix('_key')}_nat")))
        fact = fact.join(d, F.col(key) == F.col("_k"), "left").drop("_k")
    return fact


# ------------------------------------------------------------------------------ finance dimensions
@register("finance_dim_category", ("D11",), """
SELECT DISTINCT l_linenumber AS category_id, 'Line ' || CAST(l_linenumber AS VARCHAR) AS category_name, 'active' AS category_status FROM lineitem
UNION ALL SELECT -1, 'Unknown', 'unknown'
""")
def finance_dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finance_run(spark, sf_dir)["dim_category"].select(F.col("category_id").cast("int"), "category_name", "category_status")


@register("finance_dim_codes", ("D12", "D14"), """
SELECT DISTINCT 'donation_type' AS dimension, 'online' AS code, 'online' AS title FROM orders WHERE o_totalprice > 0
UNION ALL SELECT 'donation_type', 'unknown', 'Unknown'
UNION ALL SELECT DISTINCT 'currency', code, code FROM (
  SELECT 'USD' AS code FROM orders UNION ALL SELECT upper(substr(n_name, 1, 3)) FROM nation)
UNION ALL SELECT 'currency', 'UNK', 'Unknown'
""")
def finance_dim_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    types = out["dim_donation_type"].select(F.lit("donation_type").alias("dimension"), "code", "title")
    return types.unionByName(out["dim_currency"].select(F.lit("currency").alias("dimension"), "code", F.col("name").alias("title")))


@register("finance_dim_status", ("D13", "U1", "SC8"), """
SELECT column0 AS status_type, column1 AS code, column1 AS title, column0 AS category FROM (VALUES
 ('donation', 'pending'), ('donation', 'confirmed'), ('donation', 'rejected'), ('donation', 'refunded'), ('expense', 'pending'),
 ('expense', 'approved'), ('expense', 'rejected'), ('payment', 'pending'), ('payment', 'approved'), ('payment', 'paid'),
 ('payment', 'cancelled'), ('payment', 'rejected')) AS v(column0, column1)
UNION ALL SELECT DISTINCT 'campaign', 'active', 'active', 'campaign' FROM orders
UNION ALL SELECT 'unknown', 'unknown', 'Unknown', 'unknown'
""")
def finance_dim_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finance_run(spark, sf_dir)["dim_status"].select("status_type", "code", "title", "category")


@register("finance_dim_members", ("D9", "D10"), """
SELECT 'donor' AS dimension, c_custkey AS id, c_name AS title, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'organization' ELSE 'individual' END AS kind
FROM customer
UNION ALL SELECT 'donor', -1, 'Unknown', 'unknown'
UNION ALL SELECT 'campaign', CAST(substr(o_orderpriority, 1, 1) AS BIGINT), min(o_orderpriority), 'active' FROM orders GROUP BY 2
UNION ALL SELECT 'campaign', -1, 'Unknown', 'unknown'
""")
def finance_dim_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    donors = out["dim_donor"].select(F.lit("donor").alias("dimension"), F.col("donor_id").cast("long").alias("id"),
                                     F.col("full_name").alias("title"), F.col("donor_type").alias("kind"))
    return donors.unionByName(out["dim_campaign"].select(F.lit("campaign").alias("dimension"), F.col("campaign_id").cast("long").alias("id"),
                                                         "title", F.col("campaign_status").alias("kind")))


# ------------------------------------------------------------------------------------ finance facts
_DATE_KEY = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"
#: A date outside the calendar (the order dates' years) has the key -1.
_CALENDAR_KEY = ("CASE WHEN year({0}) BETWEEN (SELECT min(year(o_orderdate)) FROM orders) AND (SELECT max(year(o_orderdate)) FROM orders) THEN "
                 + _DATE_KEY + " ELSE -1 END")
_WINDOW = "{0} >= TIMESTAMP '1995-01-01' AND {0} < TIMESTAMP '2002-01-01'"
_LINES_CTE = f"""WITH li AS (SELECT l.*, {LINE_ID_SQL} AS line_id, s.s_nationkey AS center_id,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS expense,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS payment
  FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey)
"""


@register("finance_fact_donation", ("F7", "V12"), f"""
SELECT {_CALENDAR_KEY.format('o_orderdate')} AS date_key, o_custkey AS donor_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS campaign_id,
  'online' AS donation_type, 'USD' AS currency, CASE o_orderstatus WHEN 'F' THEN 'confirmed' ELSE 'rejected' END AS status,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderstatus = 'F' AS INTEGER) AS is_confirmed, 0 AS is_refunded, -1 AS center_key
FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 0 AND {_WINDOW.format('o_orderdate')}
""")
def finance_fact_donation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    f = _resolved(out["fact_donation_transaction"], out, ("donor_key", "dim_donor", "donor_id"), ("campaign_key", "dim_campaign", "campaign_id"),
                  ("donation_type_key", "dim_donation_type", "code"), ("currency_key", "dim_currency", "code"), ("status_key", "dim_status", "code"))
    return f.select("date_key", F.col("donor_nat").cast("long").alias("donor_id"), F.col("campaign_nat").cast("long").alias("campaign_id"),
                    F.col("donation_type_nat").alias("donation_type"), F.col("currency_nat").alias("currency"), F.col("status_nat").alias("status"),
                    "amount", "is_confirmed", "is_refunded", "center_key")


@register("finance_fact_expense", ("F8",), _LINES_CTE + f"""
SELECT {_CALENDAR_KEY.format('l_shipdate')} AS date_key, CAST(center_id AS BIGINT) AS center_id, -1 AS child_key, CAST(l_linenumber AS BIGINT) AS category_id,
  'USD' AS currency, CASE l_returnflag WHEN 'A' THEN 'approved' ELSE 'rejected' END AS status, expense AS amount,
  CAST(l_returnflag = 'A' AS INTEGER) AS is_approved, CAST(l_returnflag = 'R' AS INTEGER) AS is_rejected
FROM li WHERE l_returnflag IN ('A', 'R') AND expense > 0 AND center_id IS NOT NULL AND {_WINDOW.format('l_shipdate')}
""")
def finance_fact_expense(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    f = _resolved(out["fact_expense_transaction"], out, ("center_key", "dim_center", "center_id"), ("category_key", "dim_category", "category_id"),
                  ("currency_key", "dim_currency", "code"), ("status_key", "dim_status", "code"))
    return f.select("date_key", F.col("center_nat").cast("long").alias("center_id"), F.col("child_key").cast("int").alias("child_key"),
                    F.col("category_nat").cast("long").alias("category_id"), F.col("currency_nat").alias("currency"),
                    F.col("status_nat").alias("status"), "amount", "is_approved", "is_rejected")


@register("finance_fact_payment", ("F9",), _LINES_CTE + f"""
SELECT {_CALENDAR_KEY.format('l_shipdate')} AS date_key, CAST(center_id AS BIGINT) AS center_id, 'USD' AS currency,
  CASE l_linestatus WHEN 'F' THEN 'paid' ELSE 'approved' END AS status, 'vendor' AS payment_type, payment AS amount,
  CAST(l_linestatus = 'F' AS INTEGER) AS is_paid, 0 AS is_cancelled
FROM li WHERE payment > 0 AND center_id IS NOT NULL AND {_WINDOW.format('l_shipdate')}
""")
def finance_fact_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    f = _resolved(out["fact_payment_transaction"], out, ("center_key", "dim_center", "center_id"), ("currency_key", "dim_currency", "code"),
                  ("status_key", "dim_status", "code"))
    return f.select("date_key", F.col("center_nat").cast("long").alias("center_id"), F.col("currency_nat").alias("currency"),
                    F.col("status_nat").alias("status"), "payment_type", "amount", "is_paid", "is_cancelled")


@register("finance_fact_allocation", ("F10", "J10"), _LINES_CTE + f"""
SELECT {_CALENDAR_KEY.format('l_shipdate')} AS date_key, CAST(center_id AS BIGINT) AS center_id, CAST(l_linenumber AS BIGINT) AS category_id, -1 AS child_key,
  CASE WHEN l_returnflag = 'N' THEN o.o_custkey ELSE -1 END AS donor_id,
  CASE WHEN l_returnflag = 'N' THEN CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) ELSE -1 END AS campaign_id
FROM li LEFT JOIN orders o ON o.o_orderkey = l_orderkey AND o.o_totalprice > 0
WHERE l_returnflag IN ('N', 'A') AND l_extendedprice > 0 AND center_id IS NOT NULL AND (l_returnflag = 'A' OR o.o_orderkey IS NOT NULL)
  AND {_WINDOW.format('l_shipdate')}
""")
def finance_fact_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance_run(spark, sf_dir)
    f = _resolved(out["fact_budget_allocation_event"], out, ("center_key", "dim_center", "center_id"), ("category_key", "dim_category", "category_id"),
                  ("donor_key", "dim_donor", "donor_id"), ("campaign_key", "dim_campaign", "campaign_id"))
    return f.select("date_key", F.col("center_nat").cast("long").alias("center_id"), F.col("category_nat").cast("long").alias("category_id"),
                    F.col("child_key").cast("int").alias("child_key"), F.col("donor_nat").cast("long").alias("donor_id"),
                    F.col("campaign_nat").cast("long").alias("campaign_id"))


# ------------------------------------------------------------------------------- program dimensions
_CATEGORY = ("child", "teacher", "center", "system", "other")


@register("program_dim_reasons", ("D7", "S6"), f"""
WITH r AS (SELECT r_regionkey AS no_score_reason_id, r_name AS reason_description,
  [{", ".join(f"'{t}'" for t in REASON_TITLES)}][r_regionkey % {len(REASON_TITLES)} + 1] AS reason_title FROM region),
f AS (SELECT *, lower(reason_title || ' ' || reason_description) AS t FROM r),
k AS (SELECT *, CAST(t LIKE '%child%' OR t LIKE '%absent%' OR t LIKE '%refus%' AS INTEGER) AS is_child_related,
  CAST(t LIKE '%teacher%' AS INTEGER) AS is_teacher_related, CAST(t LIKE '%center%' OR t LIKE '%closed%' AS INTEGER) AS is_center_related,
  CAST(t LIKE '%system%' AS INTEGER) AS is_system_related FROM f)
SELECT CAST(no_score_reason_id AS BIGINT) AS no_score_reason_id, reason_title, is_child_related, is_teacher_related, is_center_related, is_system_related FROM k
UNION ALL SELECT -1, 'Unknown', 0, 0, 0, 0
""")
def program_dim_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = program_run(spark, sf_dir)["dim_no_score_reason"]
    return d.select(F.col("no_score_reason_id").cast("long").alias("no_score_reason_id"), "reason_title",
                    *[F.col(f"is_{k}_related").cast("int").alias(f"is_{k}_related") for k in _CATEGORY[:4]])


@register("program_dim_members", ("D1", "D2", "D3", "D4", "J17"), """
SELECT 'child' AS dimension, c_custkey AS id, trim(trim(c_name) || ' ' || trim(c_mktsegment)) AS title, 'active' AS status FROM customer
UNION ALL SELECT 'center', n_nationkey, trim(n_name), 'active' FROM nation
UNION ALL SELECT 'domain', r_regionkey, trim(r_name), 'active' FROM region
UNION ALL SELECT * FROM (VALUES ('child', -1, 'Unknown', 'unknown'), ('center', -1, 'Unknown', 'unknown'), ('domain', -1, 'Unknown', 'unknown'))
""")
def program_dim_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = program_run(spark, sf_dir)
    parts = [("child", "child_id", "full_name", "status"), ("center", "center_id", "center_name", "center_status"),
             ("domain", "domain_id", "domain_name", "domain_status")]
    frames = [out[f"dim_{d}"].select(F.lit(d).alias("dimension"), F.col(i).cast("long").alias("id"), F.col(t).alias("title"), F.col(s).alias("status"))
              for d, i, t, s in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@register("program_dim_status", ("D6",), """
SELECT DISTINCT code AS assessment_status_code, CASE WHEN code = 'scored' THEN 'success' ELSE 'failure' END AS assessment_status_category,
  CAST(code = 'scored' AS INTEGER) AS is_successful_assessment, CAST(code <> 'scored' AS INTEGER) AS is_failure_assessment
FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 'scored' WHEN l_linenumber % 2 = 0 THEN 'not_scored' ELSE 'refused' END AS code
      FROM lineitem WHERE l_returnflag IN ('A', 'R'))
UNION ALL SELECT 'unknown', 'unknown', 0, 0
""")
def program_dim_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return program_run(spark, sf_dir)["dim_assessment_status"].select(
        "assessment_status_code", "assessment_status_category", "is_successful_assessment", "is_failure_assessment")


@register("program_dim_task", ("D8", "S12"), """
SELECT 'TEMPLATE:' || CAST(p_partkey AS VARCHAR) AS natural_task_code, trim(p_name) AS task_title, CAST(p_size % 5 AS BIGINT) AS domain_id, true AS is_template_based
FROM part WHERE p_size <= 25
UNION ALL
SELECT 'CUSTOM:' || CAST(p_size % 5 AS VARCHAR) || ':' || lower(trim(p_name)), min(trim(p_name)), CAST(p_size % 5 AS BIGINT), false
FROM part WHERE p_size > 25 AND p_partkey IN (SELECT l_partkey FROM lineitem) GROUP BY p_size % 5, lower(trim(p_name))
UNION ALL SELECT 'UNKNOWN', 'Unknown', -1, false
""")
def program_dim_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return program_run(spark, sf_dir)["dim_task"].select("natural_task_code", "task_title", F.col("domain_id").cast("long").alias("domain_id"),
                                                         "is_template_based")


# ---------------------------------------------------------------------------------- staged tables
def _staged(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table through its own staging job (first load)."""
    spec = SPEC_BY_NAME[table]
    sources = finance_sources(spark, sf_dir) if spec.system == "finance_ops" else program_task_sources(spark, sf_dir)
    if spec.system == "program_ops":
        for t in schemas.PROGRAM_OPS:
            sources.setdefault(t, schemas.empty(spark, t))
    staged, _, _ = stage_table(spec, sources, None, FAR, 1)
    return staged


_DONATION_IDS = "SELECT o_orderkey FROM orders WHERE o_totalprice > 0"
#: For each staged table the compared columns and the same rows in SQL.
STAGED = {
    "donors": ("id, full_name, donor_type, is_active", "SELECT c_custkey, c_name, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') "
               "THEN 'organization' ELSE 'individual' END, c_acctbal >= 0 FROM customer"),
    "campaigns": ("id, title, status", "SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER), min(o_orderpriority), 'active' FROM orders GROUP BY 1"),
    "expense_categories": ("id, name", "SELECT DISTINCT l_linenumber, 'Line ' || CAST(l_linenumber AS VARCHAR) FROM lineitem"),
    "donations": ("id, donor_id, amount, status", "SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)), CASE o_orderstatus WHEN 'F' "
                  "THEN 'confirmed' WHEN 'O' THEN 'rejected' ELSE 'pending' END FROM orders WHERE o_totalprice > 0"),
    "expenses": ("id, center_id, category_id, amount, status", _LINES_CTE + "SELECT line_id, center_id, l_linenumber, expense, CASE l_returnflag "
                 "WHEN 'A' THEN 'approved' WHEN 'R' THEN 'rejected' ELSE 'pending' END FROM li WHERE expense > 0 AND center_id IS NOT NULL"),
    "payments": ("id, center_id, amount, status", _LINES_CTE + "SELECT line_id, center_id, payment, CASE l_linestatus WHEN 'F' THEN 'paid' "
                 "ELSE 'approved' END FROM li WHERE payment > 0 AND center_id IS NOT NULL"),
    "budget_allocations": ("id, source_type, source_id, center_id, allocated_amount", _LINES_CTE + "SELECT line_id, CASE l_returnflag WHEN 'N' THEN "
                           "'donation' ELSE 'internal_budget' END, CASE WHEN l_returnflag = 'N' THEN l_orderkey END, center_id, CAST(l_extendedprice AS "
                           "DECIMAL(18,2)) FROM li WHERE l_returnflag IN ('N', 'A') AND l_extendedprice > 0 AND center_id IS NOT NULL AND "
                           f"(l_returnflag = 'A' OR l_orderkey IN ({_DONATION_IDS}))"),
    "financial_transactions": ("id, entity_type, entity_id, transaction_type, amount", "SELECT o_orderkey, 'donation', o_orderkey, 'credit', "
                               "CAST(o_totalprice AS DECIMAL(18,2)) FROM orders WHERE o_totalprice > 0"),
    "currency_rates": ("id, from_currency, to_currency", "SELECT n_nationkey, upper(substr(n_name, 1, 3)), 'USD' FROM nation"),
    "no_score_reasons": ("id, description", "SELECT r_regionkey, r_name FROM region"),
    "center_daily_status": ("id, center_id, status", "SELECT o_orderkey, c_nationkey, CASE WHEN o_orderkey % 2 = 0 THEN 'closed' ELSE 'open' END "
                            "FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'P'"),
    "child_task_plans": ("id, child_id, domain_id, task_title", f"SELECT {LINE_ID_SQL}, o_custkey, p_size % 5, p_name FROM lineitem "
                         "LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey "
                         "QUALIFY p_size > 25 AND o_custkey IS NOT NULL"),
    "task_assessments": ("id, child_id, teacher_id, score, assessment_status", f"SELECT * FROM (SELECT {LINE_ID_SQL} AS line_id, o_custkey, l_suppkey, "
                         "CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(10,2)) END, CASE WHEN l_returnflag = 'A' THEN 'scored' "
                         "WHEN l_linenumber % 2 = 0 THEN 'not_scored' ELSE 'refused' END, l_returnflag FROM lineitem JOIN orders ON o_orderkey = l_orderkey) "
                         "WHERE l_returnflag IN ('A', 'R')"),
    "centers": ("id, name, city", "SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey"),
    "domains": ("id, name", "SELECT r_regionkey, r_name FROM region"),
    "score_scales": ("id, name, max_score", "SELECT 1, 'Quantity', CAST(50 AS DECIMAL(10,2)) FROM part HAVING count(*) > 0"),
    "closure_reasons": ("id, title", "SELECT r_regionkey, r_name FROM region"),
    "absence_reasons": ("id, title", "SELECT r_regionkey, r_name FROM region"),
    "children": ("id, center_id, first_name, last_name", "SELECT c_custkey, c_nationkey, c_name, c_mktsegment FROM customer"),
    "teachers": ("id, center_id, first_name, is_active", "SELECT s_suppkey, s_nationkey, s_name, s_acctbal >= 0 FROM supplier"),
    "users": ("id, username, teacher_id", "SELECT s_suppkey, s_name, s_suppkey FROM supplier"),
    "task_templates": ("id, domain_id, title", "SELECT p_partkey, p_size % 5, p_name FROM part WHERE p_size <= 25"),
    "child_daily_status": ("id, child_id, status", "SELECT o_orderkey, o_custkey, 'absent' FROM orders WHERE o_orderstatus = 'P'"),
    "daily_task_assignments": ("id, child_id, task_template_id, child_task_plan_id, planned_by, status", f"SELECT line_id, o_custkey, "
                               "CASE WHEN p_size <= 25 THEN l_partkey END, CASE WHEN p_size > 25 THEN line_id END, l_suppkey, CASE WHEN l_linestatus = 'F' "
                               "THEN 'completed' WHEN l_linenumber % 4 = 1 THEN 'cancelled' WHEN l_linenumber % 4 = 2 THEN 'incomplete' ELSE 'planned' END "
                               f"FROM (SELECT *, {LINE_ID_SQL} AS line_id FROM lineitem) JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey"),
    "assessment_sessions": ("id, child_id, teacher_id, center_id", f"SELECT line_id, o_custkey, l_suppkey, s_nationkey FROM (SELECT *, {LINE_ID_SQL} AS line_id "
                            "FROM lineitem) JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey"),
    "notes": ("id, child_id, note_text", "SELECT o_orderkey, o_custkey, 'Order ' || o_orderstatus FROM orders"),
    "note_batches": ("id, note_text", "SELECT c_custkey, c_name FROM customer"),
    "note_batch_items": ("id, note_batch_id, note_id", "SELECT o_orderkey, o_custkey, o_orderkey FROM orders"),
    "audit_logs": ("id, entity_name, entity_id", "SELECT event_id, event_type, user_id FROM events WHERE event_type IS NOT NULL"),
}


def _register_staged(table: str, columns: str, sql: str) -> None:
    names = columns.split(", ")
    body = sql
    prefix = ""
    if sql.startswith("WITH"):
        at = sql.index("\n", sql.index("s.s_suppkey = l.l_suppkey)"))
        prefix, body = sql[:at + 1], sql[at + 1:]
    inner = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)
    aliases = ", ".join([*names, *(["_flag"] if table == "task_assessments" else [])])

    @register(f"staged_{table}", ("staging",), f"{prefix}SELECT {inner} FROM ({body}) AS v({aliases})")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Ids have different widths in the source schemas; text compares their values.
        return _staged(spark, sf_dir, table).filter("is_valid").select(*[F.col(n).cast("string").alias(n) for n in names])
    run.__name__ = f"staged_{table}"


for _table, (_columns, _sql) in STAGED.items():
    _register_staged(_table, _columns, _sql)


# ------------------------------------------------------------------- an extract with repeated ids
def _user_extract(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    """Every event of a user up to a day is one row of the extract, so ids repeat: the donor is the user, named by the
    event's type, updated at the event's time."""
    ev = load(spark, sf_dir, "events").filter(F.col("ts") < ts_lit(until))
    return ev.select(F.col("user_id").alias("id"), F.col("event_type").alias("full_name"), F.lit(None).cast("string").alias("national_id"),
                     F.lit(None).cast("string").alias("phone"), F.col("event_id").cast("string").alias("email"), F.lit("individual").alias("donor_type"),
                     F.lit(True).alias("is_active"), ts_lit("1990-01-01 00:00:00").alias("created_at"),
                     F.expr("timestampadd(MICROSECOND, event_id, ts)").cast("timestamp_ntz").alias("updated_at"))


REPEATED_SPLIT = "2024-01-15 00:00:00"


@register("stage_repeated_ids", ("K2", "J1", "staging"), f"""
WITH e AS (SELECT user_id AS id, event_type AS full_name, event_id, ts + to_microseconds(event_id) AS updated_at, ts < TIMESTAMP '{REPEATED_SPLIT}' AS early
           FROM events WHERE event_type IS NOT NULL),
latest AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, event_id DESC) = 1),
first AS (SELECT DISTINCT id FROM e WHERE early)
SELECT l.id, l.full_name, CAST(l.event_id AS VARCHAR) AS email, CAST(coalesce(f.id IS NOT NULL, false) AS BOOLEAN) AS in_first_load
FROM latest l LEFT JOIN first f ON f.id = l.id
""")
def stage_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging twice from extracts whose ids repeat many times: one row per id, its latest, and row ids of the first load are kept."""
    from dataclasses import replace
    from starloom.session import cut_lineage
    spec = replace(SPEC_BY_NAME["donors"], load="upsert")
    first, _, _ = stage_table(spec, {"donors": _user_extract(spark, sf_dir, REPEATED_SPLIT)}, None, FAR, 1)
    first = cut_lineage(first)
    second, _, _ = stage_table(spec, {"donors": _user_extract(spark, sf_dir, "2100-01-01 00:00:00")}, first, FAR, 2)
    top = first.agg(F.max("stg_row_id")).first()[0] or 0
    return second.select(F.col("id").cast("long").alias("id"), "full_name", "email", (F.col("stg_row_id") <= top).alias("in_first_load"))
