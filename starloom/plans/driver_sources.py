"""The driver's tables presented as the two operational source systems, so the real staging
and mart jobs run on whole tables (their work grows with the data).

Mapping (a rule per table, applied to every row):
  centers            <- nation (+ region name as city)
  donors             <- customer (organization for BUILDING/MACHINERY segments, active if balance >= 0)
  campaigns          <- the order priorities (id = leading digit)
  expense_categories <- line numbers 1..7
  donations          <- orders: F confirmed, O rejected, P pending; amount = total price
  budget_allocations <- lines with return flag N (donation-sourced, source = the order) or A (internal budget)
  expenses           <- lines: amount = price x discount; A approved, R rejected, N pending
  payments           <- lines: amount = price x tax; F paid, O approved
  financial_transactions <- one credit per order
  currency_rates     <- one rate per nation
Zero discounts and taxes give zero amounts, which staging validation rejects (V6).
"""

from __future__ import annotations

import threading

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.dates import ts_lit
from starloom.operators.keys import key_ranges, tasks_for
from starloom.operators.lookups import checked_broadcast
from starloom.session import cut_in_parts, discard
from starloom.sources.tables import load

EPOCH = "1990-01-01 00:00:00"


def _money(c):
    return F.col(c).cast("decimal(18,2)")


LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate")


def with_line_id(li: DataFrame) -> DataFrame:
    """(order, line number) is not unique in this data, so a line's id is its position within its
    order under a total order on every column (identical rows are interchangeable). The window is
    partitioned by order, so a partition holds one order's lines. The tasks that sort them grow in number with the lines, not in size."""
    n = tasks_for(li.sparkSession, li.count())
    if n is not None:
        li = li.repartition(n, "l_orderkey")
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    return li.withColumn("line_id", F.col("l_orderkey") * 1000 + pos)


LINE_ID_SQL = ("l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY "
               + ", ".join(LINE_ORDER) + ")")


_LINES: dict = {}
_LINES_LOCK = threading.Lock()


def _shared(spark: SparkSession, sf_dir: str, kind: str, build) -> DataFrame:
    """Materialise a derived work table, built part by part, once per (application, folder)."""
    key = (kind, spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LINES_LOCK:
        if key not in _LINES:
            _LINES[key] = cut_in_parts(build())
        return _LINES[key]


def forget_lines(spark: SparkSession, sf_dir: str, kind: str) -> None:
    """Remove a work table of ``_shared`` when its run has staged what is made of it; who asks for it again builds it again."""
    with _LINES_LOCK:
        lines = _LINES.pop((kind, spark.sparkContext.applicationId, sf_dir.rstrip("/")), None)
    if lines is not None:
        discard(lines)


def _lines(spark: SparkSession, sf_dir: str):
    """The lines by ranges of their orders. Of an id only the position is kept: it follows from the order's key."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    supp = checked_broadcast(load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    for within in key_ranges(li, "l_orderkey", li.count()):
        yield with_line_id(within.of(li, "l_orderkey")).join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(
            "l_orderkey", (F.col("line_id") - F.col("l_orderkey") * 1000).cast("int").alias("position"), "l_linenumber",
            _money("l_extendedprice").alias("price"), F.col("l_discount").cast("decimal(4,2)").alias("discount"),
            F.col("l_tax").cast("decimal(4,2)").alias("tax"), "l_returnflag", "l_linestatus", "l_shipdate", "s_nationkey")


def program_sources(spark: SparkSession, sf_dir: str, center_change: str | None = None) -> dict[str, DataFrame]:
    """``center_change``: a timestamp text renames every other center with that update time."""
    n = load(spark, sf_dir, "nation")
    name, updated = F.col("n_name"), F.lit(None).cast("timestamp_ntz")
    if center_change is not None:
        odd = F.col("n_nationkey") % 2 == 1
        name, updated = F.when(odd, F.concat(name, F.lit(" II"))).otherwise(name), F.when(odd, ts_lit(center_change))
    r = load(spark, sf_dir, "region")
    centers = n.join(checked_broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("id"), name.alias("name"), F.col("r_name").alias("city"),
        F.lit(None).cast("string").alias("address"), F.lit(True).alias("is_active"),
        ts_lit(EPOCH).alias("created_at"), updated.alias("updated_at"))
    children = spark.createDataFrame([], "id int, center_id int, first_name string, last_name string, "
                                         "national_code string, birth_date date, gender string, enrollment_date date, "
                                         "status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    return {"centers": centers, "children": children}


def finance_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = load(spark, sf_dir, "customer")
    o = load(spark, sf_dir, "orders")
    # Three source tables derive from the lines: number them once (one shuffle), not three times.
    lines = _shared(spark, sf_dir, "finance_lines", lambda: _lines(spark, sf_dir))
    lines = lines.withColumn("line_id", F.col("l_orderkey") * 1000 + F.col("position"))
    created = ts_lit(EPOCH)
    no_ts = F.lit(None).cast("timestamp_ntz")
    donors = c.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"), F.lit(None).cast("string").alias("national_id"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("email"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "organization").otherwise("individual")
        .alias("donor_type"), (F.col("c_acctbal") >= 0).alias("is_active"), created.alias("created_at"),
        no_ts.alias("updated_at"))
    priority_id = F.substring("o_orderpriority", 1, 1).cast("int")
    campaigns = o.select(priority_id.alias("id"), F.col("o_orderpriority").alias("title")).groupBy("id").agg(
        F.min("title").alias("title")).select(
        "id", "title", F.lit(None).cast("string").alias("description"), F.lit(0).cast("decimal(18,2)").alias("target_amount"),
        F.lit(None).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit("active").alias("status"), created.alias("created_at"), no_ts.alias("updated_at"))
    categories = lines.select(F.col("l_linenumber").alias("id")).distinct().select(
        "id", F.concat(F.lit("Line "), F.col("id").cast("string")).alias("name"), F.lit(True).alias("is_active"),
        created.alias("created_at"), no_ts.alias("updated_at"))
    status = F.col("o_orderstatus")
    donations = o.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("donor_id"), priority_id.alias("campaign_id"),
        _money("o_totalprice").alias("amount"), F.lit("USD").alias("currency"), F.lit("online").alias("donation_type"),
        F.to_date("o_orderdate").alias("donation_date"),
        F.when(status == "F", "confirmed").when(status == "O", "rejected").otherwise("pending").alias("status"),
        F.lit(None).cast("string").alias("reference_code"), F.col("o_orderdate").alias("created_at"),
        no_ts.alias("updated_at"))
    flag = F.col("l_returnflag")
    allocations = lines.filter(flag.isin("N", "A")).select(
        F.col("line_id").alias("id"), F.when(flag == "N", "donation").otherwise("internal_budget").alias("source_type"),
        F.when(flag == "N", F.col("l_orderkey")).alias("source_id"), F.col("s_nationkey").alias("center_id"),
        F.lit(None).cast("int").alias("child_id"), F.col("l_linenumber").alias("category_id"),
        F.col("price").alias("allocated_amount"), F.to_date("l_shipdate").alias("allocation_date"),
        F.lit(None).cast("string").alias("reason"), F.col("l_shipdate").alias("created_at"))
    price = F.col("price")
    expenses = lines.select(
        F.col("line_id").alias("id"), F.col("s_nationkey").alias("center_id"), F.lit(None).cast("int").alias("child_id"),
        F.col("l_linenumber").alias("category_id"),
        (price * F.col("discount")).cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"), F.to_date("l_shipdate").alias("expense_date"),
        F.lit(None).cast("string").alias("description"), F.lit(None).cast("int").alias("approved_by_user_id"),
        F.when(flag == "A", "approved").when(flag == "R", "rejected").otherwise("pending").alias("status"),
        F.col("l_shipdate").alias("created_at"), no_ts.alias("updated_at"))
    payments = lines.select(
        F.col("line_id").alias("id"), F.lit("vendor").alias("payment_type"), F.lit(None).cast("int").alias("teacher_id"),
        F.col("s_nationkey").alias("center_id"),
        (price * F.col("tax")).cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"), F.to_date("l_shipdate").alias("payment_date"),
        F.when(F.col("l_linestatus") == "F", "paid").otherwise("approved").alias("status"),
        F.col("l_shipdate").alias("created_at"), no_ts.alias("updated_at"))
    transactions = o.select(
        F.col("o_orderkey").alias("id"), F.lit("donation").alias("entity_type"), F.col("o_orderkey").alias("entity_id"),
        F.lit("credit").alias("transaction_type"), _money("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("transaction_date"), F.col("o_orderdate").alias("created_at"))
    rates = load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.upper(F.substring("n_name", 1, 3)).alias("from_currency"),
        F.lit("USD").alias("to_currency"), ((F.col("n_nationkey") + 1) / 10).cast("decimal(18,8)").alias("rate"),
        F.lit(_dt.date(1995, 1, 1)).alias("rate_date"))
    return {"donors": donors, "campaigns": campaigns, "expense_categories": categories, "donations": donations,
            "budget_allocations": allocations, "expenses": expenses, "payments": payments,
            "financial_transactions": transactions, "currency_rates": rates}


# Program operations from the driver's tables:
#   children <- customer (center = customer nation)     teachers, users <- supplier
#   domains  <- region                                  score_scales    <- one 0..50 scale
#   task_templates <- parts of size <= 25 (domain = size mod 5)
#   child_task_plans <- lines of all other parts: a custom plan with the part's name as title
#   child_daily_status <- pending orders (the customer is absent on the order day)
#   center_daily_status <- pending orders (the customer's nation is closed that day if the order's key is even, else open)
#   no_score_reasons <- regions
#   daily_task_assignments, assessment_sessions <- lines (child = the order's customer, planner/teacher = the
#       supplier, template = the part when it is a template, else the line's plan); shipped lines are completed, others
#       by line number cancelled, incomplete or planned
#   task_assessments <- lines flagged A (scored, score = quantity) or R (refused, or not scored with a reason)
TEMPLATE_MAX_SIZE = 25
REASON_TITLES = ("Child absent", "Teacher away", "Center closed", "System error", "Other")


def program_task_sources(spark: SparkSession, sf_dir: str, teacher_change: str | None = "always",
                         center_change: str | None = None) -> dict[str, DataFrame]:
    """``teacher_change``: "always" marks suppliers with a negative balance inactive from the
    start; None keeps every teacher active; a timestamp text marks them inactive with that
    update time (the second phase of a two-phase load)."""
    out = program_sources(spark, sf_dir, center_change)
    created = ts_lit(EPOCH)
    no_ts = F.lit(None).cast("timestamp_ntz")
    c = load(spark, sf_dir, "customer")
    s = load(spark, sf_dir, "supplier")
    p = load(spark, sf_dir, "part")
    r = load(spark, sf_dir, "region")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    out["children"] = c.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("center_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"), F.lit(None).cast("string").alias("national_code"),
        F.lit(None).cast("date").alias("birth_date"), F.lit(None).cast("string").alias("gender"),
        F.lit(None).cast("date").alias("enrollment_date"), F.lit("active").alias("status"), created.alias("created_at"),
        no_ts.alias("updated_at"))
    negative = F.col("s_acctbal") < 0
    if teacher_change is None:
        active, updated = F.lit(True), no_ts
    elif teacher_change == "always":
        active, updated = ~negative, no_ts
    else:
        active, updated = ~negative, F.when(negative, ts_lit(teacher_change))
    out["teachers"] = s.select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("center_id"), F.col("s_name").alias("first_name"),
        F.lit("").alias("last_name"), F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("email"),
        F.lit("active").alias("employment_status"), active.alias("is_active"),
        created.alias("created_at"), updated.cast("timestamp_ntz").alias("updated_at"))
    out["users"] = s.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("username"), F.lit("-").alias("password_hash"),
        F.lit("teacher").alias("role"), F.col("s_suppkey").alias("teacher_id"), F.lit(True).alias("is_active"),
        created.alias("created_at"), no_ts.alias("updated_at"))
    out["domains"] = r.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"),
                              F.lit(None).cast("string").alias("description"), F.lit(True).alias("is_active"),
                              created.alias("created_at"), no_ts.alias("updated_at"))
    # One scale for the quantities of all parts: an aggregate over the table, one row.
    out["score_scales"] = p.agg(F.count("*").alias("parts")).select(
        F.lit(1).alias("id"), F.lit("Quantity").alias("name"), F.lit(0).cast("decimal(10,2)").alias("min_score"),
        F.lit(50).cast("decimal(10,2)").alias("max_score"), F.lit(None).cast("string").alias("description"),
        F.lit(True).alias("is_active"), created.alias("created_at"), no_ts.alias("updated_at"))
    out["task_templates"] = p.filter(F.col("p_size") <= TEMPLATE_MAX_SIZE).select(
        F.col("p_partkey").alias("id"), (F.col("p_size") % 5).alias("domain_id"), F.col("p_name").alias("title"),
        F.lit(None).cast("string").alias("description"), F.lit(1).alias("default_score_scale_id"),
        F.lit(True).alias("is_active"), F.lit(None).cast("int").alias("created_by"), created.alias("created_at"),
        no_ts.alias("updated_at"))
    out["child_daily_status"] = o.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("child_id"), F.to_date("o_orderdate").alias("date"),
        F.lit("absent").alias("status"), F.lit(None).cast("int").alias("absence_reason_id"),
        F.lit(None).cast("string").alias("note"), F.lit(None).cast("int").alias("created_by"),
        F.col("o_orderdate").alias("created_at"), no_ts.alias("updated_at"))
    pending = o.filter(F.col("o_orderstatus") == "P").join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    out["center_daily_status"] = pending.select(
        F.col("o_orderkey").alias("id"), F.col("c_nationkey").alias("center_id"), F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderkey") % 2 == 0, "closed").otherwise("open").alias("status"),
        F.lit(None).cast("int").alias("closure_reason_id"), F.lit(None).cast("string").alias("note"),
        F.lit(None).cast("int").alias("created_by"), F.col("o_orderdate").alias("created_at"), no_ts.alias("updated_at"))
    reason = F.element_at(F.array(*[F.lit(x) for x in REASON_TITLES]), F.col("r_regionkey") % len(REASON_TITLES) + 1)
    out["no_score_reasons"] = r.select(
        F.col("r_regionkey").alias("id"), reason.alias("title"), F.col("r_name").alias("description"), F.lit(True).alias("is_active"),
        created.alias("created_at"), no_ts.alias("updated_at"))

    reasons = r.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"), F.lit(None).cast("string").alias("description"),
                       F.lit(True).alias("is_active"), created.alias("created_at"), no_ts.alias("updated_at"))
    out["closure_reasons"] = out["absence_reasons"] = reasons
    # Every order is a note on its customer, batched by customer; every event is an audit-log row.
    out["notes"] = o.select(
        F.col("o_orderkey").alias("id"), F.lit("child").alias("note_scope"), F.lit(None).cast("int").alias("center_id"),
        F.col("o_custkey").alias("child_id"), F.lit(None).cast("int").alias("teacher_id"), F.to_date("o_orderdate").alias("date"),
        F.lit(None).cast("int").alias("daily_task_assignment_id"), F.lit(None).cast("int").alias("task_assessment_id"),
        F.concat(F.lit("Order "), F.col("o_orderstatus")).alias("note_text"), F.lit(None).cast("int").alias("created_by"),
        F.col("o_orderdate").alias("created_at"), no_ts.alias("updated_at"))
    out["note_batches"] = c.select(
        F.col("c_custkey").alias("id"), F.lit(None).cast("int").alias("created_by"), F.lit("child").alias("note_scope"),
        F.col("c_name").alias("note_text"), created.alias("created_at"))
    out["note_batch_items"] = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("note_batch_id"), F.col("o_orderkey").alias("note_id"))
    out["audit_logs"] = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.lit(None).cast("int").alias("user_id"), F.col("event_type").alias("entity_name"),
        F.col("user_id").alias("entity_id"), F.lit("event").alias("action"), F.lit(None).cast("string").alias("old_value"),
        F.col("props").alias("new_value"), F.col("ts").cast("timestamp_ntz").alias("created_at"))

    def numbered_lines():
        li = load(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
        parts = checked_broadcast(p.select("p_partkey", "p_size", "p_name"))
        suppliers = checked_broadcast(s.select("s_suppkey", "s_nationkey"))
        orders = o.select("o_orderkey", "o_custkey")
        for within in key_ranges(li, "l_orderkey", li.count()):
            mine = with_line_id(within.of(li, "l_orderkey"))
            yield (mine.join(within.of(orders, "o_orderkey"), mine.l_orderkey == orders.o_orderkey, "left")
                       .join(parts, mine.l_partkey == parts.p_partkey, "left")
                       .join(suppliers, mine.l_suppkey == suppliers.s_suppkey, "left")
                       .select("line_id", "o_custkey", "p_size", "p_name", "s_nationkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                               "l_returnflag", "l_linestatus", "l_shipdate")
                       .sortWithinPartitions("line_id"))     # ids in order take little room
    lines = _shared(spark, sf_dir, "program_lines", numbered_lines)   # three source tables read them
    day = F.to_date("l_shipdate")
    custom = ~F.coalesce(F.col("p_size") <= TEMPLATE_MAX_SIZE, F.lit(False))
    out["child_task_plans"] = lines.filter(custom).select(
        F.col("line_id").alias("id"), F.col("o_custkey").alias("child_id"), F.lit(None).cast("int").alias("task_template_id"),
        (F.col("p_size") % 5).alias("domain_id"), F.col("p_name").alias("task_title"), F.lit(1).alias("score_scale_id"),
        day.alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_active"),
        F.lit(None).cast("int").alias("created_by"), F.col("l_shipdate").alias("created_at"), no_ts.alias("updated_at"))
    out["daily_task_assignments"] = lines.select(
        F.col("line_id").alias("id"), F.col("o_custkey").alias("child_id"), day.alias("date"),
        F.when(custom, F.col("line_id")).alias("child_task_plan_id"),
        F.when(F.col("p_size") <= TEMPLATE_MAX_SIZE, F.col("l_partkey")).alias("task_template_id"),
        (F.col("p_size") % 5).alias("domain_id"), F.col("p_name").alias("task_title"), F.lit(1).alias("score_scale_id"),
        F.col("l_suppkey").alias("planned_by"),
        F.when(F.col("l_linestatus") == "F", "completed").when(F.col("l_linenumber") % 4 == 1, "cancelled")
        .when(F.col("l_linenumber") % 4 == 2, "incomplete").otherwise("planned").alias("status"),
        F.col("l_shipdate").alias("created_at"), no_ts.alias("updated_at"))
    out["assessment_sessions"] = lines.select(
        F.col("line_id").alias("id"), F.col("o_custkey").alias("child_id"), F.col("l_suppkey").alias("teacher_id"),
        F.col("s_nationkey").alias("center_id"), day.alias("date"), F.lit(None).cast("timestamp_ntz").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("ended_at"), F.lit("done").alias("session_status"),
        F.lit(None).cast("string").alias("general_note"), F.col("l_shipdate").alias("created_at"), no_ts.alias("updated_at"))
    scored, even = F.col("l_returnflag") == "A", F.col("l_linenumber") % 2 == 0
    out["task_assessments"] = lines.filter(F.col("l_returnflag").isin("A", "R")).select(
        F.col("line_id").alias("id"), F.col("line_id").alias("daily_task_assignment_id"),
        F.col("line_id").alias("assessment_session_id"), F.col("o_custkey").alias("child_id"),
        F.col("l_suppkey").alias("teacher_id"), day.alias("date"),
        F.when(scored, F.col("l_quantity").cast("decimal(10,2)")).alias("score"),
        F.lit(None).cast("decimal(10,4)").alias("normalized_score"),
        F.when(scored, "scored").when(even, "not_scored").otherwise("refused").alias("assessment_status"),
        F.when(~scored & even, F.col("l_suppkey") % 5).cast("int").alias("no_score_reason_id"), F.lit(1).alias("attempt_no"),
        F.lit(None).cast("string").alias("note"), F.col("l_shipdate").alias("created_at"), no_ts.alias("updated_at"))
    return out
