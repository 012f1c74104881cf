"""Finance mart (Mart 2): dimensions D9-D14, facts F7-F12, runner ``run_mart2``.

Inputs are DataFrames: the finance staging tables (staging envelope + source columns), the
current DW tables (absent on a first load) and the shared dim_date / dim_center / dim_child.
Every function returns the next version of its table (or the rows to append); nothing is
mutated in place, so a failed run leaves the previous version untouched.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_from_key, ts_lit
from starloom.functions.hashing import row_hash
from starloom.functions.numeric import exact_avg
from starloom.functions.text import blank_to_null, norm_lower, norm_upper
from starloom.operators.keys import ROWS_PER_TASK, KeyRange, key_ranges
from starloom.operators.loads import append_new
from starloom.operators.lookups import bounded_count, lookup_key
from starloom.operators.scd import scd1_rebuild
from starloom.operators.validation import require_params, settled, valid_rows
from starloom.plans.audit import BatchLog, run_logged
from starloom.session import cut_in_parts, cut_lineage, discard, run_concurrently
from starloom.sources.watermark import business_window, history_before

# Settled statuses per fact and the status pairs seeded into dim_status.
DONATION_SETTLED = ["confirmed", "rejected", "refunded"]
EXPENSE_SETTLED = ["approved", "rejected"]
PAYMENT_SETTLED = ["approved", "paid", "cancelled", "rejected"]
STATUS_VALUES = [
    ("donation", "pending"), ("donation", "confirmed"), ("donation", "rejected"), ("donation", "refunded"),
    ("expense", "pending"), ("expense", "approved"), ("expense", "rejected"),
    ("payment", "pending"), ("payment", "approved"), ("payment", "paid"), ("payment", "cancelled"),
    ("payment", "rejected"),
]
MAP_SCHEMA = "fact_name string, source_table string, source_id long, loaded_etl_batch_id int"


def latest(stg: DataFrame) -> DataFrame:
    """V11 + J1: the valid version of every id. Staging holds one row per id (K1 replaces it, K2 reduces an extract to its latest row
    per id before the upsert), so no aggregate over the history is needed, and the filters of a run's window reach the scan."""
    return valid_rows(stg)


# ----------------------------------------------------------------------------------- dims
def dim_donor(stg: dict, old: DataFrame | None) -> DataFrame:
    d = latest(stg["donors"])
    src = d.select(F.col("id").alias("donor_id"), "full_name", "donor_type", "is_active",
                   row_hash("id", "full_name", "donor_type", "is_active").alias("row_hash"))
    return scd1_rebuild(src, old, ["donor_id"], "donor_key",
                        unknown={"donor_id": -1, "full_name": "Unknown", "donor_type": "unknown"})


def dim_campaign(stg: dict, old: DataFrame | None) -> DataFrame:
    c = latest(stg["campaigns"])
    src = c.select(F.col("id").alias("campaign_id"), "title", F.col("status").alias("campaign_status"),
                   "target_amount", "start_date", "end_date",
                   row_hash("id", "title", "status", "target_amount", "start_date", "end_date").alias("row_hash"))
    return scd1_rebuild(src, old, ["campaign_id"], "campaign_key",
                        unknown={"campaign_id": -1, "title": "Unknown", "campaign_status": "unknown"})


def dim_category(stg: dict, old: DataFrame | None) -> DataFrame:
    c = latest(stg["expense_categories"])
    src = c.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"),
                   F.lit(None).cast("int").alias("parent_category_id"),
                   F.lit(None).cast("string").alias("parent_category_name"),
                   F.when(F.col("is_active"), "active").otherwise("inactive").alias("category_status"),
                   row_hash("id", "name", "is_active").alias("row_hash"))
    return scd1_rebuild(src, old, ["category_id"], "category_key",
                        unknown={"category_id": -1, "category_name": "Unknown", "category_status": "unknown"})


def dim_donation_type(stg: dict, old: DataFrame | None) -> DataFrame:
    d = valid_rows(stg["donations"]).filter(blank_to_null("donation_type").isNotNull())
    src = d.groupBy(norm_lower("donation_type").alias("code")).agg(F.min(F.trim("donation_type")).alias("title"))
    return scd1_rebuild(src, old, ["code"], "donation_type_key", unknown={"code": "unknown", "title": "Unknown"})


def dim_status(spark: SparkSession, stg: dict, old: DataFrame | None) -> DataFrame:
    fixed = spark.createDataFrame(STATUS_VALUES, "status_type string, code string")
    camp = valid_rows(stg["campaigns"]).select(F.lit("campaign").alias("status_type"), F.col("status").alias("code"))
    raw = fixed.unionByName(camp).filter(blank_to_null("code").isNotNull())
    src = raw.groupBy("status_type", norm_lower("code").alias("code")).agg(
        F.min(F.trim("code")).alias("title")).withColumn("category", F.col("status_type"))
    return scd1_rebuild(src, old, ["status_type", "code"], "status_key",
                        unknown={"status_type": "unknown", "code": "unknown", "title": "Unknown", "category": "unknown"})


def dim_currency(stg: dict, old: DataFrame | None) -> DataFrame:
    v = lambda t: valid_rows(stg[t])
    codes = (v("donations").select(F.col("currency").alias("c"))
             .unionByName(v("expenses").select(F.col("currency").alias("c")))
             .unionByName(v("payments").select(F.col("currency").alias("c")))
             .unionByName(v("currency_rates").select(F.explode(F.array("from_currency", "to_currency")).alias("c"))))
    src = codes.filter(blank_to_null("c").isNotNull()).select(norm_upper("c").alias("code")).distinct() \
               .withColumn("name", F.col("code"))
    return scd1_rebuild(src, old, ["code"], "currency_key", unknown={"code": "UNK", "name": "Unknown"})


# ---------------------------------------------------------------------------------- facts
def _date_key(df: DataFrame, dim_date: DataFrame, date_col: str, out: str = "date_key") -> DataFrame:
    dd = dim_date.filter(F.col("TimeKey") != -1).select("TimeKey", "FullDateAlternateKey")
    return lookup_key(df, dd, {date_col: "FullDateAlternateKey"}, "TimeKey", out, pick="min")


def _center_key(df, dim_center, col="center_id", out="center_key"):
    # Mart 2 resolves a center by MIN(center_key): the oldest version (reference behaviour).
    return lookup_key(df, dim_center, {col: "center_id"}, "center_key", out, pick="min")


def _status_key(df, dim_status, status_type, col="status"):
    st = dim_status.filter(F.col("status_type") == status_type)
    return lookup_key(df, st, [(norm_lower(col), "code")], "status_key", "status_key")


def _append_with_map(rows: DataFrame | Iterable[DataFrame], load_map: DataFrame, fact_name: str, source_table: str,
                     id_col: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """K3: rows (of one frame, or of several that are written one after the other) whose source id is not in the lineage map, plus the
    map rows to add.

    The new rows are materialised once (with their source id) and both outputs read that
    work table, so the lookups behind the fact are not evaluated a second time for the map."""
    m = load_map.filter((F.col("fact_name") == fact_name) & (F.col("source_table") == source_table)) \
                .select(F.col("source_id").alias(id_col))
    new = cut_in_parts(append_new(r, m, [id_col]) for r in ([rows] if isinstance(rows, DataFrame) else rows))
    add = new.select(F.lit(fact_name).alias("fact_name"), F.lit(source_table).alias("source_table"),
                     F.col(id_col).cast("long").alias("source_id"), F.lit(batch_id).alias("loaded_etl_batch_id"))
    return new.drop(id_col), add


def fact_donation_transaction(stg, dims, start, end, load_map, batch_id, load_ts):
    d = settled(business_window(latest(stg["donations"]), "donation_date", start, end), "status", DONATION_SETTLED)
    d = _date_key(d, dims["dim_date"], "donation_date")
    d = lookup_key(d, dims["dim_donor"], {"donor_id": "donor_id"}, "donor_key")
    d = lookup_key(d, dims["dim_campaign"], {"campaign_id": "campaign_id"}, "campaign_key")
    d = lookup_key(d, dims["dim_donation_type"], [(norm_lower("donation_type"), "code")], "donation_type_key")
    d = lookup_key(d, dims["dim_currency"], [(norm_upper("currency"), "code")], "currency_key")
    d = _status_key(d, dims["dim_status"], "donation")
    s = norm_lower(F.coalesce("status", F.lit("")))
    rows = d.select("date_key", "donor_key", "campaign_key", F.lit(-1).alias("center_key"), "donation_type_key",
                    "currency_key", "status_key", "amount", (s == "confirmed").cast("int").alias("is_confirmed"),
                    (s == "refunded").cast("int").alias("is_refunded"),
                    F.lit(batch_id).alias("etl_batch_id"), ts_lit(load_ts).alias("loaded_at"),
                    F.col("id").alias("source_donation_id"))
    return _append_with_map(rows, load_map, "fact_donation_transaction", "donations", "source_donation_id", batch_id)


def fact_expense_transaction(stg, dims, start, end, load_map, batch_id, load_ts):
    e = settled(business_window(latest(stg["expenses"]), "expense_date", start, end), "status", EXPENSE_SETTLED)
    e = _date_key(e, dims["dim_date"], "expense_date")
    e = _center_key(e, dims["dim_center"])
    e = lookup_key(e, dims["dim_child"], {"child_id": "child_id"}, "child_key")
    e = lookup_key(e, dims["dim_category"], {"category_id": "category_id"}, "category_key")
    e = lookup_key(e, dims["dim_currency"], [(norm_upper("currency"), "code")], "currency_key")
    e = _status_key(e, dims["dim_status"], "expense")
    s = norm_lower(F.coalesce("status", F.lit("")))
    rows = e.select("date_key", "center_key", "child_key", "category_key", "currency_key", "status_key", "amount",
                    (s == "approved").cast("int").alias("is_approved"), (s == "rejected").cast("int").alias("is_rejected"),
                    F.lit(batch_id).alias("etl_batch_id"), ts_lit(load_ts).alias("loaded_at"),
                    F.col("id").alias("source_expense_id"))
    return _append_with_map(rows, load_map, "fact_expense_transaction", "expenses", "source_expense_id", batch_id)


def fact_payment_transaction(stg, dims, start, end, load_map, batch_id, load_ts):
    p = settled(business_window(latest(stg["payments"]), "payment_date", start, end), "status", PAYMENT_SETTLED)
    p = _date_key(p, dims["dim_date"], "payment_date")
    p = _center_key(p, dims["dim_center"])
    p = lookup_key(p, dims["dim_currency"], [(norm_upper("currency"), "code")], "currency_key")
    p = _status_key(p, dims["dim_status"], "payment")
    s = norm_lower(F.coalesce("status", F.lit("")))
    rows = p.select("date_key", "center_key", "currency_key", "status_key", "payment_type", "amount",
                    (s == "paid").cast("int").alias("is_paid"), (s == "cancelled").cast("int").alias("is_cancelled"),
                    F.lit(batch_id).alias("etl_batch_id"), ts_lit(load_ts).alias("loaded_at"),
                    F.col("id").alias("source_payment_id"))
    return _append_with_map(rows, load_map, "fact_payment_transaction", "payments", "source_payment_id", batch_id)


def fact_budget_allocation_event(stg, dims, start, end, load_map, batch_id, load_ts):
    allocated = business_window(latest(stg["budget_allocations"]), "allocation_date", start, end)
    rows = (_allocation_rows(r.of(allocated, "source_id"), r, stg, dims, batch_id, load_ts) for r in _moved_ranges(allocated, "source_id"))
    return _append_with_map(rows, load_map, "fact_budget_allocation_event", "budget_allocations",
                            "source_allocation_id", batch_id)


def _moved_ranges(df: DataFrame, col: str) -> list[KeyRange]:
    """Ranges of a key by which the rows of a large frame are joined, so that the disk holds the shuffles of one."""
    return key_ranges(df, col, df.count()) if _is_large(df) else [KeyRange()]


def _allocation_rows(a: DataFrame, within: KeyRange, stg, dims, batch_id, load_ts) -> DataFrame:
    """Fact rows of the allocations whose source lies in a range."""
    is_donation = norm_lower(F.coalesce("source_type", F.lit(""))) == "donation"
    # Only donation-sourced allocations look up their donation (others skip the join).
    don = within.of(latest(stg["donations"]), "id").select(F.col("id").alias("_don_id"), "donor_id", "campaign_id")
    via = a.filter(is_donation).join(don, F.col("source_id") == F.col("_don_id"), "left").drop("_don_id")
    via = lookup_key(via, dims["dim_donor"], {"donor_id": "donor_id"}, "donor_key")
    via = lookup_key(via, dims["dim_campaign"], {"campaign_id": "campaign_id"}, "campaign_key")
    internal = a.filter(~is_donation).withColumns({"donor_key": F.lit(-1), "campaign_key": F.lit(-1)})
    x = via.select(*a.columns, "donor_key", "campaign_key").unionByName(
        internal.select(*a.columns, F.col("donor_key").cast(via.schema["donor_key"].dataType),
                        F.col("campaign_key").cast(via.schema["campaign_key"].dataType)))
    x = _date_key(x, dims["dim_date"], "allocation_date")
    x = _center_key(x, dims["dim_center"])
    x = lookup_key(x, dims["dim_child"], {"child_id": "child_id"}, "child_key")
    x = lookup_key(x, dims["dim_category"], {"category_id": "category_id"}, "category_key")
    return x.select("date_key", "donor_key", "center_key", "child_key", "category_key", "campaign_key",
                    F.lit(batch_id).alias("etl_batch_id"), ts_lit(load_ts).alias("loaded_at"),
                    F.col("id").alias("source_allocation_id"))


def fact_monthly_financial_snapshot(stg, dims, facts, start, end, existing, batch_id, load_ts):
    """one row per (month, dim_center row) for every month from start's month to end's date,
    appended only where (month_key, center_key) is missing (K5)."""
    month0 = _dt.date(start.year, start.month, 1)
    period_end = end.date() if isinstance(end, _dt.datetime) else end
    dd = dims["dim_date"].filter(F.col("TimeKey") != -1)
    # month_key = the last TimeKey present in dim_date for each month in range.
    months = (dd.filter((F.col("FullDateAlternateKey") >= F.lit(month0)) &
                        (F.trunc("FullDateAlternateKey", "month") < F.lit(period_end)))
                .groupBy(F.trunc("FullDateAlternateKey", "month").alias("month_start"))
                .agg(F.max("TimeKey").alias("month_key")))
    # The run's months are a handful of rows: bring them to the driver as literals and explode
    # them per dim_center row (J15 scaffold without a join).
    month_rows = months.select("month_start", "month_key").orderBy("month_start").collect()
    centers = dims["dim_center"].select("center_key", "center_id")
    if not month_rows:
        return None
    lits = F.array(*[F.struct(F.lit(r["month_start"]).alias("month_start"),
                              F.lit(r["month_key"]).alias("month_key")) for r in month_rows])
    scaffold = centers.withColumn("_m", F.explode(lits)).select("center_key", "center_id", "_m.*")
    keys = months.select("month_start", "month_key")
    alloc = latest(stg["budget_allocations"]).select("id", "source_type", "source_id", "center_id",
                                                     "allocated_amount", "allocation_date")
    don = latest(stg["donations"]).filter(norm_lower(F.coalesce("status", F.lit(""))) == "confirmed") \
                                  .select(F.col("id").alias("_don_id"))
    # allocation_date in [month_start, EOMONTH] is the same as trunc(allocation_date) = month_start.
    alloc_m = alloc.withColumn("month_start", F.trunc("allocation_date", "month")).join(keys, "month_start")
    don_amt = (alloc_m.filter(norm_lower(F.coalesce("source_type", F.lit(""))) == "donation")
               .join(don, F.col("source_id") == F.col("_don_id"))
               .groupBy("center_id", "month_start")
               .agg(F.sum("allocated_amount").alias("total_donation_amount"),
                    F.countDistinct("_don_id").alias("donation_count")))
    alloc_cnt = alloc_m.groupBy("center_id", "month_start").agg(F.count(F.lit(1)).alias("allocation_count"))

    def fact_month(f, flag, amount_name, count_name):
        # date_key BETWEEN month start key AND month_key, as an equi-join on the month plus a bound.
        fm = (f.filter((F.col(flag) == 1) & (F.col("date_key") != -1))
               .withColumn("month_start", F.trunc(date_from_key("date_key"), "month"))
               .join(keys, "month_start").filter(F.col("date_key") <= F.col("month_key")))
        return fm.groupBy("center_key", "month_start").agg(F.sum("amount").alias(amount_name),
                                                           F.count(F.lit(1)).alias(count_name))
    exp = fact_month(facts["fact_expense_transaction"], "is_approved", "total_expense_amount", "expense_count")
    pay = fact_month(facts["fact_payment_transaction"], "is_paid", "total_payment_amount", "payment_count")
    x = (scaffold.join(don_amt, ["center_id", "month_start"], "left")
                 .join(alloc_cnt, ["center_id", "month_start"], "left")
                 .join(exp, ["center_key", "month_start"], "left")
                 .join(pay, ["center_key", "month_start"], "left"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = x.select(
        "month_key", "center_key",
        z("total_donation_amount").cast("decimal(18,2)").alias("total_donation_amount"),
        z("total_expense_amount").cast("decimal(18,2)").alias("total_expense_amount"),
        z("total_payment_amount").cast("decimal(18,2)").alias("total_payment_amount"),
        (z("total_donation_amount") - z("total_expense_amount") - z("total_payment_amount"))
        .cast("decimal(18,2)").alias("net_balance"),
        *[z(c).cast("int").alias(c) for c in ("donation_count", "expense_count", "payment_count", "allocation_count")],
        F.lit(batch_id).alias("etl_batch_id"), ts_lit(load_ts).alias("loaded_at"))
    if existing is None:
        return rows
    return append_new(rows, existing, ["month_key", "center_key"])


def fact_donation_lifecycle(stg, dims, end, batch_id, load_ts):
    """F12 (K10 rebuild): donor x campaign x status x stage aggregates over all settled history. The frames to be written one after
    the other: ranges of the donors."""
    d = settled(history_before(latest(stg["donations"]), "donation_date", end), "status", DONATION_SETTLED)
    a = latest(stg["budget_allocations"]).filter(norm_lower(F.coalesce("source_type", F.lit(""))) == "donation")
    a = _date_key(a, dims["dim_date"], "allocation_date", "_ak")
    # First allocation date key per donation (not bounded by the window, as in the source loader).
    alloc = a.groupBy(F.col("source_id").alias("_src")).agg(
        F.min(F.when(F.col("_ak") != -1, F.col("_ak"))).alias("allocated_date_key"))
    d = lookup_key(d, dims["dim_donor"], {"donor_id": "donor_id"}, "donor_key")
    ranges = _moved_ranges(d, "donor_key")
    if len(ranges) > 1:
        alloc = cut_lineage(alloc)
    for within in ranges:
        yield _lifecycle_rows(within.of(d, "donor_key").join(alloc, F.col("id") == F.col("_src"), "left"), dims, batch_id, load_ts)
    discard(alloc)


def _lifecycle_rows(d: DataFrame, dims, batch_id, load_ts) -> DataFrame:
    """The aggregates of donations that have their donor's key and the first day on which they were allocated."""
    d = _date_key(d, dims["dim_date"], "donation_date", "created_key")
    d = lookup_key(d, dims["dim_campaign"], {"campaign_id": "campaign_id"}, "campaign_key")
    st = dims["dim_status"].filter(F.col("status_type") == "donation")
    s = norm_lower(F.coalesce("status", F.lit("")))
    d = lookup_key(d, st, [(s, "code")], "status_key", "lifecycle_status_key")
    stage = (F.when(s == "refunded", "refunded").when(s == "rejected", "rejected")
              .when(F.col("allocated_date_key").isNotNull(), "allocated").otherwise("confirmed"))
    base = d.select("donor_key", "campaign_key",
                    F.col("created_key").alias("created_date_key"),
                    F.when(s.isin("confirmed", "refunded"), F.col("created_key")).otherwise(F.lit(-1))
                    .alias("confirmed_date_key"),
                    F.coalesce("allocated_date_key", F.lit(-1)).alias("allocated_date_key"),
                    "lifecycle_status_key", stage.alias("current_stage"), F.col("amount").alias("donation_amount"))
    nz = lambda c: F.coalesce(F.min(F.when(F.col(c) != -1, F.col(c))), F.lit(-1)).alias(c)
    return base.groupBy("donor_key", "campaign_key", "lifecycle_status_key", "current_stage").agg(
        nz("created_date_key"), nz("confirmed_date_key"), nz("allocated_date_key"),
        F.sum("donation_amount").cast("decimal(18,2)").alias("donation_amount"),
        F.min("donation_amount").alias("min_donation"), F.max("donation_amount").alias("max_donation"),
        F.sum("donation_amount").alias("_sum"), F.count("donation_amount").alias("_n"),
    ).withColumn("avg_donation", exact_avg(F.col("_sum"), F.col("_n"), 2, 18)).drop("_sum", "_n") \
     .withColumns({"etl_batch_id": F.lit(batch_id), "loaded_at": ts_lit(load_ts)})


# --------------------------------------------------------------------------------- runner
FACTS = [("fact_donation_transaction", fact_donation_transaction),
         ("fact_expense_transaction", fact_expense_transaction),
         ("fact_payment_transaction", fact_payment_transaction),
         ("fact_budget_allocation_event", fact_budget_allocation_event)]
#: Staging tables that one fact reads and no other step after the dimensions.
ONLY_READER = {"fact_payment_transaction": "payments", "fact_expense_transaction": "expenses"}


def _is_large(df: DataFrame) -> bool:
    return bounded_count(df, ROWS_PER_TASK) > ROWS_PER_TASK


def run_mart2(spark: SparkSession, staging: dict, dw: dict, start: _dt.datetime, end: _dt.datetime,
              load_ts: _dt.datetime | None = None, batch_id: int = 1, first_load: bool = False,
              log: BatchLog | None = None, spent: Callable[[str], None] = lambda name: None) -> dict:
    """One Mart 2 run over [start, end). ``dw`` must hold dim_date, dim_center and dim_child
    (shared with Mart 1); on an incremental run also the previous finance tables.
    Returns the next version of every finance table plus ``etl_batch``/``etl_load_log``. A failing step leaves a
    failed step and batch in ``log`` (pass one to read it after an exception) and the exception goes on. ``spent`` is told the name of
    a staging table when no later step reads it."""
    require_params(start_time=start, end_time=end)
    load_ts = load_ts or end
    for t in ("dim_date", "dim_center", "dim_child"):                       # Q3
        if t not in dw:
            raise RuntimeError(f"prerequisite table {t} is missing")
    log = log or BatchLog(spark, "FINANCE_OPS", "DW", "FINANCE_MART2", load_ts, batch_id)
    prev = {} if first_load else dw                                       # K9: first load starts empty

    def materialised(build):
        def run():
            rows = build()
            df = cut_in_parts([rows] if isinstance(rows, DataFrame) else rows)
            return df, df.count()
        return run

    # The six dimensions are independent: build them side by side.
    built = run_logged(log, "dimensions", run_concurrently, {
        "dim_donor": materialised(lambda: dim_donor(staging, prev.get("dim_donor"))),
        "dim_campaign": materialised(lambda: dim_campaign(staging, prev.get("dim_campaign"))),
        "dim_category": materialised(lambda: dim_category(staging, prev.get("dim_category"))),
        "dim_donation_type": materialised(lambda: dim_donation_type(staging, prev.get("dim_donation_type"))),
        "dim_status": materialised(lambda: dim_status(spark, staging, prev.get("dim_status"))),
        "dim_currency": materialised(lambda: dim_currency(staging, prev.get("dim_currency")))})
    out = {}
    for name, (df, n) in built.items():
        out[name] = df
        log.step("staging", name, n, n)
    dims = dict(out, dim_date=dw["dim_date"], dim_center=dw["dim_center"], dim_child=dw["dim_child"])
    load_map = prev.get("fact_source_load_map") or spark.createDataFrame([], MAP_SCHEMA)

    # The four transaction/event facts and the lifecycle read only dimensions and staging.
    # Of large tables one is moved after the other; those go first that leave their staging table to nobody.
    def fact(name, fn):
        def run():
            new_rows, add = fn(staging, dims, start, end, load_map, batch_id, load_ts)
            if name in ONLY_READER:
                spent(ONLY_READER[name])
            return new_rows, add, new_rows.count()
        return run
    tasks = {name: fact(name, fn) for name, fn in sorted(FACTS, key=lambda f: f[0] not in ONLY_READER)}
    tasks["fact_donation_lifecycle"] = materialised(
        lambda: fact_donation_lifecycle(staging, dims, end, batch_id, load_ts))
    large = any(_is_large(staging[t]) for t in ("donations", "expenses", "payments", "budget_allocations"))
    results = run_logged(log, "facts", run_concurrently, tasks, 1 if large else 4)
    map_parts = [load_map]
    for name, _ in FACTS:
        new_rows, add, n = results[name]
        old = prev.get(name)
        out[name] = new_rows if old is None else old.unionByName(new_rows)
        map_parts.append(add)
        log.step("staging", name, n, n)
    m = map_parts[0]
    for p in map_parts[1:]:
        m = m.unionByName(p)
    out["fact_source_load_map"] = m      # its rows are read from the facts' work tables
    old = prev.get("fact_monthly_financial_snapshot")
    snap_new = fact_monthly_financial_snapshot(staging, dims, out, start, end, old, batch_id, load_ts)
    if snap_new is None:
        out["fact_monthly_financial_snapshot"] = old
        log.step("dw", "fact_monthly_financial_snapshot", 0, 0, message="no dim_date month in range")
    else:
        snap_new = run_logged(log, "fact_monthly_financial_snapshot", cut_lineage, snap_new)
        out["fact_monthly_financial_snapshot"] = snap_new if old is None else old.unionByName(snap_new)
        n = snap_new.count()
        log.step("dw", "fact_monthly_financial_snapshot", n, n)
    out["fact_donation_lifecycle"], n = results["fact_donation_lifecycle"]
    log.step("staging", "fact_donation_lifecycle", n, n)
    log.finish("succeeded")
    out["etl_batch"], out["etl_load_log"] = log.frames()
    return out
