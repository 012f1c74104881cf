"""Finance mart end to end: staging -> first load (Jan-Feb) -> incremental (Mar), golden numbers."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom.plans.mart2 import run_mart2
from starloom.plans.staging import run_staging
from tests import finance_fixture as fx


@pytest.fixture(scope="module")
def runs(spark):
    src1 = fx.sources(spark, fx.first_load_rows())
    stg1, log1 = run_staging(spark, "finance_ops", src1, {}, dt.datetime(2028, 3, 1), batch_id=1)
    dw = fx.shared_dims(spark)
    first = run_mart2(spark, stg1, dw, dt.datetime(2028, 1, 1), dt.datetime(2028, 3, 1), batch_id=1, first_load=True)
    src2 = fx.sources(spark, fx.incremental_rows())
    stg2, log2 = run_staging(spark, "finance_ops", src2, stg1, dt.datetime(2028, 4, 1), batch_id=2)
    second = run_mart2(spark, stg2, dict(dw, **first), dt.datetime(2028, 3, 1), dt.datetime(2028, 4, 1), batch_id=2)
    return {"stg1": stg1, "log1": log1, "first": first, "stg2": stg2, "log2": log2, "second": second}


def snap(out, month_key, center_key):
    rows = out["fact_monthly_financial_snapshot"].filter(
        (F.col("month_key") == month_key) & (F.col("center_key") == center_key)).collect()
    assert len(rows) == 1
    r = rows[0]
    return (r.total_donation_amount, r.total_expense_amount, r.total_payment_amount, r.net_balance,
            r.donation_count, r.expense_count, r.payment_count, r.allocation_count)


def test_first_load_snapshot_golden(runs):
    out = runs["first"]
    assert snap(out, 20280131, 1) == (D("700.00"), D("100.00"), D("300.00"), D("300.00"), 1, 1, 1, 1)
    assert snap(out, 20280131, 2) == (D("300.00"), D("0.00"), D("0.00"), D("300.00"), 1, 0, 0, 1)
    assert snap(out, 20280229, 1) == (D("1200.00"), D("250.00"), D("400.00"), D("550.00"), 1, 1, 1, 2)


def test_incremental_snapshot_golden(runs):
    out = runs["second"]
    assert snap(out, 20280331, 1) == (D("1000.00"), D("200.00"), D("100.00"), D("700.00"), 1, 1, 1, 1)
    # Past months are never rewritten (append missing grain only).
    assert snap(out, 20280131, 1) == (D("700.00"), D("100.00"), D("300.00"), D("300.00"), 1, 1, 1, 1)


def test_pending_never_loaded_and_counts(runs):
    first, second = runs["first"], runs["second"]
    assert first["fact_donation_transaction"].count() == 2          # 103 is pending
    assert second["fact_donation_transaction"].count() == 3
    assert second["fact_expense_transaction"].count() == 3
    assert second["fact_payment_transaction"].count() == 3
    assert second["fact_budget_allocation_event"].count() == 5
    m = second["fact_source_load_map"]
    assert m.count() == 3 + 3 + 3 + 5
    assert m.groupBy("fact_name", "source_id").count().filter("count > 1").count() == 0


def test_type1_updates_and_stable_keys(runs):
    first, second = runs["first"], runs["second"]
    donor = second["dim_donor"].filter("donor_id = 1").collect()[0]
    assert donor.full_name == "Donor A - Updated"
    old_key = first["dim_donor"].filter("donor_id = 1").collect()[0].donor_key
    assert donor.donor_key == old_key
    camp = second["dim_campaign"].filter("campaign_id = 1").collect()[0]
    assert (camp.title, camp.campaign_status) == ("Campaign - Updated", "closed")
    assert second["dim_category"].filter("category_id = 2").collect()[0].category_name == "Books - Updated"
    assert second["dim_status"].filter("status_type = 'campaign' AND code = 'closed'").count() == 1
    assert second["dim_donor"].filter("donor_key = -1").count() == 1


def test_unknown_keys_and_internal_budget(runs):
    ev = runs["second"]["fact_budget_allocation_event"]
    assert ev.filter("donor_key = -1 OR campaign_key = -1").count() == 0
    # Allocation 402 has no child: child_key resolves to the unknown member.
    assert ev.filter("child_key = -1").count() == 1
    tx = runs["second"]["fact_donation_transaction"]
    assert tx.filter("center_key <> -1").count() == 0


def test_lifecycle(runs):
    life = runs["second"]["fact_donation_lifecycle"].collect()
    assert sum(r.donation_amount for r in life) == D("4500.00")       # 1000 + 2000 + 1500
    stages = {r.current_stage for r in life}
    assert stages == {"allocated"}
    assert all(r.allocated_date_key != -1 for r in life)


def test_staging_upsert_actions(runs):
    stg2 = runs["stg2"]
    # The updated donor keeps its staging row id; the new donation gets the next id.
    a1 = runs["stg1"]["donors"].filter("id = 1").collect()[0]
    a2 = stg2["donors"].filter("id = 1").collect()[0]
    assert a2.full_name == "Donor A - Updated"
    d1 = runs["stg1"]["donations"].agg(F.max("stg_row_id")).first()[0]
    d104 = stg2["donations"].filter("id = 104").collect()[0].stg_row_id
    assert d104 == d1 + 1
    assert a1.row_hash != a2.row_hash
    log = {r.source_table: r for r in runs["log2"].collect()}
    assert log["donations"].rows_inserted == 1 and log["donations"].rows_updated == 0
    assert log["donors"].rows_rejected == 0


def test_idempotent_rerun(spark, runs):
    stg2, second = runs["stg2"], runs["second"]
    dw = dict(fx.shared_dims(spark), **second)
    third = run_mart2(spark, stg2, dw, dt.datetime(2028, 3, 1), dt.datetime(2028, 4, 1), batch_id=3)
    for t in ("fact_donation_transaction", "fact_expense_transaction", "fact_payment_transaction",
              "fact_budget_allocation_event", "fact_monthly_financial_snapshot", "fact_source_load_map"):
        assert third[t].count() == second[t].count(), t


def test_write_and_resume_from_written_tables(spark, runs, tmp_path):
    """The incremental run gives the same facts when the first load is read back from storage."""
    from starloom.plans.tables import read_tables, write_tables
    first = {k: v for k, v in runs["first"].items() if not k.startswith("etl_")}
    paths = write_tables(first, str(tmp_path / "dw"))
    assert (tmp_path / "dw" / "fact_donation_transaction").exists()
    assert any(p.name.startswith("date_key=") for p in (tmp_path / "dw" / "fact_donation_transaction").iterdir())
    dw = dict(fx.shared_dims(spark), **read_tables(spark, paths))
    again = run_mart2(spark, runs["stg2"], dw, dt.datetime(2028, 3, 1), dt.datetime(2028, 4, 1), batch_id=2)
    for t in ("fact_donation_transaction", "fact_monthly_financial_snapshot", "fact_source_load_map"):
        assert again[t].count() == runs["second"][t].count(), t
    assert snap(again, 20280331, 1) == (D("1000.00"), D("200.00"), D("100.00"), D("700.00"), 1, 1, 1, 1)
