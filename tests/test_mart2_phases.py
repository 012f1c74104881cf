"""Finance mart over six monthly phases (four single-month runs, then one two-month run).

Every phase adds 3 settled donations, 3 settled expenses, 5 settled payments and 3 allocations,
plus pending rows that must never load. Lifecycle and monthly figures are recomputed here in
plain Python from the source rows and compared with the mart.
"""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom.plans.dim_date import dim_date_between
from starloom.plans.mart2 import run_mart2
from starloom.plans.staging import run_staging
from tests import finance_fixture as fx

MONTHS = 6
CENTERS = (1, 2)


def month_start(m):
    return dt.datetime(2028, m, 1)


def phase_rows(upto):
    """All source rows created in months 1..upto (the source database grows each month)."""
    ts = lambda m, d, h=9: dt.datetime(2028, m, d, h)
    rows = {
        "donors": [(i, f"Donor {i}", None, None, None, "individual", True, ts(1, 1), None) for i in (1, 2, 3)],
        "campaigns": [(c, f"Campaign {c}", None, D("5000.00"), dt.date(2028, 1, 1), None, "active", ts(1, 1), None)
                      for c in (1, 2)],
        "expense_categories": [(1, "Food", True, ts(1, 1), None)],
        "donations": [], "expenses": [], "payments": [], "budget_allocations": [],
        "financial_transactions": [], "currency_rates": [(1, "USD", "IRR", D("1.5"), dt.date(2028, 1, 1))],
    }
    for m in range(1, upto + 1):
        base = m * 100
        statuses = ["confirmed", "confirmed", "refunded" if m % 2 else "rejected", "pending"]
        for i, st in enumerate(statuses):
            rows["donations"].append((base + i, 1 + (m + i) % 3, 1 + i % 2, D(f"{100 * m + 10 * i}.50"), "usd", "online",
                                      dt.date(2028, m, 3 + i), st, None, ts(m, 3 + i), None))
        for i, st in enumerate(["approved", "approved", "rejected", "pending"]):
            rows["expenses"].append((base + i, CENTERS[i % 2], None, 1, D(f"{20 * m + i}.25"), "USD",
                                     dt.date(2028, m, 10 + i), None, None, st, ts(m, 10 + i), None))
        for i, st in enumerate(["paid", "approved", "cancelled", "rejected", "paid", "pending"]):
            rows["payments"].append((base + i, "salary", None, CENTERS[i % 2], D(f"{30 * m + i}.00"), "USD",
                                     dt.date(2028, m, 15 + i), st, ts(m, 15 + i), None))
        allocs = [("donation", base + 0, 1), ("donation", base + 1, 2), ("internal_budget", None, 1)]
        for i, (stype, src, center) in enumerate(allocs):
            rows["budget_allocations"].append((base + i, stype, src, center, None, 1, D(f"{40 * m + i}.00"),
                                               dt.date(2028, m, 5 + i), None, ts(m, 5 + i)))
    return rows


@pytest.fixture(scope="module")
def phases(spark):
    dw = fx.shared_dims(spark)
    dw["dim_date"] = dim_date_between(spark, dt.date(2028, 1, 1), dt.date(2028, 12, 31))
    windows = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 7)]          # the last run covers two months
    stg, out, results = {}, {}, []
    for batch, (lo, hi) in enumerate(windows, start=1):
        src = fx.sources(spark, phase_rows(hi - 1))
        stg, _ = run_staging(spark, "finance_ops", src, stg, month_start(hi), batch_id=batch)
        out = run_mart2(spark, stg, dict(dw, **out), month_start(lo), month_start(hi), batch_id=batch,
                        first_load=(batch == 1))
        results.append((hi - 1, out))
    return {"results": results, "stg": stg, "dw": dw, "final": out}


def test_cumulative_counts_per_phase(phases):
    for months_loaded, out in phases["results"]:
        m = {r.fact_name: r.n for r in out["fact_source_load_map"].groupBy("fact_name")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
        assert m == {"fact_donation_transaction": 3 * months_loaded, "fact_expense_transaction": 3 * months_loaded,
                     "fact_payment_transaction": 5 * months_loaded, "fact_budget_allocation_event": 3 * months_loaded}
        assert out["fact_donation_transaction"].count() == 3 * months_loaded


def test_pending_never_loaded(phases):
    out = phases["final"]
    st = out["dim_status"].filter("code = 'pending'").select("status_key")
    for t in ("fact_donation_transaction", "fact_expense_transaction", "fact_payment_transaction"):
        assert out[t].join(st, "status_key").count() == 0, t


def test_lifecycle_recomputed(phases):
    out = phases["final"]
    rows = phase_rows(MONTHS)
    allocated = {a[2] for a in rows["budget_allocations"] if a[1] == "donation"}
    expect = defaultdict(list)
    for d in rows["donations"]:
        status = d[7]
        if status == "pending":
            continue
        stage = status if status in ("refunded", "rejected") else ("allocated" if d[0] in allocated else "confirmed")
        expect[(d[1], d[2], stage)].append(d[3])
    donors = {r.donor_key: r.donor_id for r in out["dim_donor"].collect()}
    camps = {r.campaign_key: r.campaign_id for r in out["dim_campaign"].collect()}
    got = {}
    for r in out["fact_donation_lifecycle"].collect():
        got[(donors[r.donor_key], camps[r.campaign_key], r.current_stage)] = (
            r.donation_amount, r.min_donation, r.max_donation, r.avg_donation)
    want = {k: (sum(v), min(v), max(v), (sum(v) / len(v)).quantize(D("0.01"), ROUND_HALF_UP))
            for k, v in expect.items()}
    assert got == want


def test_monthly_snapshot_recomputed(phases):
    out = phases["final"]
    rows = phase_rows(MONTHS)
    confirmed = {d[0] for d in rows["donations"] if d[7] == "confirmed"}
    exp = defaultdict(lambda: [D(0), D(0), D(0), 0, 0, 0, 0])
    for a in rows["budget_allocations"]:
        k = (a[7].month, a[3])
        exp[k][6] += 1
        if a[1] == "donation" and a[2] in confirmed:
            exp[k][0] += a[6]
            exp[k][3] += 1
    for e in rows["expenses"]:
        if e[9] == "approved":
            exp[(e[6].month, e[1])][1] += e[4]
            exp[(e[6].month, e[1])][4] += 1
    for p in rows["payments"]:
        if p[7] == "paid":
            exp[(p[6].month, p[3])][2] += p[4]
            exp[(p[6].month, p[3])][5] += 1
    centers = {r.center_key: r.center_id for r in phases["dw"]["dim_center"].collect()}
    snap = out["fact_monthly_financial_snapshot"]
    assert snap.groupBy("month_key", "center_key").count().filter("count > 1").count() == 0
    for r in snap.collect():
        month, cid = r.month_key // 100 % 100, centers[r.center_key]
        v = exp.get((month, cid), [D(0), D(0), D(0), 0, 0, 0, 0])
        assert (r.total_donation_amount, r.total_expense_amount, r.total_payment_amount) == tuple(v[:3]), (month, cid)
        assert r.net_balance == v[0] - v[1] - v[2]
        assert (r.donation_count, r.expense_count, r.payment_count, r.allocation_count) == tuple(v[3:])
    assert snap.count() == MONTHS * len(centers)


def test_two_period_rerun_is_idempotent(spark, phases):
    again = run_mart2(spark, phases["stg"], dict(phases["dw"], **phases["final"]), month_start(5), month_start(7),
                      batch_id=9)
    for t in ("fact_donation_transaction", "fact_expense_transaction", "fact_payment_transaction",
              "fact_budget_allocation_event", "fact_monthly_financial_snapshot", "fact_source_load_map",
              "fact_donation_lifecycle"):
        assert again[t].count() == phases["final"][t].count(), t
