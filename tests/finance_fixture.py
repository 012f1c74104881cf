"""A small deterministic finance dataset: first load Jan-Feb 2028, incremental March 2028.

Mirrors the scenario of the finance smoke test this library's Mart 2 reproduces; amounts are
chosen so every monthly snapshot value is known by hand.
"""

import datetime as dt
from decimal import Decimal as D

from starloom.plans import schemas


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)


def first_load_rows():
    return {
        "donors": [(1, "Donor A", "NID-A", "0912", "a@example.com", "individual", True, ts("2028-01-02T08:00:00"), None),
                   (2, "Donor Org B", "NID-B", "0212", "b@example.com", "organization", True, ts("2028-01-03T08:00:00"), None)],
        "campaigns": [(1, "Campaign", "ETL validation campaign.", D("100000.00"), d("2028-01-01"), d("2028-12-31"),
                       "active", ts("2028-01-01T09:00:00"), None)],
        "expense_categories": [(1, "Education", True, ts("2028-01-01T09:00:00"), None),
                               (2, "Books", True, ts("2028-01-01T09:00:00"), None),
                               (3, "Meals", True, ts("2028-01-01T09:00:00"), None)],
        "donations": [
            (101, 1, 1, D("1000.00"), "IRR", "online", d("2028-01-05"), "confirmed", "DON-101", ts("2028-01-04T10:00:00"), None),
            (102, 2, 1, D("2000.00"), "IRR", "bank_transfer", d("2028-02-10"), "confirmed", "DON-102", ts("2028-02-09T10:00:00"), None),
            (103, 1, 1, D("500.00"), "IRR", "cash", d("2028-02-20"), "pending", "DON-103", ts("2028-02-20T10:00:00"), None)],
        "expenses": [
            (201, 1, 1, 2, D("100.00"), "IRR", d("2028-01-15"), "January expense.", 10, "approved", ts("2028-01-15T11:00:00"), None),
            (202, 1, 2, 3, D("250.00"), "IRR", d("2028-02-18"), "February expense.", 10, "approved", ts("2028-02-18T11:00:00"), None)],
        "payments": [
            (301, "salary", 1001, 1, D("300.00"), "IRR", d("2028-01-25"), "paid", ts("2028-01-25T12:00:00"), None),
            (302, "vendor", None, 1, D("400.00"), "IRR", d("2028-02-26"), "paid", ts("2028-02-26T12:00:00"), None)],
        "budget_allocations": [
            (401, "donation", 101, 1, 1, 2, D("700.00"), d("2028-01-06"), "Jan donor A to center 1.", ts("2028-01-06T13:00:00")),
            (402, "donation", 101, 2, None, 3, D("300.00"), d("2028-01-07"), "Jan donor A to center 2.", ts("2028-01-07T13:00:00")),
            (403, "donation", 102, 1, 2, 2, D("1200.00"), d("2028-02-11"), "Feb donor B to center 1.", ts("2028-02-11T13:00:00")),
            (404, "donation", 103, 1, 1, 2, D("200.00"), d("2028-02-22"), "Feb pending donation.", ts("2028-02-22T13:00:00"))],
        "financial_transactions": [
            (501, "donation", 101, "credit", D("1000.00"), d("2028-01-05"), ts("2028-01-05T14:00:00")),
            (502, "expense", 201, "debit", D("100.00"), d("2028-01-15"), ts("2028-01-15T14:00:00")),
            (503, "payment", 301, "debit", D("300.00"), d("2028-01-25"), ts("2028-01-25T14:00:00"))],
        "currency_rates": [(601, "USD", "IRR", D("500000.00000000"), d("2028-01-01")),
                           (602, "EUR", "IRR", D("550000.00000000"), d("2028-01-01"))],
    }


def incremental_rows():
    rows = first_load_rows()
    rows["donors"][0] = (1, "Donor A - Updated", "NID-A", "0912", "a@example.com", "individual", True,
                         ts("2028-01-02T08:00:00"), ts("2028-03-15T08:00:00"))
    rows["campaigns"][0] = (1, "Campaign - Updated", "ETL validation campaign.", D("100000.00"), d("2028-01-01"),
                            d("2028-12-31"), "closed", ts("2028-01-01T09:00:00"), ts("2028-03-15T08:00:00"))
    rows["expense_categories"][1] = (2, "Books - Updated", True, ts("2028-01-01T09:00:00"), ts("2028-03-15T08:00:00"))
    rows["donations"].append((104, 1, 1, D("1500.00"), "IRR", "online", d("2028-03-10"), "confirmed", "DON-104",
                              ts("2028-03-10T10:00:00"), None))
    rows["expenses"].append((203, 1, 1, 2, D("200.00"), "IRR", d("2028-03-12"), "March expense.", 10, "approved",
                             ts("2028-03-12T11:00:00"), None))
    rows["payments"].append((303, "bonus", 1002, 1, D("100.00"), "IRR", d("2028-03-20"), "paid",
                             ts("2028-03-20T12:00:00"), None))
    rows["budget_allocations"].append((405, "donation", 104, 1, 1, 2, D("1000.00"), d("2028-03-11"),
                                       "March donation to center 1.", ts("2028-03-11T13:00:00")))
    rows["financial_transactions"] += [
        (504, "donation", 104, "credit", D("1500.00"), d("2028-03-10"), ts("2028-03-10T14:00:00")),
        (505, "expense", 203, "debit", D("200.00"), d("2028-03-12"), ts("2028-03-12T14:00:00")),
        (506, "payment", 303, "debit", D("100.00"), d("2028-03-20"), ts("2028-03-20T14:00:00"))]
    return rows


def sources(spark, rows):
    return {t: schemas.from_rows(spark, t, r) for t, r in rows.items()}


def shared_dims(spark):
    from starloom.plans.dim_date import dim_date_between
    dim_date = dim_date_between(spark, d("2028-01-01"), d("2028-04-30"))
    dim_center = spark.createDataFrame([(-1, -1, "Unknown", True), (1, 1, "Center 1", True), (2, 2, "Center 2", True)],
                                       "center_key int, center_id int, center_name string, is_current boolean")
    dim_child = spark.createDataFrame([(-1, -1, "Unknown"), (1, 1, "Child 1"), (2, 2, "Child 2")],
                                      "child_key int, child_id int, full_name string")
    return {"dim_date": dim_date, "dim_center": dim_center, "dim_child": dim_child}
