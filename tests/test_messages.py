"""V3: what rejected rows say, one planted row per rule of each of the 29 tables, and all of a row's texts in their order."""

import datetime as dt
import decimal

import pytest

from pyspark.sql.types import BooleanType, DateType, DecimalType, StringType, TimestampNTZType

from starloom.plans import schemas
from starloom.plans.staging import SOURCE_DATABASE, SPECS, checked_extract

# The texts of all rules but "missing" and plain references, in the order of their table's rules.
TEXTS = {
    "score_scales": ["min_score > max_score; "],
    "child_task_plans": ["end_date IS NOT NULL AND start_date IS NOT NULL AND start_date > end_date; "],
    "assessment_sessions": ["ended_at IS NOT NULL AND started_at IS NOT NULL AND started_at > ended_at; "],
    "task_assessments": ["attempt_no IS NOT NULL AND attempt_no < 1; ",
                         "normalized_score IS NOT NULL AND (normalized_score < 0 OR normalized_score > 100); "],
    "donors": ["donor_type invalid: donor_type NOT IN (individual, organization); "],
    "campaigns": ["target_amount invalid: target_amount < 0; ", "start_date invalid: end_date invalid: start_date > end_date; "],
    "donations": ["amount invalid: amount <= 0; ", "donation_type invalid: donation_type NOT IN (cash, bank_transfer, online, in_kind); ",
                  "status invalid: status NOT IN (pending, confirmed, rejected, refunded); "],
    "expenses": ["amount invalid: amount <= 0; ", "status invalid: status NOT IN (pending, approved, rejected); "],
    "payments": ["amount invalid: amount <= 0; ", "payment_type invalid: payment_type NOT IN (salary, bonus, vendor, refund); ",
                 "status invalid: status NOT IN (pending, approved, paid, cancelled, rejected); "],
    "budget_allocations": ["allocated_amount invalid: allocated_amount <= 0; ", "source_type invalid: source_type NOT IN (donation, internal_budget); ",
                           "source_type = donation AND source_id missing; "],
    "financial_transactions": ["amount invalid: amount <= 0; ", "entity_type invalid: entity_type NOT IN (donation, expense, payment); ",
                               "transaction_type invalid: transaction_type NOT IN (credit, debit); "],
    "currency_rates": ["rate invalid: rate <= 0; "],
}
# One row per text above that breaks this rule and no other.
BREAKS = {
    "score_scales": [{"min_score": 5, "max_score": 2}],
    "child_task_plans": [{"start_date": dt.date(2024, 2, 1), "end_date": dt.date(2024, 1, 1)}],
    "assessment_sessions": [{"started_at": dt.datetime(2024, 1, 2), "ended_at": dt.datetime(2024, 1, 1)}],
    "task_assessments": [{"attempt_no": 0}, {"normalized_score": 101}],
    "donors": [{"donor_type": "robot"}],
    "campaigns": [{"target_amount": -1}, {"start_date": dt.date(2024, 2, 1), "end_date": dt.date(2024, 1, 1)}],
    "donations": [{"amount": 0}, {"donation_type": "gold"}, {"status": "gone"}],
    "expenses": [{"amount": 0}, {"status": "gone"}],
    "payments": [{"amount": -3}, {"payment_type": "gift"}, {"status": "gone"}],
    "budget_allocations": [{"allocated_amount": 0}, {"source_type": "other"}, {"source_id": None}],
    "financial_transactions": [{"amount": 0}, {"entity_type": "thing"}, {"transaction_type": "x"}],
    "currency_rates": [{"rate": 0}],
}


def plain(spec, field, n):
    value = {v[0]: v[1][0] for v in spec.domains}.get(field.name)
    kind = field.dataType
    if value is not None:
        return value
    if isinstance(kind, StringType):
        return "x"
    if isinstance(kind, BooleanType):
        return True
    if isinstance(kind, TimestampNTZType):
        return dt.datetime(2024, 1, 1)
    if isinstance(kind, DateType):
        return dt.date(2024, 1, 1)
    return decimal.Decimal(1) if isinstance(kind, DecimalType) else 1


def typed(fields, row):
    return tuple(decimal.Decimal(v) if v is not None and isinstance(f.dataType, DecimalType) else v for f, v in zip(fields, (row[f.name] for f in fields)))


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_texts(spark, spec):
    fields = schemas.empty(spark, spec.name).schema.fields
    good = {f.name: plain(spec, f, 1) for f in fields}
    rows, want = [good], [None]

    def planted(change, text):
        rows.append({**good, **change})
        want.append(text)
    for c in spec.required:
        # A row without the column of a date watermark is not extracted at all.
        if spec.watermark != f"date:{c}":
            planted({c: None}, f"{'[date]' if c == 'date' else c} missing; ")
    for change, text in zip(BREAKS.get(spec.name, []), TEXTS.get(spec.name, []), strict=True):
        planted(change, text)
    for fk in spec.fks:
        on = {} if fk.when is None else {fk.when[0]: fk.when[1]}
        subject = fk.col if fk.when is None else f"{fk.when[0]} = {fk.when[1]} AND {fk.col}"
        text = f"{subject} invalid reference (SELECT 1 FROM {SOURCE_DATABASE[spec.system]}.{spec.system}.{fk.parent} p WHERE p.id = s.{fk.col})"
        planted({**on, fk.col: 77}, (text if len(text) <= 150 else text[:147] + "...") + "; ")
    # Rows that break nothing, although a value is missing where none is needed.
    if spec.name == "budget_allocations":
        planted({"source_type": "internal_budget", "source_id": None}, None)
        planted({"source_type": "internal_budget", "source_id": 77}, None)
    sources = {p: spark.createDataFrame([(1,)], "id int") for p in {f.parent for f in spec.fks} | {p for _, p in spec.parents}}
    # Every row an own id to find it by, where that is not what is missing; parents are checked by their own watermark elsewhere.
    keyed = [{**r, "id": None if r["id"] is None else i + 1} for i, r in enumerate(rows)]
    frame = spark.createDataFrame([typed(fields, r) for r in keyed], schemas.source_ddl(spec.name))
    if spec.watermark == "parents":
        sources = {p: schemas.from_rows(spark, p, [tuple(typed(schemas.empty(spark, p).schema.fields, {f.name: 1 if f.name == "id" or "_id" in f.name else
                   plain(spec, f, 1) for f in schemas.empty(spark, p).schema.fields}))]) for p in sources}
    checked, _ = checked_extract(spec, {**sources, spec.name: frame}, dt.datetime(2030, 1, 1), 1)
    got = {r["id"]: r["validation_message"] for r in checked.collect()}
    expected = {r["id"]: w for r, w in zip(keyed, want)}
    if spec.watermark == "parents":      # the extract already leaves rows out whose parents are not there
        expected = {i: w for i, w in expected.items() if i in got}
        assert {None, 1} <= set(expected)
    assert got == expected


def test_all_texts_of_a_row_in_order(spark):
    spec = next(s for s in SPECS if s.name == "donations")
    row = (None, 5, None, decimal.Decimal(-1), None, "gold", None, "gone", None, dt.datetime(2024, 1, 1), None)
    parents = {"donors": spark.createDataFrame([(1,)], "id int"), "campaigns": spark.createDataFrame([(1,)], "id int")}
    checked, _ = checked_extract(spec, {**parents, "donations": schemas.from_rows(spark, "donations", [row])}, dt.datetime(2030, 1, 1), 1)
    assert checked.first().validation_message == (
        "id missing; amount invalid: amount <= 0; currency missing; donation_date missing; "
        "donation_type invalid: donation_type NOT IN (cash, bank_transfer, online, in_kind); "
        "status invalid: status NOT IN (pending, confirmed, rejected, refunded); "
        f"donor_id invalid reference (SELECT 1 FROM {SOURCE_DATABASE['finance_ops']}.finance_ops.donors p WHERE p.id = s.donor_id); ")
