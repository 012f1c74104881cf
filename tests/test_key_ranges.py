"""Work that is done range by range: the same rows and keys, with less on the disk at a time."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from starloom.operators import keys
from starloom.operators.keys import KeyRange, assign_keys, key_ranges
from starloom.plans.staging import run_staging
from starloom.session import cut_in_parts, cut_lineage, discard, ensure_checkpoint_dir, holding


def _held(spark):
    return {n for n in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if n.startswith("work-")}


def _size(spark, names):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(at, f)) for n in names for at, _, files in os.walk(os.path.join(root, n)) for f in files)


@pytest.mark.parametrize("values", [[None, None, 1, 1, 1, 5, 6, 7, 900], [3] * 9, [None] * 9, [1, -(1 << 31), (1 << 31) - 1] * 3])
def test_every_key_is_in_one_range(spark, monkeypatch, values):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 2)
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k int, i int")
    ranges = key_ranges(df, "k", len(values))
    assert len(ranges) <= keys.MOST_RANGES
    parts = [r.of(df, "k").collect() for r in ranges]
    assert sorted(r.i for p in parts for r in p) == list(range(len(values)))
    seen = [r.k for p in parts for r in sorted(p, key=lambda r: (r.k is not None, r.k or 0))]
    assert seen == sorted(values, key=lambda v: (v is not None, v or 0))


def test_few_rows_and_texts_are_one_range(spark):
    assert key_ranges(spark.range(10), "id", 10) == [KeyRange()]
    assert key_ranges(spark.range(10).select(F.col("id").cast("string").alias("id")), "id", 10 ** 9) == [KeyRange()]


def test_keys_by_ranges_are_those_of_one_sort(spark, monkeypatch):
    monkeypatch.setattr(keys, "SMALL_MAX_ROWS", 0)
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 100)
    rows = cut_lineage(spark.range(1_000).select(F.when(F.col("id") % 50 > 0, F.col("id") * 7919 % 400).alias("k"), F.col("id").alias("x")))
    before = _held(spark)
    keyed = assign_keys(rows, ["k"], "n", base=5, known_rows=1_000, stored=True)
    assert len(_held(spark) - before) > 1
    got = [(r.k, r.x, r.n) for r in keyed.orderBy("n").collect()]
    want = sorted(((r.k, r.x) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == [(k, x, 5 + i) for i, (k, x) in enumerate(want, 1)]
    discard(keyed)
    assert _held(spark) == before
    discard(rows)


def test_parts_are_written_one_after_the_other(spark):
    before, made = _held(spark), []

    def part(i):
        made.append(len(_held(spark) - before))
        return spark.range(i * 10, i * 10 + 10)
    rows = cut_in_parts(part(i) for i in range(3))
    assert made == [0, 1, 2] and sorted(r.id for r in rows.collect()) == list(range(30))
    discard(holding(rows.filter("id > 3"), rows))
    assert _held(spark) == before


def test_sorted_ids_take_little_room(spark):
    before = _held(spark)
    rows = cut_lineage(spark.range(100_000).select((F.col("id") * 1000).alias("id"), F.monotonically_increasing_id().alias("place")))
    assert _size(spark, _held(spark) - before) < 1.5 * 100_000
    discard(rows)


def test_work_tables_hold_every_kind_of_column(spark):
    n = F.col("id")
    rows = spark.range(3_000).select(
        (n % 100).cast("tinyint").alias("a"), n.cast("smallint").alias("b"), n.cast("int").alias("c"), (n % 7 == 0).alias("d"), (n / 7).cast("float").alias("e"),
        (n / 3).alias("f"), n.cast("decimal(9,2)").alias("g"), (n * 7919).cast("decimal(18,2)").alias("h"), (n * 7919).cast("decimal(38,4)").alias("i"),
        n.cast("string").alias("j"), n.cast("string").cast("binary").alias("k"), F.date_add(F.lit(dt.date(1900, 1, 1)), n.cast("int")).alias("l"),
        F.timestamp_seconds(n * 86_399).alias("m"), F.timestamp_seconds(-n).cast("timestamp_ntz").alias("n"), F.array(n, n + 1).alias("o"),
        F.struct(n.cast("string").alias("x"), n.alias("y")).alias("p"), F.create_map(n.cast("string"), n).alias("q"))
    rows = rows.withColumns({c: F.when(F.col("f") > 100, F.col(c)) for c in rows.columns if c != "f"})
    kept = cut_lineage(rows)
    assert kept.dtypes == rows.dtypes and sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    discard(kept)


def test_a_large_table_is_checked_range_by_range(spark, monkeypatch):
    from starloom.plans import staging
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 20)
    monkeypatch.setattr(staging, "PARENT_BROADCAST_MAX_ROWS", 5)
    day = dt.datetime(2020, 1, 1)
    when = [F.lit(day).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at")]
    donors = spark.range(1, 41).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("full_name"), *[
        F.lit(None).cast("string").alias(c) for c in ("national_id", "phone", "email")], F.lit("individual").alias("donor_type"), F.lit(True).alias("is_active"), *when)
    campaigns = spark.createDataFrame([], "id int")
    donations = spark.range(100).select(
        F.when(F.col("id") > 2, F.col("id")).alias("id"), (F.col("id") % 50).cast("int").alias("donor_id"), F.lit(None).cast("int").alias("campaign_id"),
        F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("USD").alias("currency"), F.lit("online").alias("donation_type"),
        F.lit(day.date()).alias("donation_date"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("reference_code"), *when)
    written, real = [], staging.validate

    def watched(x, *args):
        written.append(x)
        return real(x, *args)
    monkeypatch.setattr(staging, "validate", watched)
    out, log = run_staging(spark, "finance_ops", {"donors": donors, "campaigns": campaigns, "donations": donations}, {}, day, specs=("donations",))
    assert len(written) > 1
    good = [i for i in range(3, 100) if 1 <= i % 50 <= 40]
    assert (log.first().rows_read, log.first().rows_valid) == (100, len(good))
    assert [(r.id, r.stg_row_id) for r in out["donations"].orderBy("id").collect()] == [(i, n) for n, i in enumerate(good, 1)]


def test_an_upsert_by_ranges_is_the_whole_upsert(spark, monkeypatch):
    from dataclasses import replace

    from starloom.plans import staging
    monkeypatch.setattr(staging, "SPECS", [replace(staging.SPEC_BY_NAME["donors"], load="upsert")])
    first_day, second_day = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1)

    def donors(ids, title, updated):
        return spark.range(*ids).select(F.col("id").cast("int").alias("id"), F.concat(F.lit(title), F.col("id") % 3).alias("full_name"), *[
            F.lit(None).cast("string").alias(c) for c in ("national_id", "phone", "email")], F.lit("individual").alias("donor_type"),
            F.lit(True).alias("is_active"), F.lit(first_day).cast("timestamp_ntz").alias("created_at"), F.lit(updated).cast("timestamp_ntz").alias("updated_at"))

    def loaded():
        old, _ = run_staging(spark, "finance_ops", {"donors": donors((1, 101), "n", first_day)}, {}, first_day, 1)
        new = donors((51, 80), "n", first_day).unionByName(donors((80, 141), "m", second_day))
        before = _held(spark)
        out, log = run_staging(spark, "finance_ops", {"donors": new}, old, second_day, 2)
        return [tuple(r) for r in out["donors"].orderBy("id").collect()], log.drop("load_log_id").first(), len(_held(spark) - before)
    whole, log, _ = loaded()
    moved, real = [], staging.hash_upsert

    def watched(*args, **kwargs):
        moved.append(1)
        return real(*args, **kwargs)
    monkeypatch.setattr(staging, "hash_upsert", watched)
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 20)
    ranged, log_ranged, left = loaded()
    assert len(moved) > 1 and ranged == whole and log_ranged == log and left == 1
    assert (log.rows_inserted, log.rows_updated) == (40, 21)


def test_typed_references_are_checked_by_ranges_of_the_reference(spark, monkeypatch):
    from starloom.plans import staging
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 20)
    monkeypatch.setattr(staging, "PARENT_BROADCAST_MAX_ROWS", 5)
    day = dt.datetime(2020, 1, 1)
    parents = {"donations": spark.range(0, 40), "expenses": spark.range(20, 1_000), "payments": spark.range(-5, 3)}
    n = F.col("id")
    moves = spark.range(100).select(
        n, F.when(n % 3 == 0, "donation").when(n % 3 == 1, " Expense").otherwise("payment").alias("entity_type"), F.when(n != 50, n - 10).alias("entity_id"),
        F.lit("credit").alias("transaction_type"), F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit(day.date()).alias("transaction_date"),
        F.lit(day).cast("timestamp_ntz").alias("created_at"))
    met, real = [], staging.validate

    def watched(x, rules, fks):
        met.append((x.count(), sum(fk.parent.count() for fk in fks)))
        return real(x, rules, fks)
    monkeypatch.setattr(staging, "validate", watched)
    before = _held(spark)
    _, log = run_staging(spark, "finance_ops", {"financial_transactions": moves, **parents}, {}, day, specs=("financial_transactions",))
    assert len(met) > 1 and sum(rows for rows, _ in met) == 100 and max(ids for _, ids in met) < 100
    there = [range(0, 40), range(20, 1_000), range(-5, 3)]
    good = [i for i in range(100) if i != 50 and i - 10 in there[i % 3]]
    # A missing id is reported by the required columns.
    assert (log.first().rows_read, log.first().rows_valid) == (100, len(good))
    assert len(_held(spark) - before) == 1      # the staged rows; the parents' ids are gone


def test_an_extract_goes_range_by_range_as_it_is_numbered(spark, monkeypatch):
    from starloom.plans import staging
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 30)
    monkeypatch.setattr(keys, "SMALL_MAX_ROWS", 0)
    monkeypatch.setattr(staging, "SMALL_MAX_ROWS", 0)
    monkeypatch.setattr(staging, "ONE_AT_A_TIME_ROWS", 10)
    day = dt.datetime(2020, 1, 1)
    n = F.col("id")
    payments = spark.range(200).select(
        (n * 7 % 200).alias("id"), F.lit("vendor").alias("payment_type"), F.lit(None).cast("int").alias("teacher_id"), F.lit(1).alias("center_id"),
        (n % 10).cast("decimal(18,2)").alias("amount"), F.lit("USD").alias("currency"), F.lit(day.date()).alias("payment_date"), F.lit("paid").alias("status"),
        F.lit(day).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    held = []
    before, sort = _held(spark), staging.assign_keys

    def watched(*args, **kwargs):
        written = kwargs["written"]

        def told(i):
            written(i)
            held.append(len(_held(spark) - before))
        assert len(kwargs["parts"]) > 2
        return sort(*args, **{**kwargs, "written": told})
    monkeypatch.setattr(staging, "assign_keys", watched)
    out, log = run_staging(spark, "finance_ops", {"payments": payments}, {}, day, specs=("payments",))
    assert set(held[1:]) == {held[0]}           # a range is written, the extract's is removed
    good = sorted(i * 7 % 200 for i in range(200) if i % 10)
    assert (log.first().rows_read, log.first().rows_valid) == (200, 180)
    assert [(r.id, r.stg_row_id) for r in out["payments"].orderBy("stg_row_id").collect()] == [(i, k) for k, i in enumerate(good, 1)]
    # Of a repeated id the latest row is staged, whatever the ranges.
    monkeypatch.setattr(staging, "assign_keys", sort)
    later = payments.where("id < 5").withColumns({"updated_at": F.lit(day).cast("timestamp_ntz"), "amount": F.lit(99).cast("decimal(18,2)")})
    out, _ = run_staging(spark, "finance_ops", {"payments": payments.unionByName(later)}, {}, day, specs=("payments",))
    assert out["payments"].where("id < 5").select("amount").distinct().collect()[0][0] == 99 and out["payments"].where("id < 5").count() == 5


def test_a_finance_run_by_ranges_is_the_whole_run(spark, monkeypatch):
    from starloom.plans import bind_marts, mart2, staging
    names = ("dim_donor", "dim_currency", "fact_donation_transaction", "fact_expense_transaction", "fact_payment_transaction",
             "fact_budget_allocation_event", "fact_source_load_map", "fact_donation_lifecycle", "fact_monthly_financial_snapshot")

    def rows():
        monkeypatch.setattr(bind_marts, "_RUNS", {})
        out = bind_marts.finance_run(spark, "/root/testdata/sf0.001")
        return {n: sorted(map(str, out[n].select(*sorted(out[n].columns)).collect())) for n in names}
    whole = rows()
    for module, name, value in ((keys, "ROWS_PER_RANGE", 40), (keys, "SMALL_MAX_ROWS", 0), (staging, "SMALL_MAX_ROWS", 0), (staging, "ONE_AT_A_TIME_ROWS", 10),
                                (staging, "PARENT_BROADCAST_MAX_ROWS", 5), (mart2, "ROWS_PER_TASK", 10)):
        monkeypatch.setattr(module, name, value)
    gone, parts, real = [], [], mart2._lifecycle_rows
    run = mart2.run_mart2

    def watched(*args, **kwargs):
        spent = kwargs["spent"]
        return run(*args, **{**kwargs, "spent": lambda n: (gone.append(n), spent(n))})

    def lifecycle(*args):
        parts.append(sorted(gone))
        return real(*args)
    monkeypatch.setattr(bind_marts, "run_mart2", watched)
    monkeypatch.setattr(mart2, "_lifecycle_rows", lifecycle)
    ranged = rows()
    assert len(parts) > 1 and set(map(tuple, parts)) == {("expenses", "payments")}
    for name in names:
        assert ranged[name] == whole[name], name
