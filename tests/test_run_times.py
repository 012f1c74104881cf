"""Large staging runs read a parent about once and write a row that stays once: the same rows in less time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import keys
from starloom.plans import staging
from starloom.plans.staging import run_staging

DAY = dt.datetime(2020, 1, 1)


def _donors(spark, ids, title, updated=DAY):
    return spark.range(*ids).select(F.col("id").cast("int").alias("id"), F.concat(F.lit(title), F.col("id") % 3).alias("full_name"), *[
        F.lit(None).cast("string").alias(c) for c in ("national_id", "phone", "email")], F.lit("individual").alias("donor_type"),
        F.lit(True).alias("is_active"), F.lit(DAY).cast("timestamp_ntz").alias("created_at"), F.lit(updated).cast("timestamp_ntz").alias("updated_at"))


def _donations(spark, n, donor):
    none = F.lit(None).cast("string")
    return spark.range(n).select(
        "id", donor.cast("int").alias("donor_id"), F.lit(None).cast("int").alias("campaign_id"), F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"), F.lit("online").alias("donation_type"), F.lit(DAY.date()).alias("donation_date"), F.lit("pending").alias("status"),
        none.alias("reference_code"), F.lit(DAY).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))


@pytest.mark.parametrize("falling", [False, True])
def test_a_range_meets_the_part_of_a_large_parent_that_it_asks_for(spark, monkeypatch, falling):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 20)
    monkeypatch.setattr(staging, "PARENT_BROADCAST_MAX_ROWS", 5)
    read, real = [], staging.validate

    def watched(rows, rules, fks):
        read.append(next(fk.parent.count() for fk in fks if fk.col == "donor_id"))
        return real(rows, rules, fks)
    monkeypatch.setattr(staging, "validate", watched)
    # Donors 0 to 99 without every tenth; donations without a donor and with one that is not there.
    donors = _donors(spark, (0, 100), "n").filter("id % 10 <> 9")
    donor = F.when(F.col("id") % 7 != 3, 99 - F.col("id") if falling else F.col("id"))
    donations = _donations(spark, 100, donor)
    out, log = run_staging(spark, "finance_ops", {"donors": donors, "campaigns": spark.createDataFrame([], "id int"), "donations": donations}, {}, DAY,
                           specs=("donations",))
    good = [i for i in range(100) if i % 7 != 3 and (99 - i if falling else i) % 10 != 9]
    assert [r.id for r in out["donations"].orderBy("id").collect()] == good
    assert (log.first().rows_read, log.first().rows_valid) == (100, len(good))
    assert len(read) == 5 and sum(read) <= 90       # each range read all 90 before


def test_a_range_without_references_meets_no_parent(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 25)
    rows = spark.range(100).select("id", F.when(F.col("id") >= 60, F.col("id")).cast("int").alias("to"))
    fk = staging.ForeignKey("to", spark.range(200), "id")
    met = staging._met(rows, "id", keys.key_ranges(rows, "id", 100), [fk], [0])
    asked = [sorted(r.id for r in mine.parent.collect()) for mine, in met]
    assert asked[0] == [] and asked[-1][-1] == 99 and sorted(i for part in asked for i in part) == list(range(60, 100))


def test_rows_that_stay_are_written_once(spark, monkeypatch):
    for module in (keys, staging):
        monkeypatch.setattr(module, "SMALL_MAX_ROWS", 0)
    monkeypatch.setattr(staging, "SPECS", [staging.replace(staging.SPEC_BY_NAME["donors"], load="upsert")])
    old, _ = run_staging(spark, "finance_ops", {"donors": _donors(spark, (1, 101), "n")}, {}, DAY, 1)
    written, real = [], staging._cut_staged

    def watched(parts, cols):
        out = real(parts, cols)
        written.append(out.count())
        return out
    monkeypatch.setattr(staging, "_cut_staged", watched)
    later = dt.datetime(2020, 2, 1)
    new = _donors(spark, (51, 80), "n").unionByName(_donors(spark, (80, 141), "m", later))
    out, log = run_staging(spark, "finance_ops", {"donors": new}, old, later, 2)
    assert (log.first().rows_inserted, log.first().rows_updated) == (40, 21)
    rows = out["donors"].orderBy("id").collect()
    assert [(r.id, r.stg_row_id) for r in rows] == [(i, i) for i in range(1, 141)]
    assert [r.full_name[0] for r in rows] == ["n"] * 79 + ["m"] * 61 and [r.etl_batch_id for r in rows] == [1] * 79 + [2] * 61
    assert sum(written) == 140      # 240 before: the rows that stay were written twice
