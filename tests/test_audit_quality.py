"""Audit records (Q1-Q3) and the schema/validity checks (Q12, Q14)."""

import datetime as dt

import pytest

from starloom.plans.audit import BatchLog, assert_tables, run_logged
from starloom.plans.quality import invalid_staged_rows, schema_contract


def test_batch_log_success_and_failure(spark):
    log = BatchLog(spark, "FINANCE_OPS", "DW", "FINANCE_MART2", dt.datetime(2028, 3, 1), batch_id=4)
    log.step("donations", "fact_donation_transaction", 3, 3)
    with pytest.raises(ZeroDivisionError):
        run_logged(log, "broken_step", lambda: 1 / 0)
    batch, steps = log.frames()
    b = batch.collect()[0]
    assert b.batch_status == "failed" and "division" in b.error_message and b.rows_read == 3
    assert [r.load_status for r in steps.orderBy("load_log_id").collect()] == ["succeeded", "failed"]


def test_prerequisites(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(3).write.parquet(p)
    assert_tables(spark, {"t": p})
    with pytest.raises(RuntimeError, match="missing prerequisite tables: nope"):
        assert_tables(spark, {"t": p, "nope": str(tmp_path / "missing")})


def test_schema_contract_and_validity(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "id int, is_valid boolean")
    assert schema_contract(df, ["id", "is_valid"], ["source_table"]) == []
    assert schema_contract(df, ["date_key"], ["id"]) == ["missing column date_key", "unexpected column id"]
    assert invalid_staged_rows(df).collect()[0].n_invalid == 1


def test_documented_dq(spark):
    from decimal import Decimal as D

    from starloom.plans.quality import documented_dq
    from tests import finance_fixture as ffx
    from tests import program_fixture as pfx
    prog_rows = pfx.day2_rows()
    prog_rows["children"].append((9, 77, "X", "Y", None, None, None, None, "active", pfx.T0, None))
    prog_rows["task_assessments"].append((9, 1, 1, 1, 1, pfx.d("2027-05-02"), D("11.00"), None, "scored", None, 1,
                                          None, pfx.T0, None))
    fin_rows = ffx.first_load_rows()
    fin_rows["donations"].append((199, 1, 1, D("-5.00"), "IRR", "cash", ffx.d("2028-01-09"), "confirmed", None,
                                  ffx.ts("2028-01-09T10:00:00"), None))
    got = {r.check_name: r.problem_count
           for r in documented_dq(pfx.sources(spark, prog_rows), ffx.sources(spark, fin_rows)).collect()}
    assert got == {"child_without_center": 1, "non_positive_donation": 1, "score_outside_scale": 1}


def test_a_failing_mart_step_leaves_a_record(spark):
    from starloom.plans import mart1
    log = BatchLog(spark, "PROGRAM_OPS", "DW", "MART1", dt.datetime(2028, 3, 1), batch_id=9)
    with pytest.raises(KeyError):  # no staging tables at all
        mart1.run_mart1(spark, {}, {"dim_date": spark.range(1)}, dt.datetime(2028, 1, 1), dt.datetime(2028, 2, 1), log=log)
    batch, steps = log.frames()
    assert [(r.target_table, r.load_status) for r in steps.collect()] == [("dimensions", "failed")]
    assert batch.first().batch_status == "failed"
