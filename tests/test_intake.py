"""References to several parents in one join, and CSV tables with rejects."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom.operators.references import PolymorphicKey, polymorphic_orphans, with_missing_parent
from starloom.sources import csv_rejects as cr

ROWS = [(1, "donation", 5), (2, " Expense ", 64), (3, "expense", 65), (4, "donation", None), (5, None, 7), (6, "gift", 1), (7, "PAYMENT", -1), (8, "payment", -64),
        (9, "donation", 2 ** 40), (10, "expense", 63)]
PARENTS = {"donation": [5, 2 ** 40, None], "expense": [63, 64, 64], "payment": [-64, 0]}


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_missing_parents_in_one_join(spark, kind):
    rows = spark.createDataFrame(ROWS, "row int, t string, i long").withColumn("i", F.col("i").cast(kind))
    parents = {k: (spark.createDataFrame([(i,) for i in v], "id long").withColumn("id", F.col("id").cast(kind)), "id") for k, v in PARENTS.items()}
    got = with_missing_parent(rows, PolymorphicKey("t", "i", parents), "missing")
    assert got.columns == ["row", "t", "i", "missing"] and got.count() == len(ROWS)
    want = {r for r, t, i in ROWS if t and i is not None and t.strip().lower() in PARENTS and i not in PARENTS[t.strip().lower()]}
    assert {r.row for r in got.where("missing").collect()} == want == {3, 7}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") + plan.count("SortMergeJoin") == 1
    told = {r.entity_type: (r.n_rows, r.n_without_id, r.n_orphans) for r in polymorphic_orphans(rows, PolymorphicKey("t", "i", parents)).collect()}
    assert told == {"donation": (3, 1, 0), "expense": (3, 0, 1), "payment": (2, 0, 1), "gift": (1, 0, 1), "": (1, 0, 1)}


def test_every_row_without_a_reference_and_no_parents(spark):
    rows = spark.range(3_000).selectExpr("id as row", "cast(null as string) as t", "cast(null as bigint) as i")
    empty = spark.createDataFrame([], "id long")
    key = PolymorphicKey("t", "i", {"a": (empty, "id")})
    assert with_missing_parent(rows, key, "m").where("m").count() == 0 and with_missing_parent(rows.limit(0), key, "m").count() == 0


DDL = "id int not null, name string, amount decimal(10,2), day date"


def test_rejects_and_reasons(spark, tmp_path):
    folder = str(tmp_path / "csv")
    good = [(1, "a,b", D("1.50"), dt.date(2024, 1, 2)), (2, None, None, None), (3, 'say "hi"', D("-2.00"), dt.date(2024, 2, 29))]
    cr.write_checked({"t": spark.createDataFrame(good, DDL.replace(" not null", ""))}, folder)
    rows, bad = cr.load_table(spark, folder, "t", DDL)
    assert sorted(map(tuple, rows.collect())) == good and bad.count() == 0 and bad.columns == ["table", "line", "reason"]
    lines = ["4,x,1.0,2024-01-01", "y,x,1.0,2024-01-01", "5,x,abc,2024-01-01", "6,x,1.0,2024-13-01", "7,x,1.0", "8,x,1.0,2024-01-01,more", ",x,1.0,2024-01-01", '9,"p,q",oops,']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/u")
    rows, bad = cr.read_checked(spark, folder, "u", DDL, header=False)
    assert [r.id for r in rows.collect()] == [4]
    reasons = {r.line: r.reason for r in bad.collect()}
    assert [reasons.get(x) for x in lines[1:6]] == ["id: not a int", "amount: not a decimal(10,2)", "day: not a date", "3 columns instead of 4", "5 columns instead of 4"]
    assert sorted(reasons.values()).count("id: empty") == 1 and reasons[lines[7]] == "amount: not a decimal(10,2)" and len(reasons) == 7


def test_the_manifest_tells_altered_lines(spark, tmp_path):
    folder = str(tmp_path / "csv")
    cr.write_checked({"t": spark.range(50).selectExpr("id", "id * 2 as v"), "other": spark.range(2)}, folder)
    assert all(r.unchanged for r in cr.check_manifest(spark, folder).collect())
    spark.range(50).selectExpr("id", "if(id = 7, 0, id * 2) as v").write.mode("overwrite").options(**cr.CSV_OPTIONS).csv(f"{folder}/t")
    assert {r.table: r.unchanged for r in cr.check_manifest(spark, folder).collect()} == {"t": False, "other": True}
    with pytest.raises(ValueError, match="do not match"):
        cr.load_table(spark, folder, "t", "id long, v long")
    with pytest.raises(ValueError, match="not in the manifest"):
        cr.load_table(spark, folder, "none", "id long")
