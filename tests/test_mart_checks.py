"""Checks of the marts on small tables: flags, grains of spans, differences both ways, column contracts, typed references."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators.intervals import Run, expand, repeated_days
from starloom.operators.validation import ForeignKey, validate
from starloom.plans.contracts import WHOLE, Contract, contract_problems
from starloom.plans.quality import accumulation_problems, flag_problems, one_sided

FLAGS = ("source_daily_task_assignment_id int, source_task_assessment_id int, raw_score double, is_scored int, is_not_scored int, is_refused int, "
         "is_cancelled int, is_incomplete int, is_assessed int")


def test_flag_problems(spark):
    rows = [(1, None, None, 0, 0, 0, 0, 0, 0), (1, 1, 5.0, 1, 0, 0, 0, 0, 1), (2, 2, None, 0, 1, 0, 0, 0, 1),     # as they should be
            (3, 3, 5.0, 1, 1, 0, 0, 0, 1), (4, 4, 5.0, None, 0, 0, 0, 0, 1), (5, 5, None, 1, 0, 0, 0, 0, 1),
            (6, 6, None, 0, 1, 0, 0, 0, None), (7, None, None, 0, 0, 0, 0, 0, 1), (None, None, None, 0, 0, 0, 0, 0, 1)]
    got = {r.check_name: r.problem_count for r in flag_problems(spark.createDataFrame(rows, FLAGS)).collect()}
    assert got == {"scored_and_not_scored": 1, "score_without_flag": 1, "flag_without_score": 1, "not_scored_with_score": 1,
                   "assessment_not_assessed": 1, "plan_assessed": 1, "assessment_unclassified": 1}
    empty = flag_problems(spark.createDataFrame([], FLAGS)).collect()
    assert len(empty) == 7 and not any(r.problem_count for r in empty)


DAY = dt.date(2024, 1, 1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9), st.integers(0, 5), st.integers(1, 2)), max_size=8))
def test_repeated_days_are_those_of_the_expanded_rows(spark, spans):
    runs = [Run(1, DAY, DAY + dt.timedelta(6)), Run(2, DAY + dt.timedelta(4), DAY + dt.timedelta(12))]
    rows = [(g, DAY + dt.timedelta(a), DAY + dt.timedelta(a + n), since) for g, a, n, since in spans]
    df = spark.createDataFrame(rows, "g int, valid_from date, valid_to date, since int")
    seen = Counter((r.g, r.snapshot_date) for r in expand(df, runs).collect())
    assert repeated_days(df, runs, ("g",)).first().n == sum(n - 1 for n in seen.values())


def test_one_sided_is_except_both_ways(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("y", 3), ("w", 4), ("w", 4)], "v string, k int")
    want = a.subtract(b.select("k", "v")).count() + b.select("k", "v").subtract(a).count()
    assert one_sided(a, b).first().problem_count == want == 3
    assert one_sided(a, a).first().problem_count == 0
    assert one_sided(a.limit(0), a.limit(0)).first().problem_count == 0


def test_accumulation_problems(spark):
    g = "child_id int, center_id int, teacher_id int, "
    counts = "planned_task_count int, assessment_count int, completed_task_count int, scored_task_count int"
    acc = spark.createDataFrame([(1, 1, None, 2, 1, 1, 1, 20240101, 20240103, 20240103, 20240103), (2, 1, 1, 1, 0, 0, 0, -1, -1, None, None)],
                                g + counts + ", first_plan_date_key int, last_plan_date_key int, first_assessment_date_key int, last_assessment_date_key int")
    day = spark.createDataFrame([(1, 1, -1, 2, 1, 1, 1), (2, 1, 1, 1, 0, 0, 0)], g + counts)
    fact = spark.createDataFrame([(1, 1, None, 20240101, 5, None), (1, 1, None, 20240103, 6, 9), (2, 1, 1, None, 7, None)],
                                 g + "date_key int, source_daily_task_assignment_id int, source_task_assessment_id int")
    assert [r.problem_count for r in accumulation_problems(acc, day, fact).collect()] == [0, 0]
    worse = acc.withColumn("scored_task_count", F.lit(7)).where("child_id = 1")
    assert [r.problem_count for r in accumulation_problems(worse, day, fact).collect()] == [3, 1]


def test_contract_names_types_and_what_must_not_be_there(spark):
    df = spark.createDataFrame([], "a bigint, b int, c string, d decimal(18,2)")
    assert contract_problems(df, Contract({"a": WHOLE, "b": WHOLE, "c": "string", "d": "decimal(18,2)"})) == []
    found = contract_problems(df, Contract({"a": "string", "e": WHOLE}, ("c",)))
    assert found == ["a: bigint instead of string", "e: missing", "b: must not be there", "c: must not be there", "d: must not be there"]
    assert contract_problems(df, Contract({"a": WHOLE}, ("c",), closed=False)) == ["c: must not be there"]


def test_typed_references_in_one_join(spark):
    x = spark.createDataFrame([(1, " Car ", 7), (2, "car", 8), (3, "SHIP", 8), (4, "ship", 7), (5, "ship", None), (6, None, 7), (7, "kite", 7)],
                              "id int, kind string, ref int")
    parents = {"car": spark.createDataFrame([(7,), (7,)], "id int"), "ship": spark.createDataFrame([(8,), (None,)], "id int")}
    fks = [ForeignKey("ref", p, "id", f"no {code}; ", F.lower(F.trim("kind")) == code, ("kind", code)) for code, p in parents.items()]
    out = validate(x, [], fks)
    assert {r.id: r.validation_message for r in out.collect()} == {1: None, 2: "no car; ", 3: None, 4: "no ship; ", 5: None, 6: None, 7: None}
    assert out.columns == ["id", "kind", "ref", "is_valid", "validation_message"]
    plain = validate(x, [], [ForeignKey(k.col, k.parent, k.parent_col, k.message, k.when) for k in fks])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    # Both parents are read by one join.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
