import re

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, epochs=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = epochs * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] <= share * weight[s]]
        if not full:
            return out | {s: share * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 40}, {"a": 0, "b": 10}, {"é": 7, "z": 9, "Z": 11, "": 3}, {None: 5}])
def test_targets_match_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_takes_each_sources_target(docs_of):
    rows = [(i, "w " * (i % 17), None, ["a", "b", "b", "b", None][i % 5]) for i in range(300)] + [(7, "w " * 7, None, "b")] * 3
    rows += [(None, None, None, "b"), (None, "x y", None, "a")]
    got = mixing.curriculum_mix(docs_of(rows, clash=True)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.taken == sum(p.words for p in r.placements) and all(0 <= p.position <= 1 for p in r.placements)
    want = plain_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - target[s]) <= 1
    again = mixing.curriculum_mix(docs_of(rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("schedule", [(1.0, 1.0), (0.5, 1.0, 1.5), (2.0, 0.0), (0.0, 1.0, 0.0)])
def test_training_time_inverts_the_integral(spark, schedule):
    """Integrating the schedule up to the returned moment gives back the demand."""
    df = spark.range(101).select((F.col("id") / 100).alias("x"))
    h = 1 / (len(schedule) - 1)
    area = sum((a + b) / 2 * h for a, b in zip(schedule, schedule[1:], strict=False))
    last = -1.0
    for x, t in df.select("x", mixing.training_time(F.col("x"), schedule)).orderBy("x").collect():
        done = 0.0
        for k, (a, b) in enumerate(zip(schedule, schedule[1:], strict=False)):
            part = min(max(t - k * h, 0), h)
            done += a * part + (b - a) / h * part * part / 2
        assert abs(done / area - x) < 1e-6 and t >= last - 1e-9
        last = t


def test_training_rows_are_in_order_and_whole(docs_of):
    rows = [(i, "w " * (1 + i % 9), "en", "ab"[i % 2]) for i in range(120)] + [(None, "null id", "en", "a"), (5, None, None, None)]
    docs = docs_of(rows, clash=True)
    out = mixing.training_rows(docs)
    assert out.columns == [*docs.columns, "mix_copy_", "mix_words", "mix_position"]
    got = out.collect()
    positions = [r.mix_position for r in got]
    assert positions == sorted(positions)
    plan = {}
    for r in mixing.curriculum_mix(docs).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.taken
    taken = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.mix_words
        assert (r.doc_id, r.text, r.lang, r.source) in rows
    assert taken == {k: v for k, v in plan.items() if v}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    want = con.execute(mixing.SQL_TEMPLATE.format(docs=f"'{SF_SMALL}/documents.parquet'")).df().sort_values("doc_id")
    got = mixing.op3_mix_curriculum(spark, SF_SMALL).toPandas().sort_values("doc_id")
    assert got.to_dict("list") == want[got.columns].to_dict("list")


def test_empty_table(docs_of):
    assert mixing.curriculum_mix(docs_of([])).count() == 0 and mixing.training_rows(docs_of([])).count() == 0
