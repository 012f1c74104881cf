"""Property tests of the stateful operators against plain-Python models."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash
from starloom.operators.keys import assign_keys
from starloom.operators.loads import hash_upsert
from starloom.operators.scd import scd2_merge

CFG = dict(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def scd2_model(runs):
    """Versions as (key, nk, attr, from, to, current) after applying each run's {nk: attr}."""
    versions, key = [], 0
    for i, run in enumerate(runs):
        start, end = T[i], T[i + 1]
        current = {v[1]: v for v in versions if v[5]}
        new = []
        for nk in sorted(run):
            cur = current.get(nk)
            if cur is None or cur[2] != run[nk]:
                if cur is not None:
                    versions[versions.index(cur)] = cur[:4] + (end, False)
                new.append(nk)
        for nk in new:
            key += 1
            versions.append((key, nk, run[nk], start if i == 0 else end, None, True))
    return sorted(versions)


@settings(**CFG)
@given(st.lists(st.dictionaries(st.integers(0, 6), st.sampled_from("abc"), min_size=0, max_size=6),
                min_size=1, max_size=4))
def test_scd2_runs_match_model(spark, runs):
    dim = None
    for i, run in enumerate(runs):
        src = spark.createDataFrame(sorted(run.items()), "nk int, attr string").withColumn("h", row_hash("attr"))
        dim = scd2_merge(dim, src, ["nk"], "k", "h", T[i], T[i + 1])
    got = sorted((r.k, r.nk, r.attr, r.effective_from, r.effective_to, r.is_current) for r in dim.collect())
    assert got == scd2_model(runs)


@settings(**CFG)
@given(st.dictionaries(st.integers(0, 20), st.tuples(st.sampled_from("xyz"), st.booleans()), max_size=12),
       st.dictionaries(st.integers(0, 20), st.sampled_from("xyz"), max_size=12))
def test_hash_upsert_matches_model(spark, old, new):
    o = spark.createDataFrame([(k, h, valid) for k, (h, valid) in old.items()],
                              "id int, row_hash string, is_valid boolean")
    n = spark.createDataFrame([(k, h, True) for k, h in new.items()], "id int, row_hash string, is_valid boolean")
    for limit in (None, 1_000_000):           # shuffle path, then the broadcast path
        got = {r.id: (r.row_hash, r.upsert_action)
               for r in hash_upsert(o, n, ["id"], broadcast_max_rows=limit).collect()}
        assert got == _upsert_model(old, new)


def _upsert_model(old, new):
    want = {}
    for k in set(old) | set(new):
        if k not in old:
            want[k] = (new[k], "insert")
        elif k in new and (old[k][0] != new[k] or not old[k][1]):
            want[k] = (new[k], "update")
        else:
            want[k] = (old[k][0], "unchanged")
    return want


@settings(**CFG)
@given(st.sets(st.integers(-1000, 1000), max_size=300), st.integers(0, 50), st.integers(1, 9))
def test_assign_keys_is_row_number(spark, nks, base, parts):
    df = spark.createDataFrame([(x,) for x in nks], "nk int").repartition(3)
    for kw in ({"num_partitions": parts}, {}):            # distributed path, then the checked small path
        got = sorted((r.nk, r.k) for r in assign_keys(df, ["nk"], "k", base=base, **kw).collect())
        assert got == [(nk, base + i + 1) for i, nk in enumerate(sorted(nks))]


@given(old=st.lists(st.tuples(st.integers(1, 5), st.sampled_from("ab")), max_size=5, unique_by=lambda x: x[0]),
       new=st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 7)), st.sampled_from("abc"), st.integers(0, 3)), max_size=8))
@settings(max_examples=12, deadline=None)
def test_hash_upsert_with_repeated_and_null_ids(spark, old, new):
    """Repeats in the extract never multiply rows, whichever way the joins run."""
    o = spark.createDataFrame([(i, h, 0, True) for i, h in old], "id long, row_hash string, seq int, is_valid boolean")
    n = spark.createDataFrame([(i, h, s, True) for i, h, s in new], "id long, row_hash string, seq int, is_valid boolean")
    want = {i: (h, "unchanged") for i, h in old}
    for i in {i for i, _, _ in new if i is not None}:
        h = max((s, h) for k, h, s in new if k == i)[1]
        if i not in want:
            want[i] = (h, "insert")
        elif want[i][0] != h:
            want[i] = (h, "update")
    nulls = sorted(h for i, h, _ in new if i is None)
    for limit in (0, 100):
        got = hash_upsert(o, n, ["id"], order_cols=("seq",), broadcast_max_rows=limit).collect()
        assert {r.id: (r.row_hash, r.upsert_action) for r in got if r.id is not None} == want
        assert len(got) == len(want) + len(nulls) and sorted(r.row_hash for r in got if r.id is None) == nulls
