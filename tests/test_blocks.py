"""Tables in blocks: against the whole-table upsert, and what a load reads and writes."""

import os
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.loads import hash_upsert
from starloom.plans.blocks import BlockTable, HashBlocks, IdRanges

SCHEMA = "id long, v string, row_hash string, is_valid boolean, seen int"


def rows(spark, data):
    return spark.createDataFrame([(i, v, f"h{v}" if v else None, ok, t) for i, v, ok, t in data], SCHEMA)


def table(spark, root, layout, **kw):
    return BlockTable(spark, str(root), ("id",), layout, row_id="row_id", valid_col="is_valid", **kw)


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("layout", [HashBlocks(7), IdRanges(10)])
def test_like_the_whole_table_upsert(spark, tmp_path, layout):
    rng = random.Random(3)
    t, whole = table(spark, tmp_path, layout), {}
    for load in range(4):
        extract = [(rng.randrange(-20, 60), rng.choice(["a", "b", "c", None]), rng.random() < 0.9, rng.randrange(5)) for _ in range(40)]
        df = rows(spark, extract)
        before = t.read()
        done = t.upsert(df, ("seen",))
        nxt = hash_upsert(before.drop("row_id") if before is not None else None, df, ["id"], order_cols=("seen",))
        got = {r.id: (r.v, r.is_valid, r.seen) for r in t.read().collect()}
        assert got == {r.id: (r.v, r.is_valid, r.seen) for r in nxt.collect()}
        acts = {r.upsert_action: r["count"] for r in nxt.groupBy("upsert_action").count().collect()}
        assert (done.rows_inserted, done.rows_updated) == (acts.get("insert", 0), acts.get("update", 0))
        ids = {r.id: r.row_id for r in t.read().collect()}
        assert sorted(ids.values()) == list(range(1, len(ids) + 1)) and whole.items() <= ids.items()
        whole = ids


def test_a_load_touches_its_blocks_only(spark, tmp_path):
    t = table(spark, tmp_path, IdRanges(1000))
    t.upsert(spark.range(20_000).select("id", F.lit("a").alias("v"), F.lit("h").alias("row_hash"), F.lit(True).alias("is_valid"), F.lit(1).alias("seen")))
    before, folders = files(tmp_path), t.folders()
    assert len(folders) == 20
    # One per cent: 150 changed rows, 50 new ones, 30 unchanged in a block of their own.
    later = spark.range(19_850, 20_050).select("id", F.lit("b").alias("v"), F.lit("k").alias("row_hash"), F.lit(True).alias("is_valid"), F.lit(2).alias("seen"))
    same = spark.range(5_000, 5_030).select("id", F.lit("a").alias("v"), F.lit("h").alias("row_hash"), F.lit(True).alias("is_valid"), F.lit(2).alias("seen"))
    pinned = t.read()
    done = t.upsert(later.unionByName(same))
    assert (done.rows_read, done.rows_inserted, done.rows_updated, done.rows_unchanged) == (230, 50, 150, 30)
    assert done.blocks_read == ("19", "5") and done.blocks_written == ("19", "20") and done.rows_written == 1050
    new = set(files(tmp_path)) - set(before)
    assert {p.split("_block=")[1].split("/")[0] for p in new} == {"19", "20"} and before.items() <= files(tmp_path).items()
    assert {b: f for b, f in t.folders().items() if b not in ("19", "20")} == {b: f for b, f in folders.items() if b != "19"}
    assert t.read().count() == 20_050 and t.read().where("v = 'b'").count() == 200 and pinned.where("v = 'a'").count() == 20_000
    assert t.read().where("seen = 2").count() == 200
    # Blocks that are read by label come from their own files.
    assert all("_block=20/" in p for p in t.read(["20"]).inputFiles()) and t.read(["20"]).count() == 50


def test_a_load_without_changes_writes_nothing(spark, tmp_path):
    t = table(spark, tmp_path, HashBlocks(4))
    df = rows(spark, [(1, "a", True, 1), (2, "b", True, 1)])
    t.upsert(df)
    before, folders = files(tmp_path), t.folders()
    assert t.upsert(df).rows_unchanged == 2 and t.upsert(df.limit(0)).rows_read == 0
    assert files(tmp_path) == before and t.folders() == folders


def test_null_keys_and_invalid_old_rows(spark, tmp_path):
    t = table(spark, tmp_path, HashBlocks(4))
    df = rows(spark, [(None, "a", True, 1), (1, "a", False, 1)])
    t.upsert(df)
    done = t.upsert(rows(spark, [(None, "a", True, 1), (1, "a", True, 1)]))
    assert (done.rows_inserted, done.rows_updated) == (1, 1) and "none" in t.labels()
    assert sorted((r.id is None, r.is_valid, r.row_id) for r in t.read().collect())[0][1] is True and t.read().count() == 3


def test_an_empty_first_load_and_other_columns(spark, tmp_path):
    t = table(spark, tmp_path, HashBlocks(4))
    assert t.read() is None and t.upsert(rows(spark, [])).rows_read == 0 and t.read() is None
    t.upsert(rows(spark, [(1, "a", True, 1)]))
    with pytest.raises(ValueError, match="columns differ"):
        t.upsert(rows(spark, [(2, "a", True, 1)]).withColumn("more", F.lit(1)))
    with pytest.raises(ValueError, match="dealt by"):
        table(spark, tmp_path, HashBlocks(5)).read()


def test_a_failed_load_leaves_the_version_before(spark, tmp_path):
    t = table(spark, tmp_path, HashBlocks(2))
    t.upsert(rows(spark, [(1, "a", True, 1), (2, "a", True, 1)]))
    real = t._write

    def lost(version, out):
        real(version, out)
        raise RuntimeError("lost")
    t._write = lost
    with pytest.raises(RuntimeError, match="lost"):
        t.upsert(rows(spark, [(1, "b", True, 2), (3, "b", True, 2)]))
    assert {(r.id, r.v) for r in t.read().collect()} == {(1, "a"), (2, "a")}
    assert len(t.remove_versions(1)) == 1 and t.read().count() == 2
    t._write = real
    assert t.upsert(rows(spark, [(1, "b", True, 2), (3, "b", True, 2)])).rows_updated == 1
    t.remove_versions(1)
    assert {(r.id, r.v, r.row_id) for r in t.read().collect()} == {(1, "b", 1), (2, "a", 2), (3, "b", 3)}


def test_tags(spark, tmp_path):
    t = table(spark, tmp_path, HashBlocks(2))
    first = t.upsert(rows(spark, [(1, "a", True, 1)]), tag=1)
    assert t.upsert(rows(spark, [(1, "z", True, 9)]), tag=1) == first and t.read().first().v == "a"
    t.upsert(rows(spark, [(1, "b", True, 1)]), tag=2)
    assert t.tag == 2 and t.upsert(rows(spark, [(1, "a", True, 1)]), tag=1).rows_read == 0 and t.read().first().v == "b"


def test_append(spark, tmp_path):
    t = BlockTable(spark, str(tmp_path), ("k", "d"), HashBlocks(3))
    schema, have = "k long, d string, x int", set()
    rng = random.Random(5)
    for load in range(12):
        data = [(rng.choice([None, *range(30)]), rng.choice([None, "p", "q"]), rng.randrange(9)) for _ in range(25)]
        df = spark.createDataFrame(data, schema)
        done = t.append(df, null_safe=True, distinct=True)
        fresh = {(k, d) for k, d, _ in data} - have
        have |= fresh
        assert done.rows_inserted == len(fresh)
        got = [(r.k, r.d) for r in t.read().collect()]
        assert len(got) == len(set(got)) and set(got) == have
        assert all(len(f) <= BlockTable.MAX_FOLDERS for f in t.folders().values())
    # Adding to a block writes its new rows alone.
    done = t.append(spark.createDataFrame([(99, "p", 1)], schema))
    assert done.rows_written == 1 or len(done.blocks_written) == 1
