import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import prefix_trie as pt
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, block=100, most=5):
    """The contract by dictionaries of tuples."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % (most + 1)
        first = c - (abs(c) % block) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(first, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            below[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += node not in children
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if rebuilt[c] == node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children.get(node, 0), leaves[node],
                    below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


@given(st.lists(st.binary(max_size=6).map(lambda b: b"".join(bytes([x % 3, x]) for x in b)), unique=True, max_size=300))
@settings(max_examples=60, deadline=None)
def test_tree_walks_in_order_with_shared_prefixes(keys):
    tree = pt.RadixTree()
    for k in keys:
        tree.insert(k, (k,))
    last, seen = b"", []
    for shared, rest, (key,) in tree.walk():
        assert last[:shared] + rest == key
        seen.append(key)
        last = key
    assert seen == sorted(keys)


def test_layouts_grow():
    tree, kinds = pt.RadixTree(), set()
    for k in random.Random(1).sample(range(256), 256):
        tree.insert(bytes([7, 7, k]), (k,))
        kinds.add((type(tree.root).__name__, getattr(tree.root, "size", 0)))
    assert kinds == {("_Sorted", 4), ("_Sorted", 16), ("_Indexed", 0), ("_Direct", 0)}
    assert [v[0] for _, _, v in tree.walk()] == list(range(256)) and tree.root.prefix == b"\x07\x07"


def made(seed, n, words="ab"):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-50, 500), n):
        for t in range(r.choice([1, 1, 2, 3, 4, 6, 9])):
            rows.append((c, t, r.choice(["user", "assistant"]) if t > 1 else "system", "".join(r.choice(words) for _ in range(r.choice([0, 1, 1, 2])))))
    return rows


@pytest.mark.parametrize("keys_per_task", [1, 3, 10, 10_000])
def test_whole_trie_over_any_partitions(spark, keys_per_task):
    rows = made(keys_per_task, 90)
    assert run(spark, rows, keys_per_task=keys_per_task) == plain(rows)


def test_hot_prefix_and_copies(spark):
    rows = [(c, t, "user", x) for c in range(1000, 1400) for t, x in enumerate(["hi"] * 7 + [str(c % 50)])]
    assert run(spark, rows, keys_per_task=7) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, None, None, None), (1, 0, "user", "é" * 3), (101, 0, "user", "b"), (101, 0, "user", "a"),
            (-7, 5, "", ""), (-107, None, "user", "y" * 40_000), (200, 0, "a", "bc"), (201, 0, "ab", "c"), (9_223_372_036_854_775_807, 1, "u", "z")]
    rows += [(77, t, "user", f"t{t % 3}") for t in range(150)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    clash = spark.createDataFrame([(1, 0, "user", "a", 9, "k")], SCHEMA + ", depth int, key string")
    assert pt.prefix_trie(clash).count() == len(plain([(1, 0, "user", "a")]))


def test_query_and_sql(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    got = sorted(map(tuple, pt.op12_conversation_trie(spark, SF_SMALL).select(COLUMNS).collect()), key=str)
    assert got == plain(rows)
    extra = made(5, 60) + [(None, 0, "a", "b"), (3, None, None, "x"), (103, None, "u", None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", extra)
    rel = con.execute(pt.SQL)
    at = [[d[0] for d in rel.description].index(c) for c in COLUMNS]
    assert sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str) == plain(extra)
