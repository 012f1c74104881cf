import random
import re

import numpy as np
import pytest

from starloom.llm import dedup
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(UPPER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def plain(rows, percent=75):
    """All pairs and union-find. Rows with one id are one document."""
    ids = [i for i, _ in rows]
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if not sets[i] or not sets[j] or ids[i] is None or ids[j] is None:
                continue
            both = len(sets[i] & sets[j])
            if ids[i] == ids[j] or 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return sorted(((ids[i], len(sets[i]), least.get(find(i)) if sets[i] else ids[i]) for i in range(len(rows))), key=str)


def check(docs_of, rows):
    got = dedup.near_duplicates(docs_of(rows, clash=True)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def mutate(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"m{rng.randrange(10 ** 6)}"
    return words


def corpus(seed, families, size=(40, 160)):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(50)]
    texts = []
    for _ in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(*size))]
        texts.append(base)
        texts += [mutate(rng, base, rng.randint(0, 4)) for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.5:
            texts.append(passage + [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(5, 60))])
    return [(i, " ".join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_all_pairs(docs_of, seed):
    check(docs_of, corpus(seed, 40))


def test_buckets_of_many_components(docs_of, monkeypatch):
    """A common passage puts unlike documents into one bucket: blocks of a few members must still find every link."""
    monkeypatch.setattr(dedup, "BLOCK", 4)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for _ in range(14):
        own = [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(4, 14))]
        rows += [passage + own, mutate(rng, passage + own, 1), passage + own + [f"z{rng.randrange(10 ** 6)}"]]
    check(docs_of, [(100 - i, " ".join(w)) for i, w in enumerate(rows)])


def test_cells_whose_sketches_mislead(docs_of, monkeypatch):
    """With a sketch test that lets nearly all pairs pass, pairs that are no links join a cell's components at first; every link between them must
    still be found, and sets are only made for documents of such cells."""
    monkeypatch.setattr(dedup, "BLOCK", 8)
    monkeypatch.setattr(dedup, "LEAST_EQUAL", 40)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for _ in range(18):
        own = [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(8, 25))]
        rows += [passage + own, mutate(rng, passage + own, 1), [*passage, *own, f"z{rng.randrange(10 ** 6)}"]]
    made = []
    whole = dedup._full_sets

    def counted(ids, docs):
        made.append(ids.distinct().count())
        return whole(ids, docs)
    monkeypatch.setattr(dedup, "_full_sets", counted)
    check(docs_of, [(200 - i, " ".join(w)) for i, w in enumerate(rows)])
    assert len(made) == 3, "star links, links of cells, and cells with wrong pairs"


def test_unlike_documents_of_one_bucket_make_no_sets(docs_of, monkeypatch):
    """A thousand documents that share one band and no more: cells carry sketches, and no document's set is made for them."""
    monkeypatch.setattr(dedup, "BLOCK", 64)
    made, whole = [], dedup._full_sets

    def counted(ids, docs):
        made.append(ids.distinct().count())
        return whole(ids, docs)
    monkeypatch.setattr(dedup, "_full_sets", counted)
    keys = dedup.band_keys
    monkeypatch.setattr(dedup, "band_keys", lambda sig: np.concatenate([np.full((len(sig), 1), 7, np.uint64), keys(sig)[:, 1:]], axis=1))
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(20))) for i in range(1000)]
    docs = docs_of(rows)
    signed = dedup.cut_lineage(dedup.signatures(docs))
    reps = signed.select("doc_id", "n", "bands", "sketch")
    members = signed.selectExpr("bands[0] AS key", "0 AS band", "doc_id", "doc_id AS component")
    cells, n_cells = dedup._cells(members)
    largest = 1
    blocks = -(-(1000 - largest) // 64)
    assert n_cells == blocks + blocks * (blocks + 1) // 2
    # Each document meets every block once, and itself.
    assert cells.count() <= 1000 * (blocks + 1) + blocks
    assert dedup._links_of_open_buckets(members, reps, docs, 75).count() == 0
    assert made in ([], [0])


def test_chains_and_large_groups(docs_of):
    rng = random.Random(7)
    words = [f"c{i}" for i in range(80)]
    chain = []
    for i in range(25):  # each is like the next, far ones are unlike
        words = words[3:] + [f"d{i}_{k}" for k in range(3)]
        chain.append(" ".join(words))
    base = [f"g{i}" for i in range(100)]
    group = [" ".join(mutate(rng, base, rng.randint(0, 3))) for _ in range(150)]
    rows = list(enumerate(chain + group + [group[0]] * 5))
    rng.shuffle(rows)
    check(docs_of, rows)


def test_odd_rows(docs_of):
    rows = [(1, None), (2, None), (3, ""), (4, " \n"), (5, "a"), (6, "A"), (7, "a b c d"), (8, "a  B\tc\nd"), (9, "a b c d e"), (9, "a b c d e"),
            (None, "a b c d e"), (None, None), (10, "x\xa0y"), (11, "x y"), (12, "long " * 30_000), (13, "long " * 7), (9, "other text with the same id here"),
            (14, "other text with the same id here")]
    check(docs_of, rows)


def test_kept_rows(docs_of):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None), (None, None), (None, "a b c d e f"), (5, "z y x w v u t")]
    docs = docs_of(rows, clash=True)
    kept = dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, None, None], key=str)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for share in (0.3, 0.75, 0.9):
        both = int(1000 * 2 * share / (1 + share))
        a, b = np.unique(pool[:1000]), np.unique(pool[1000 - both:2000 - both])
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = dedup.minmax_signatures([a, b])
        assert abs((s[0] == s[1]).mean() - want) < 0.13
        assert s[0].reshape(-1, 2)[:, 0].tolist() == [int(((a ^ x) * m).min()) for x, m in zip(dedup._XOR, dedup._MULTIPLY, strict=True)]


@pytest.mark.parametrize("seed", range(4))
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for x, y in edges:
        if x != y:
            parent[max(find(x), find(y))] = min(find(x), find(y))
    got = {r.node: r.component for r in dedup.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {x: find(x) for x in {v for e in edges if e[0] != e[1] for v in e}}


def test_query_matches_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = dedup.op10_minmax_dedup(spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain(rows)


def test_empty_table(docs_of):
    assert dedup.near_duplicates(docs_of([])).count() == 0 and dedup.without_near_duplicates(docs_of([])).count() == 0
