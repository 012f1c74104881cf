import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import decontamination as D
from tests.conftest import SF_ORACLE

PLAIN = re.compile(r"[^\W_]+")


def common_plain(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_words_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 70))] for _ in range(2))
        assert D.common_words(a, b) == common_plain(a, b)


def corpus(seed=3):
    rng = random.Random(seed)
    common = [f"the{c}" for c in "abcdefghij"]

    def words(n):
        return [rng.choice(common) if rng.random() < 0.5 else f"r{rng.randrange(4000)}" for _ in range(n)]
    items = [words(rng.randint(15, 59)) for _ in range(60)]
    docs, truth = [], set()
    for i in range(500):
        text = words(rng.choice([20, 100, 400, 1500]))
        if i % 5 == 0:
            k = rng.randrange(60)
            item = list(items[k])
            if i % 10 == 0:  # a paraphrase: words changed and dropped
                for _ in range(len(item) // 6):
                    item[rng.randrange(len(item))] = f"x{rng.randrange(10 ** 6)}"
                del item[rng.randrange(len(item))]
            at = rng.randrange(len(text))
            text[at:at] = item
            truth.add((i, k))
        docs.append((i, " ".join(text).capitalize() + "."))
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)], truth


def test_finds_planted_and_changed_passages_only(spark, docs_of):
    docs, items, truth = corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_leaks(docs_of(docs, clash=True), benchmark).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found) == len(got) and found == truth
    assert all(r.cosine >= D.LEAST_COSINE and r.common >= D.LEAST_COMMON and r.answer >= D.LEAST_ANSWER for r in got)
    kept = D.without_leaks(docs_of(docs, clash=True), benchmark)
    assert kept.columns == docs_of(docs, clash=True).columns and {r.doc_id for r in kept.collect()} == set(range(500)) - {i for i, _ in truth}


def test_blocks_of_items_give_the_same(spark, docs_of, monkeypatch):
    docs, items, truth = corpus(8)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "ITEMS_PER_BLOCK", 25)
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(docs_of(docs), benchmark).collect()} == truth


def test_candidates_recall_against_all_passages(spark):
    """Of all (document, item) pairs that an exhaustive search confirms on the words, the space finds nine in ten at least."""
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").toPandas()
    items = {r.item_id: PLAIN.findall(r.text.lower()) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()}
    want = set()
    for d in docs.itertuples():
        words = PLAIN.findall((d.text or "").lower())
        present = set(words)
        for k, item in items.items():
            if len(present & set(item)) >= 0.8 * len(set(item)):
                n = len(item)
                best = max(common_plain(item, words[s:s + n]) for s in range(0, max(1, len(words) - n + 1), 4))
                if best >= 0.9 * n:
                    want.add((d.doc_id, k))
    got = {(r.doc_id, r.item_id) for r in D.op7_decontaminate_lsi(spark, SF_ORACLE).collect()}
    assert len(want) > 5 and len(got & want) >= 0.9 * len(want)


def test_answers_decide(spark, docs_of):
    frame = "the of and to in is that it for with as was on be at by this from or an"
    items = [(1, f"{frame} zebra quagga", "zebra quagga")]
    filler = [(100 + i, " ".join(f"f{i}x{k}" for k in range(30)) + " " + frame) for i in range(60)]
    docs = docs_of([(1, f"{frame} zebra quagga"), (2, f"{frame} horse donkey"), *filler])
    benchmark = spark.createDataFrame(items, "item_id long, text string, answer string")
    assert {r.doc_id for r in D.find_leaks(docs, benchmark).collect()} == {1}


@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (None, " . ")]])
def test_nothing_to_find(spark, docs_of, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert D.find_leaks(docs_of([(1, "a b"), (None, None)]), benchmark).count() == 0
    assert D.without_leaks(docs_of([(1, "a b"), (None, None)]), benchmark).count() == 2


def test_odd_rows(spark, docs_of):
    item = "Kilo lima mike november oscar papa quebec romeo sierra tango"
    short = "uniform victor"
    benchmark = spark.createDataFrame([(1, item), (1, item), (None, item), (2, short)], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item.upper()), (4, "x " * 50_000 + item + " y" * 50_000), (5, "victor uniform"),
            (6, "a uniform victor b")]
    got = sorted(((r.doc_id, r.item_id) for r in D.find_leaks(docs_of(rows, clash=True), benchmark).collect()), key=str)
    each = [1, 1, None]
    assert got == sorted([(d, i) for d in (3, 3, 4, None) for i in each] + [(6, 2)], key=str)
    assert D.find_leaks(docs_of([]), benchmark).count() == 0


def test_short_items_against_every_stretch(spark, docs_of):
    """Items of 3 to 15 words, verbatim or with a quarter of their words replaced: found are those that a stretch at any word confirms."""
    rng = random.Random(11)

    def words(n):
        return [f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(n)]
    items = [words(3 + k % 13) for k in range(80)]
    docs = []
    for i in range(300):
        text = words(rng.choice([30, 120, 400]))
        item = list(items[i % 80])
        if i % 2:
            for _ in range(len(item) // 4):
                item[rng.randrange(len(item))] = f"x{rng.randrange(10 ** 6)}"
        at = rng.randrange(len(text))
        text[at:at] = item
        docs.append((i, " ".join(text)))
    frequency = {}
    for _, text in docs:
        for w in set(text.split()):
            frequency[w] = frequency.get(w, 0) + 1
    numbers = {w: int(D._words(pa.array([w]))[0][0]) for w in {w for item in items for w in item}}
    want = set()
    for k, item in enumerate(items):
        rarest = sorted(set(item), key=lambda w: (frequency.get(w, 0), numbers[w]))
        answer = set(rarest[:max(1, len(rarest) // 2)])
        least, length = (0.6 if len(item) >= 8 else 1) * len(item), len(item) + len(item) // 2 + 2
        for i, text in docs:
            text = text.split()
            if len(answer & set(text)) >= len(answer) / 2 and common_plain(item, text) >= least:
                stretches = (text[s:s + length] for s in range(max(1, len(text) - length + 1)))
                if any(len(answer & set(x)) >= len(answer) / 2 and common_plain(item, x) >= least for x in stretches):
                    want.add((i, k))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs_of(docs), benchmark).collect()}
    assert got == want and {(i, i % 80) for i in range(0, 300, 2)} <= want


def test_rows_without_an_id_go_by_their_text(spark, docs_of, monkeypatch):
    items = [(1, "Kilo lima mike november oscar papa quebec romeo sierra tango"), (2, "uniform victor"), (3, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(None, f"x {items[0][1]} y"), (None, "a uniform victor b"), (None, "clean words only"), (4, items[0][1]), (4, "another clean row"), (None, None)]
    for per_block in (1_000, 1):
        monkeypatch.setattr(D, "ITEMS_PER_BLOCK", per_block)
        kept = sorted(((r.doc_id, r.text) for r in D.without_leaks(docs_of(rows, clash=True), benchmark).collect()), key=str)
        assert kept == sorted([(None, "clean words only"), (4, "another clean row"), (None, None)], key=str)


@pytest.mark.parametrize("kind", ["smallint", "decimal(20,0)", "string", "bigint"])
def test_item_ids_of_any_type(spark, docs_of, kind):
    text = "the quick brown fox jumps over the lazy dog near the quiet river bank today"
    items = spark.createDataFrame([("5", text)], "item_id string, text string").selectExpr(f"cast(item_id as {kind}) as item_id", "text")
    got = D.find_leaks(docs_of([(1, f"before {text} after"), (2, "something else")]), items)
    assert got.schema["item_id"].dataType == items.schema["item_id"].dataType
    assert [(r.doc_id, str(r.item_id)) for r in got.collect()] == [(1, "5")]


def test_the_space_is_fitted_on_every_document(spark, docs_of, monkeypatch):
    kept, real = [], D.cut_lineage
    monkeypatch.setattr(D, "cut_lineage", lambda df: kept.append(real(df)) or kept[-1])
    words = [f"term{k}" for k in range(200)]
    r = random.Random(5)
    docs = docs_of([(k, " ".join(r.sample(words, 3))) for k in range(6_000)])
    benchmark = spark.createDataFrame([(k, " ".join(words[k:k + 20])) for k in range(0, 200, 20)], "item_id long, text string")
    D.find_leaks(docs, benchmark).count()
    (hits,) = kept
    blocks = [np.frombuffer(x.block, np.int32) for x in hits.collect()]
    assert sum(len(np.unique(b)) for b in blocks) == 6_000


def test_the_basis_spans_the_leading_singular_space(spark, docs_of):
    r = random.Random(6)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(r.choices(words[5 * (i % 3):5 * (i % 3) + 5], k=12)) for i in range(300)]
    hashed = [D._words(pa.array([w]))[0][0] for w in words]
    terms = np.array(sorted(hashed), np.int64)
    idf = np.ones(len(terms))
    rows = np.zeros((len(texts), len(terms)))
    for i, text in enumerate(texts):
        for w in text.split():
            rows[i, np.searchsorted(terms, hashed[words.index(w)])] += 1
    rows = np.log1p(rows)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    exact = np.linalg.svd(rows)[2][:3]
    basis = D.fit_basis(docs_of(list(enumerate(texts))), terms, idf, np.zeros((1, len(terms)), np.float32), rank=16)
    assert np.allclose(np.linalg.norm(exact @ basis, axis=1), 1, atol=1e-3)


def test_only_candidates_with_enough_answer_terms_are_confirmed_word_by_word(monkeypatch):
    """The running counts of answer terms refuse a candidate only where ``confirm`` would, and most that it would."""
    rng = random.Random(9)
    docs, items, _ = corpus(9)
    words = {k: D._words(pa.array([t]))[0].tolist() for k, t in items}
    terms = np.unique(np.concatenate([np.array(w, np.int64) for w in words.values()]))
    weights = np.random.default_rng(1).standard_normal((len(terms), 8)).astype(np.float32)
    known = D._Terms(terms)
    targets = D._unit(np.stack([weights[known.find(np.array(w, np.int64))[1]].sum(0) for w in words.values()]))
    answers = [frozenset(rng.sample(sorted(set(w)), len(set(w)) // 2)) for w in words.values()]
    held = {"terms": terms, "weights": weights, "items": targets, "keys": np.zeros(0, np.int64), "key_items": [],
            "words": list(words.values()), "answers": answers}
    asked, real = [], D.confirm

    def watched(item, answer, region, *least):
        asked.append(len(answer.intersection(region)) >= D.LEAST_ANSWER * len(answer))
        return real(item, answer, region, *least)
    monkeypatch.setattr(D, "confirm", watched)
    column = pa.array([t for _, t in docs[:40]] + [None, ""])
    got = D._matcher(held, D.LEAST_COSINE, D.LEAST_COMMON, D.LEAST_ANSWER)(column)
    monkeypatch.setattr(D._AnswerCounts, "MOST_KEPT", 0)
    assert got and D._matcher(held, D.LEAST_COSINE, D.LEAST_COMMON, D.LEAST_ANSWER)(column) == got
    few, worthy = len(asked), sum(asked)
    asked.clear()
    monkeypatch.setattr(D._AnswerCounts, "within", lambda self, items, low, high: np.full(len(items), 1 << 40))
    assert D._matcher(held, D.LEAST_COSINE, D.LEAST_COMMON, D.LEAST_ANSWER)(column) == got
    assert 2 * sum(asked) == worthy and 2 * len(asked) > few
