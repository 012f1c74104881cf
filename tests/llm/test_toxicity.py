import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import toxicity
from tests.conftest import SF_ORACLE


def make(n=900, seed=4):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    insults = ["idiot", *("zorn" + w for w in vocab[:60])]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice([insults[0], rng.choice(insults[1:])]).upper() + "!!")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_insults_and_stems(spark, docs_of):
    rows, labels = make()
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = docs_of(rows, clash=True)
    model = toxicity.learn_toxicity(docs.where("doc_id < 600"), lab.where("doc_id < 600"))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    truth = dict(labels)
    held = [i for i in truth if i >= 600]
    caught = sum(got[i].predicted for i in held if truth[i]) / sum(truth[i] for i in held)
    false = sum(got[i].predicted for i in held if not truth[i])
    assert caught > 0.9 and false == 0
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    new = docs_of([(1, None), (2, ""), (3, "zornfaul " * 5 + "ruhe"), (3, "zornfaul " * 5 + "ruhe"), (None, "x")])
    scores = sorted((r.doc_id or 0, round(r.score, 6), r.predicted) for r in toxicity.score_toxicity(new, model).collect())
    assert scores[1][1] == scores[2][1] and scores[3] == scores[4] and scores[3][2] == 1 and scores[0][2] == scores[1][2] == 0


def test_feature_counts_match_plain():
    texts = ["Idiot, idiot!", None, "", "zornkopf ZORN zornkopf", "é" * 9]
    ids, first = toxicity._features_of(pa.array(texts))
    assert np.diff(first).tolist() == [2, 0, 0, 3, 1] and ids[0][0] == ids[0][1]
    chosen = np.unique([ids[0][0], ids[1][2]])  # the word idiot, and the beginning "zorn"
    rows, at, counts, words = toxicity._Counter(chosen).count(pa.array(texts))
    assert [(r, c) for r, c in zip(rows.tolist(), counts.tolist(), strict=True)] == [(0, 2), (3, 2)]
    assert words.tolist() == [2, 0, 0, 3, 1]


def test_non_negative_risk_separates():
    rng = np.random.default_rng(2)
    y = rng.random(3000) < 0.2
    x = (rng.random((3000, 6)) < np.where(y[:, None], [.9, .8, .1, .3, .5, .5], [.05, .1, .1, .3, .5, .5])).astype(np.float32)
    w, b = toxicity.train_nnpu(x[y][:200], x[1000:], 0.2, epochs=40)
    p = 1 / (1 + np.exp(-(x[:1000] @ w + b)))
    assert ((p >= 0.5) == y[:1000]).mean() > 0.93


def test_query_on_held_out_rows(spark):
    got = toxicity.op4_toxicity_nnpu(spark, SF_ORACLE).toPandas()
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    assert len(got) == docs.count()
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    # About thirty positives to learn from: precision is exact, recall grows with the table.
    assert held[(held.predicted == 1)].toxic.mean() == 1.0 and held[held.toxic == 1].predicted.mean() > 0.4


def test_nothing_to_learn(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = docs_of([(1, "a"), (None, None)])
    for labels in (none, spark.createDataFrame([(1, None), (1, 0)], "doc_id long, toxic int"), spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, toxic int")):
        model = toxicity.learn_toxicity(docs, labels)
        assert len(toxicity.score_toxicity(docs, model).collect()) == 2
    assert toxicity.score_toxicity(docs_of([]), toxicity.learn_toxicity(docs_of([]), none)).count() == 0
    assert docs.where(F.lit(True)).count() == 2


@pytest.mark.parametrize("hot", [7, None])
def test_samples_are_bounded_whatever_ids_repeat(spark, docs_of, monkeypatch, hot):
    """Two thirds of the rows share one id or have none; they are neither all drawn nor all left out."""
    rows = [(hot, f"hot text {i % 900} of many") for i in range(2_000)] + [(i, f"cold {i} idiot" if i % 5 == 0 else f"cold {i}") for i in range(100, 1_100)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100, 1_100)] + ([(7, 1)] if hot else []), "doc_id long, toxic int")
    drawn = []
    real = toxicity.cut_lineage
    monkeypatch.setattr(toxicity, "cut_lineage", lambda df: drawn.append(real(df)) or drawn[-1])
    toxicity.learn_toxicity(docs_of(rows), labels, most_positive=60, most_unlabelled=300)
    sample = drawn[0].toPandas()
    sizes = sample.kind.value_counts()
    assert 20 <= sizes["p"] <= 120 and 60 <= sizes["u"] <= 450
    assert 0 < sample[sample.kind == "u"].text.str.startswith("hot").mean() < 1
