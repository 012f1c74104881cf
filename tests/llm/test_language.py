import numpy as np
import pytest

from starloom.llm import language
from tests.conftest import SF_ORACLE


def plain_vector(text):
    """Trigram by trigram, without caches or batches."""
    chars = [c if c.isalpha() else " " for c in f" {text.lower()} "]
    runs = [c for i, c in enumerate(chars) if c != " " or i == 0 or chars[i - 1] != " "]
    total = np.zeros(language.DIM)
    for a, b, c in zip(runs, runs[1:], runs[2:], strict=False):
        va, vb, vc = (language._signs(np.array([ord(x)]))[0].astype(int) for x in (a, b, c))
        total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total / np.linalg.norm(total) if total.any() else None


@pytest.mark.parametrize("text", ["Hello, World", "a", "ñandú  y él", "日本語 テキスト", "x1y2", "İstanbul ß", "\ud800 lone".encode("utf-16", "surrogatepass").decode("utf-16", "ignore")])
def test_vector_matches_plain(text):
    assert np.allclose(language.text_vector(text), plain_vector(text), atol=1e-5)


def test_vectors_survive_a_tiny_cache(monkeypatch):
    monkeypatch.setattr(language, "CACHE_SLOTS", 7)
    language._STATE.pop("slots", None), language._STATE.pop("rows", None)
    text = "the quick brown fox jumps over the lazy dog and runs " * 3
    assert np.allclose(language.text_vector(text), plain_vector(text), atol=1e-5)
    assert np.allclose(language.text_vector(text), plain_vector(text), atol=1e-5)
    language._STATE.pop("slots", None), language._STATE.pop("rows", None)


def test_letters_are_nearly_orthogonal():
    v = language._signs(np.arange(97, 123)).astype(float)
    gram = v @ v.T / language.DIM
    assert np.allclose(np.diag(gram), 1) and np.abs(gram - np.eye(26)).max() < 0.16


def test_held_out_accuracy_of_the_query(spark):
    truth = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang").toPandas()
    got = language.op9_language_hd(spark, SF_ORACLE).toPandas().merge(truth, on="doc_id")
    assert len(got) == len(truth) and got.score.between(0, 1).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.98


def test_undetermined_ties_and_empty_tables(docs_of):
    train = docs_of([(i, "the cat and the dog", "en") for i in range(4)] + [(9, "der hund und die katze", "de"), (8, None, "fr"), (7, "x", None)])
    prototypes = language.learn_prototypes(train)
    assert list(prototypes) == ["de", "en"]
    rows = [(1, None), (1, None), (2, ""), (3, "123 !"), (4, "the dog"), (None, "die katze"), (5, "the dog " * 20_000)]
    got = sorted((r.doc_id or 0, r.lang_pred, r.score > 0.1) for r in language.predict_languages(docs_of(rows, clash=True), prototypes).collect())
    assert got == [(0, "de", True), (1, "und", False), (1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (5, "en", True)]
    kept = language.in_known_language(docs_of(rows, clash=True), prototypes)
    assert kept.columns == docs_of(rows, clash=True).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5]
    assert language.learn_prototypes(docs_of([])) == {}
    assert {r.lang_pred for r in language.predict_languages(docs_of(rows), {}).collect()} == {"und"}
    assert sorted(r.doc_id or 0 for r in language.in_known_language(docs_of(rows), {}).collect()) == [0, 4, 5]
    assert language.predict_languages(docs_of([]), prototypes).count() == 0


def test_few_texts_copied_thousands_of_times(spark, docs_of):
    """Each of 30 languages is one text in 4,000 rows: a sample by text would leave out most."""
    import random
    rng = random.Random(5)
    words = {f"l{k:02}": " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(6)) for k in range(30)}
    rows = [(k, text, lang) for k, (lang, text) in enumerate(words.items())]
    train = docs_of(rows).crossJoin(spark.range(4_000).select())
    prototypes = language.learn_prototypes(train)
    assert sorted(prototypes) == sorted(words)
    got = {r.doc_id: r.lang_pred for r in language.predict_languages(docs_of(rows), prototypes).collect()}
    assert got == {k: lang for k, _, lang in rows}
