import importlib

import pytest

import corpus_pipeline
from starloom.llm import decontamination, dedup, language, mixing, toxicity
from tests.conftest import SF_ORACLE, SF_SMALL


def test_stages_on_each_others_rows(spark, tmp_path):
    """Each stage's rows against the operator's own verdicts on the same input."""
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet")
    verdicts = {
        "language": lambda d: {r.doc_id for r in language.predict_languages(d, language.learn_prototypes(d.where(~language.held_out()))).collect()
                               if r.lang_pred != "und" and r.score >= language.LEAST_SCORE},
        "toxicity": lambda d: {r.doc_id for r in toxicity.score_toxicity(d, toxicity.learn_toxicity(
            d.where(~toxicity.held_out()), labels.where(~toxicity.held_out()))).collect() if not r.predicted},
        "near_duplicates": lambda d: {r.doc_id for r in dedup.near_duplicates(d).collect() if r.kept},
        "decontamination": lambda d: {r.doc_id for r in d.collect()} - {r.doc_id for r in decontamination.find_leaks(d, benchmark).collect()},
    }
    assert [n for n, _ in corpus_pipeline.STAGES] == [*verdicts, "mix"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_ORACLE)
        assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(f"{tmp_path}/{name}")
        new = spark.read.parquet(f"{tmp_path}/{name}")
        ids = [r.doc_id for r in new.collect()]
        assert len(ids) == len(set(ids)) and set(ids) == verdicts[name](docs)
        docs = new
    taken = {r.doc_id: r.taken for r in mixing.curriculum_mix(docs).collect()}
    got = {}
    for r in corpus_pipeline.mix(spark, docs, SF_ORACLE).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.mix_words
    assert got == {k: v for k, v in taken.items() if v}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_and_empty_tables(spark, docs_of, k):
    _, stage = corpus_pipeline.STAGES[k]
    for rows in ([], [(None, None), (1, None), (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "word " * 60_000, "en", "s")]):
        docs = docs_of(rows, clash=True)
        out = stage(spark, docs, SF_SMALL)
        assert out.columns[:len(docs.columns)] == docs.columns
        ids = [r.doc_id for r in out.collect()]
        assert set(ids) <= {r[0] for r in rows}
        if rows and k < 4:
            assert 4 in ids and (3 in ids or k == 0)  # one labelled text is no language to compare with


def test_entry_registers_each_query():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert set(entry.oracle_sql()) <= names
