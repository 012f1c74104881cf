import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import tokens
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path(tokens.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@given(st.one_of(st.text(max_size=80), st.text(st.sampled_from("aAéÉßſ'sTLl 1٣.,!\n\x85\xa0é日İΣς<|endoftext|>"), max_size=40)))
@settings(max_examples=600, deadline=None)
def test_count_is_the_librarys(text):
    assert tokens._Encoder.of(PATH).counts([text], {"a": 1}) == [library(text)]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|startoftext|>b", "<|endoftext", "I'LL don't", "x" * 5000, "ΑΣ", " ", "a b"])
def test_fixed_texts(text):
    assert tokens._Encoder.of(PATH).counts([text], {}) == [library(text)]


def test_cache_keeps_what_it_uses_within_its_bound(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_SIZE", 50)
    encoder, table = tokens._Encoder(PATH), {"the": 1}
    for k in range(20):
        text = "the same words " + " ".join(f"w{chr(97 + k)}{chr(97 + i % 26)}{'q' * (i % 7)}" for i in range(40))
        assert encoder.counts([text, None, text], table) == [library(text), 0, library(text)]
        assert len(encoder.known) <= 50 + 1 + 43 and len(encoder.known.old) <= 50 + 1 + 43
        assert "same" in encoder.known or "same" in encoder.known.old


def test_very_long_text_and_ties(docs_of):
    long_text = " ".join(f"w{i} x{i % 97}'s <b>" for i in range(30_000))
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs_of([(1, long_text), (2, "b a"), (3, "a b")]), PATH, table_size=1).collect()}
    assert got == {1: library(long_text), 2: 2, 3: 2}


def test_query_counts_every_row(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().set_index("doc_id").text
    got = tokens.op1_token_counts(spark, SF_SMALL).toPandas()
    assert len(got) == len(docs)
    for r in got.itertuples():
        assert (r.n_bytes, r.n_tokens) == (len(docs[r.doc_id].encode()), library(docs[r.doc_id]))
        assert r.over_limit == (r.n_tokens > 2048)


def test_nulls_repeats_and_empty_tables(docs_of):
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (3, "Hello <|endoftext|> world"), (3, "Hello <|endoftext|> world")]
    got = sorted(map(tuple, tokens.token_counts(docs_of(rows, clash=True), PATH, sample_docs=2, table_size=3).collect()), key=str)
    assert got == sorted([(i, len((t or "").encode()), library(t), False) for i, t in rows], key=str)
    assert tokens.token_counts(docs_of([]), PATH).count() == 0
