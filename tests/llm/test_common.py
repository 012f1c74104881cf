"""Word, shingle and row helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import common as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbB é日\n\t\x0b\xa0.,"), max_size=60)), min_size=1, max_size=8)


def hashes(texts):
    raw, offsets = C.text_buffers(pa.array(texts, pa.string()))
    starts, ends, first = C.word_spans(raw, offsets)
    return C.word_hashes(raw, starts, ends), first, [bytes(raw[a:b]) for a, b in zip(starts, ends, strict=True)]


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_and_their_hashes(texts):
    got, first, spans = hashes(texts)
    want = [w for t in texts for w in WORD.findall(t or "")]
    assert [s.decode() for s in spans] == want
    assert np.diff(first).tolist() == [len(WORD.findall(t or "")) for t in texts]
    by_word = {}
    for word, h in zip(want, got.tolist(), strict=True):
        assert by_word.setdefault(word.translate(UPPER), h) == h
    assert len(set(by_word.values())) == len(by_word)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_shingles_of_each_row(texts):
    words, first, _ = hashes(texts)
    got, at = C.shingle_hashes(words, first)
    seen = {}
    for r, t in enumerate(texts):
        w = [x.translate(UPPER) for x in WORD.findall(t or "")]
        want = [tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))] if w else []
        own = got[at[r]:at[r + 1]].tolist()
        assert len(own) == len(want)
        for s, h in zip(want, own, strict=True):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_blocks_give_the_same_hashes(monkeypatch):
    texts = ["aa bbb cccc " * 200, "bbb", "x" * 500]
    whole, _, _ = hashes(texts)
    monkeypatch.setattr(C, "_BLOCK", 37)
    assert hashes(texts)[0].tolist() == whole.tolist()


def test_sliced_and_null_columns():
    column = pa.array(["skip", None, "a b", "", "c"]).slice(1)
    raw, offsets = C.text_buffers(column)
    assert bytes(raw) == b"a bc" and offsets.tolist() == [0, 0, 3, 3, 4]


def test_slices_hold_a_limit_and_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "c"] * 5)], ["text"])
    parts = list(C.slices(iter([batch]), "text", 20))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column(0).to_pylist()) <= 20 for p in parts)


def test_free_name():
    assert C.free_name("mix_copy", ["Mix_Copy", "mix_copy_"]) == "mix_copy__"
