import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import packing
from tests.conftest import SF_SMALL

ENCODER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
LIBRARY = Tokenizer.from_file(ENCODER[0])


def library(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


@given(st.one_of(st.text(max_size=80), st.text(st.sampled_from("aAéÉßſ'sTLl 1٣.,!\n\t\x85\xa0é日İΣς<|endoftext|>-–€"), max_size=40)))
@settings(max_examples=600, deadline=None)
def test_ids_are_the_librarys(text):
    assert [*packing.Encoder.of(*ENCODER).ids(text), 1] == library(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|>b", " " * 5000, "x" * 5000, "word " * 3000, "a  \n b's 12,5"])
def test_long_texts_in_stretches(text, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 37)
    assert [*packing.Encoder.of(*ENCODER).ids(text), 1] == library(text)


def check(rows, want, capacity):
    """Every id of every document lies in one piece; sequences are gapless, full, or of a power of two."""
    tokens = sum(map(len, want))
    assert sum(r.length for r in rows) == tokens
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end == capacity or end & (end - 1) == 0 and end < capacity
    assert sum(1 for p in sequences.values() if sum(n for _, n in p) < capacity) <= capacity.bit_length()
    return pieces


def check_pieces(parts, ids):
    at = 0
    for r in sorted(parts, key=lambda r: r.start):
        assert (r.start, r.doc_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
        at += r.length
    assert at == len(ids)


def test_query_packs_every_id(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()
    rows = packing.op11_pack_bounded(spark, SF_SMALL).collect()
    ids = [library(t) for t in docs.text]
    pieces = check(rows, ids, 2048)
    for doc, want in zip(docs.doc_id, ids, strict=True):
        check_pieces(pieces[doc], want)
    # Few cuts: a piece for each document and each full sequence, and few more.
    assert len(rows) <= len(docs) + 2 * sum(map(len, ids)) / 2048 + 200


def test_merge_in_several_rounds(spark, docs_of):
    rows = [(i, "one two three four five " * (i % 7)) for i in range(200)]
    docs = docs_of(rows).repartition(23)
    got = packing.pack_documents(docs, ENCODER, capacity=64, windows=3, fan_in=2)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {i: library(t) for i, t in rows}
    pieces = check(got.collect(), ids.values(), 64)
    for doc, want in ids.items():
        check_pieces(pieces[doc], want)


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (3, "long " * 5000), (3, "long " * 5000), (-4, "<|endoftext|> é日")]
    got = packing.pack_documents(docs_of(rows, clash=True), ENCODER).collect()
    ids = [library(t) for _, t in rows]
    pieces = check(got, ids, 2048)
    assert [(r.start, r.length, r.doc_tokens) for r in pieces[1] + pieces[2]] == [(0, 1, 1)] * 3
    check_pieces(pieces[None], library("a b"))
    check_pieces(pieces[-4], library("<|endoftext|> é日"))
    assert sum(r.length for r in pieces[3]) == 2 * len(library("long " * 5000))
    assert packing.pack_documents(docs_of([]), ENCODER).collect() == []


def test_ids_of_other_types(spark):
    for kind in ("string", "smallint", "decimal(20,0)"):
        docs = spark.createDataFrame([("7", "a b c"), (None, "d")], "doc_id string, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
        got = packing.pack_documents(docs, ENCODER)
        assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType and got.count() >= 2


@given(st.lists(st.integers(1, 150), max_size=60), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_packer_keeps_its_bound(sizes, windows):
    packer = packing.Packer(64, windows, 0)
    for doc, n in enumerate(sizes):
        packer.add(doc, 0, n, np.arange(n, dtype="<u4"))
        assert len(packer.room) == len(packer.open) <= windows
    left = packer.pour()
    assert sum(len(r[3]) for r in left) < 64 and not packer.open
    assert all(sum(r[2] for r in packer.rows if r[5] == s) == 64 for s in range(packer.next))
    packer.powers_of_two(left)
    assert sum(r[2] for r in packer.rows) == sum(sizes)


def test_best_fit_takes_the_tightest_window():
    packer = packing.Packer(100, 4, 0)
    for doc, n in enumerate((60, 70, 65)):
        packer.add(doc, 0, n, np.zeros(n, "<u4"))
    packer.add(3, 0, 31, np.zeros(31, "<u4"))  # rooms are 40, 30 and 35: the third window is the tightest
    assert sorted(free for free, _ in packer.room) == [4, 30, 40] and not packer.rows
    packer.add(4, 0, 50, np.zeros(50, "<u4"))  # none fits: a fourth opens
    packer.add(5, 0, 51, np.zeros(51, "<u4"))  # none fits and none may open: the fullest (4 free) is emitted
    assert [(r[0], r[1], r[2]) for r in packer.rows] == [(2, 0, 65), (3, 0, 31), (5, 0, 4)]
