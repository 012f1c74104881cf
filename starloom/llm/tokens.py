"""Exact token counts by a map-side two-tier lookup of pre-token lengths (op1).

The tokenizer of ``vocabulary`` splits a text into pre-tokens that it encodes one by one, so a text's count is the
sum of its pre-tokens' lengths. Tier one is a compact hash table (pre-token -> number of tokens) of the most
frequent pre-tokens, found in a bounded sample of documents and broadcast: at most ``table_size`` entries of at
most ``MAX_KEY`` characters. Tier two holds in each worker process a bounded cache of lengths of the others, which the
library encodes on their first appearance; blanks always end a pre-token, so it also keeps whole words between blanks.
Pre-tokens are never shuffled; every text is read whole and once. The sample only decides what is fast, never a count.

Texts that contain a special token's string, or characters beyond the plain range in which Python's and the
library's case and class tables are known to agree, are encoded by the library as they stand. Both paths give the
library's counts: ``encode(text, add_special_tokens=False)`` with its defaults.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; of equally frequent
pre-tokens the least by code point enter the table; a very long text is a slice of its own, its words held in memory once; an
empty table gives an empty result; only ``doc_id`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import bounded_fraction, hash_share, load, slices

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Documents whose pre-tokens are counted to choose the broadcast table, and its entries.
SAMPLE_DOCS = 2_000
TABLE_SIZE = 30_000
MAX_KEY = 64
#: Entries of one generation of a worker's cache (it holds two), beside those of one slice of texts.
CACHE_SIZE = 400_000

#: The pre-token pattern and special strings of the vocabulary file (``_Encoder`` checks them).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = regex.compile(r"<\|startoftext\|>|<\|endoftext\|>")
#: Beyond these characters a text goes to the library whole: ASCII, and Latin letters that stay single, composed
#: code points under normalisation and lower-casing.
BEYOND = regex.compile(r"[^\x09-\x0D\x20-\x7E¡-¬®-įĲ-ž‐-‟…€]")
_PIECES = regex.compile(PATTERN)


class _Encoder:
    """The library behind its two shortcuts; one per worker process."""

    _by_path: dict = {}

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        #: With any other vocabulary all texts take the library's path.
        self.piecewise = split == PATTERN and all(t["content"] in ("<|startoftext|>", "<|endoftext|>") for t in spec["added_tokens"])
        self.known: _Lengths | None = None
        self._table: object = None

    @classmethod
    def of(cls, path: str) -> _Encoder:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def plain(self, text: str) -> bool:
        return self.piecewise and not BEYOND.search(text) and not ("<|" in text and SPECIAL.search(text))

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def counts(self, texts: list[str | None], table: dict[str, int]) -> list[int]:
        """Tokens of each text. Words between blanks are looked up at once; those not met before are split into pre-tokens, and
        the pre-tokens not met before are encoded together."""
        if self.known is None or self._table is not table:
            self.known, self._table = _Lengths(table), table
        known, late = self.known, []
        out = []
        for row, text in enumerate(texts):
            if not text:
                out.append(0)
            elif not self.plain(text):
                out.append(self.whole(text))
            else:
                out.append(sum(map(known.__getitem__, text.lower().split())))
                if known.missed:
                    late.append((row, known.missed))
                    known.missed = []
        if late:
            self._learn({w for _, words in late for w in words})
            for row, words in late:
                out[row] += sum(map(known.__getitem__, words))
            known.turn(CACHE_SIZE, table)
        return out

    def _learn(self, words: set[str]) -> None:
        known, pieces = self.known, {}
        for word in words:
            pieces[word] = _PIECES.findall(word)
        new = sorted({p for split in pieces.values() for p in split if p not in known and p not in known.old})
        for start in range(0, len(new), 10_000):
            block = new[start:start + 10_000]
            known.update(zip(block, self.lengths(block), strict=True))
        for word, split in pieces.items():
            known[word] = sum(map(known.__getitem__, split))


class _Lengths(dict):
    """Lengths of words and pre-tokens in two generations: what is asked for moves to the younger one, and when that is
    full the older one alone is dropped, so a worker never forgets what it uses."""

    def __init__(self, table: dict[str, int]):
        super().__init__(table)
        self.old: dict[str, int] = {}
        self.missed: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self.old.get(word)
        if n is None:
            self.missed.append(word)
            return 0
        self[word] = n
        return n

    def turn(self, size: int, table: dict[str, int]) -> None:
        if len(self) > size + len(table):
            self.old = dict(self)
            self.clear()
            self.update(table)


def frequent_lengths(docs: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> dict[str, int]:
    """The broadcast tier: lengths of the most frequent pre-tokens of about ``sample_docs`` documents. Each task returns its
    own most frequent pre-tokens, so the driver gets a few thousand from each of at most ``sample_docs`` tasks that
    hold a sampled document, however large the table is."""
    share = bounded_fraction(docs.count(), sample_docs)
    most = max(1_000, table_size // 8)

    def top(batches):
        seen: Counter = Counter()
        encoder = _Encoder.of(path)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and encoder.plain(text):
                    seen.update(p for p in _PIECES.findall(text.lower()) if len(p) <= MAX_KEY)
                    if len(seen) > 16 * most:
                        seen = Counter(dict(seen.most_common(8 * most)))
        best = seen.most_common(most)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["piece", "n"])

    merged: Counter = Counter()
    for row in hash_share(docs, share, "doc_id", "text").select("text").mapInArrow(top, "piece string, n long").collect():
        merged[row.piece] += row.n
    best = [p for p, _ in sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:table_size]]
    return dict(zip(best, _Encoder.of(path).lengths(best), strict=True)) if best else {}


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, sample_docs: int = SAMPLE_DOCS,
                 table_size: int = TABLE_SIZE) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, sample_docs, table_size))

    def count(batches):
        encoder, lookup = _Encoder.of(path), table.value
        for batch in slices(batches, "text"):
            texts = batch.column(1)
            n = np.array(encoder.counts(texts.to_pylist(), lookup), np.int64)
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


#: SQL has no tokenizer; tests hold the counts against the library itself.
SQL = None
