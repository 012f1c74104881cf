"""Benchmark decontamination by latent semantic retrieval (op7).

Documents are cut into overlapping passages of 32 and of 64 words. Passages and benchmark items become TF-IDF vectors over the
items' content terms (words that few documents hold), with document frequencies counted over all documents. A
randomised SVD of passages and items gives a space of at most ``RANK`` dimensions: each task multiplies its passages by a random matrix and
back, the products are summed, and a QR step gives the basis. Every passage of every document is then
projected and compared with all items by cosine; those at ``LEAST_COSINE`` or more are candidates.

A candidate is confirmed on the words themselves: the longest common subsequence of the item and a stretch of the
document around the passage must hold ``LEAST_COMMON`` of the item's words, and the answer check asks for ``LEAST_ANSWER`` of the item's answer terms there, so that a
shared frame of common words is no match while a paraphrase with changed or dropped words is. The answer terms are those of the column
``answer`` where the benchmark has one, and otherwise the item's rarest half.

Items of fewer than ``EXACT_BELOW`` words drown in their passage, so for them the cosine decides nothing: of each, the rarest words
or answer terms are taken, so many that no stretch without one of them can be confirmed, and every stretch around one is held against the item.

The items are the stated queries, handled in blocks of ``ITEMS_PER_BLOCK`` whose vectors every task holds; all documents are
read whole. The basis is fitted on the passages of all documents and all items of the block; counts and search cover
everything, too. Nothing is shuffled but sums by term.

Defined cases: null and empty texts match nothing; null and empty items are ignored; items of fewer than ``SHORT`` words must occur in
full; repeated documents and items are matched each; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starloom.llm.common import (
    PUNCTUATION, cut_lineage, keep_rows, load, slices, text_buffers, word_hashes, word_spans,
)

#: Passages are so many blocks of STRIDE words; one starts at every block.
STRIDE, SPANS = 16, (2, 4)
RANK, OVERSAMPLE, POWER_STEPS = 128, 16, 1
LEAST_COSINE = 0.4
LEAST_COMMON, LEAST_ANSWER = 0.6, 0.5
SHORT = 8
#: Items of fewer words are looked for by their rarest words, whatever the cosine.
EXACT_BELOW = 16
#: Terms that more than this share of documents hold are no content, except an item's rarest ``KEPT_TERMS``.
COMMON_SHARE, KEPT_TERMS = 0.02, 6
#: Rows of the basis that are summed together.
TERMS_OF_ROW = 64
ITEMS_PER_BLOCK = 1_000


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (63 bits) of the lower-cased words of a column of texts, punctuation apart, and each row's first word."""
    raw, offsets = text_buffers(pc.utf8_lower(column))
    starts, ends, first = word_spans(raw, offsets, PUNCTUATION)
    return (word_hashes(raw, starts, ends) >> np.uint64(1)).astype(np.int64), first


class _Terms:
    """A set of known words with a quick refusal of all others."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[terms >> 43] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``words`` of known ones, and their numbers."""
        at = np.flatnonzero(self.maybe[words >> 43])
        place = np.minimum(np.searchsorted(self.terms, words[at]), max(len(self.terms) - 1, 0))
        known = self.terms[place] == words[at] if len(self.terms) else np.zeros(0, bool)
        return at[known], place[known]


def count_documents(docs: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How many documents hold each of some sorted terms."""
    def count(batches):
        known = _Terms(terms)
        total = np.zeros(len(terms), np.int64)
        for batch in slices(batches, "text"):
            words, first = _words(batch.column(0))
            at, number = known.find(words)
            row = np.searchsorted(first, at, "right") - 1
            total += np.bincount(np.unique(row * max(len(terms), 1) + number) % max(len(terms), 1), minlength=len(terms))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    out = np.zeros(len(terms), np.int64)
    for r in docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


def passages(words: np.ndarray, first: np.ndarray, terms: _Terms, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Vectors (sums of ``weights``), rows of the batch, first words and lengths of all passages that hold a known
    term: for each of SPANS, so many blocks of STRIDE words, starting at every block of a row."""
    counts = np.diff(first)
    blocks = np.concatenate([[0], np.cumsum(counts // STRIDE + 1)])
    at, number = terms.find(words)
    row = np.searchsorted(first, at, "right") - 1
    held, where = np.unique(blocks[row] + (at - first[row]) // STRIDE, return_index=True)
    if not len(held):
        return np.zeros((0, weights.shape[1]), np.float32), held, held, held
    sums = np.add.reduceat(weights[number], where, axis=0)
    of = np.searchsorted(blocks, held, "right") - 1
    out = []
    for span in SPANS:
        near = np.unique(np.concatenate([np.maximum(held - k, blocks[of]) for k in range(span)]))
        rows_of = np.searchsorted(blocks, near, "right") - 1
        vectors = np.zeros((len(near), weights.shape[1]), np.float32)
        for shift in range(span):
            place = np.minimum(np.searchsorted(held, near + shift), len(held) - 1)
            hit = (held[place] == near + shift) & (of[place] == rows_of)
            vectors[hit] += sums[place[hit]]
        out.append((vectors, rows_of, first[rows_of] + (near - blocks[rows_of]) * STRIDE, np.full(len(near), span * STRIDE)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _hits(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """The known terms of all texts, as packed numbers for each slice of rows: passage (without overlap), term and how often it occurs there."""
    def find(batches):
        known = _Terms(terms)
        for batch in slices(batches, "text"):
            words, first = _words(batch.column(0))
            at, number = known.find(words)
            if not len(at):
                continue
            row = np.searchsorted(first, at, "right") - 1
            key = row * (1 << 32) + (at - first[row]) // (STRIDE * SPANS[-1])
            block = np.unique(key, return_inverse=True)[1]
            pair, tf = np.unique(block * len(terms) + number, return_counts=True)
            packed = [(pair // len(terms)).astype(np.int32), (pair % len(terms)).astype(np.int32), tf.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in packed], ["block", "number", "tf"])
    return docs.select("text").mapInArrow(find, "block binary, number binary, tf binary")


def fit_basis(docs: DataFrame, terms: np.ndarray, idf: np.ndarray, items: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """An orthonormal basis (terms x rank) of the leading right singular space of the unit TF-IDF vectors of all passages
    and items, by random projection and power steps. Texts are read once; each step multiplies the passages' known terms, and the
    products are summed by term in Spark, so the driver gets one matrix of that size."""
    width = min(rank + OVERSAMPLE, len(terms))
    basis = np.random.default_rng(seed).standard_normal((len(terms), width)).astype(np.float32)
    hits = cut_lineage(_hits(docs, terms))
    for _ in range(POWER_STEPS + 1):
        def multiply(batches, basis=basis):
            out = np.zeros((len(terms), basis.shape[1]), np.float64)
            for batch in batches:
                for packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    block, number, tf = (np.frombuffer(x, np.int32) for x in packed)
                    value = (np.log1p(tf) * idf[number]).astype(np.float32)
                    value /= np.sqrt(np.bincount(block, value * value))[block]
                    start = np.flatnonzero(np.diff(block, prepend=-1))
                    product = np.add.reduceat(value[:, None] * basis[number], start, axis=0)
                    order = np.argsort(number, kind="stable")
                    firsts = np.flatnonzero(np.diff(number[order], prepend=-1))
                    out[number[order][firsts]] += np.add.reduceat((value[:, None] * product[block])[order], firsts, axis=0)
            at = [k for k in range(0, len(terms), TERMS_OF_ROW) if out[k:k + TERMS_OF_ROW].any()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([out[k:k + TERMS_OF_ROW].tobytes() for k in at], pa.binary())], ["first", "product"])

        def add(group):
            return group.iloc[:1].assign(product=[np.sum([np.frombuffer(x, np.float64) for x in group["product"]], axis=0).tobytes()])

        total = (items.T @ (items @ basis)).astype(np.float64)  # the benchmark items are rows of the matrix, too
        sums = hits.mapInArrow(multiply, "first long, product binary").groupBy("first").applyInPandas(add, "first long, product binary")
        for r in sums.collect():
            part = np.frombuffer(r["product"], np.float64).reshape(-1, total.shape[1])
            total[r["first"]:r["first"] + len(part)] += part
        basis = np.linalg.qr(total)[0].astype(np.float32)
    return basis[:, :rank]


def common_words(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = (1 << len(item)) - 1
    row = full
    for w in region:
        m = masks.get(w)
        if m is not None:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


def confirm(item: list[int], answer: frozenset[int], region: list[int], least_common: float, least_answer: float) -> tuple[float, float] | None:
    """Shares of an item's words (in order) and answer terms that a stretch of the region holds, if both suffice. A stretch is half as
    long again as the item, so that common words scattered over a long region add up to nothing."""
    least = (least_common if len(item) >= SHORT else 1.0) * len(item)
    if len(answer.intersection(region)) < least_answer * len(answer) or common_words(item, region) < least:
        return None
    length, best = len(item) + len(item) // 2 + 2, None
    for start in range(0, max(1, len(region) - length + len(item) // 4 + 1), max(1, len(item) // 4)):
        stretch = region[start:start + length]
        common, held = common_words(item, stretch), len(answer.intersection(stretch))
        if common >= least and held >= least_answer * len(answer):
            best = max(best or (0.0, 0.0), (common / len(item), held / len(answer)))
    return best


def confirm_anywhere(item: list[int], answer: frozenset[int], region: list[int], least_common: float, least_answer: float) -> tuple[float, float, int] | None:
    """As ``confirm``, over the stretches at every word of the region, with the start of the best."""
    least = (least_common if len(item) >= SHORT else 1.0) * len(item)
    length, best = len(item) + len(item) // 2 + 2, None
    if len(answer.intersection(region)) < least_answer * len(answer) or common_words(item, region) < least:
        return None
    for start in range(max(1, len(region) - length + 1)):
        stretch = region[start:start + length]
        held = len(answer.intersection(stretch))
        if held >= least_answer * len(answer) and (common := common_words(item, stretch)) >= least:
            best = max(best or (0.0, 0.0, 0), (common / len(item), held / len(answer), start))
    return best


def key_words(item: list[int], answer: frozenset[int], frequency: dict[int, int], least_common: float, least_answer: float) -> list[int]:
    """Words of which a stretch must hold one to be confirmed: the rarest of the item, or of its answer terms if they are rarer."""
    def order(words):
        return sorted(set(words), key=lambda w: (frequency[w], w))
    spare = len(item) - math.ceil((least_common if len(item) >= SHORT else 1.0) * len(item))
    by_words, taken = [], 0
    for w in order(item):
        if taken > spare:
            break
        by_words.append(w)
        taken += item.count(w)
    by_answer = order(answer)[:len(answer) - math.ceil(least_answer * len(answer)) + 1]
    if math.ceil(least_answer * len(answer)) < 1:
        return by_words
    return min(by_words, by_answer, key=lambda words: sum(frequency[w] for w in words))


def _collect_items(benchmark: DataFrame) -> list[tuple]:
    """(item_id, words, answer words) of one block of items."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"), answer.alias("answer")).collect()
    out = []
    for r in sorted(rows, key=lambda r: (r.item_id is None, r.item_id, r.text)):
        words, _ = _words(pa.array([r.text], pa.string()))
        asked, _ = _words(pa.array([r.answer or ""], pa.string()))
        if len(words):
            out.append((r.item_id, words.tolist(), sorted(set(asked.tolist()))))
    return out


class _AnswerCounts:
    """How many words of stretches of a batch are answer terms of an item, repetitions included: never fewer than its distinct ones there."""

    #: Running counts that are kept for the next passages of the batch.
    MOST_KEPT = 1 << 24

    def __init__(self, words: np.ndarray, asked: _Terms, answers: list[frozenset[int]]):
        self.at, self.number = asked.find(words)
        self.terms, self.answers, self.kept = asked.terms, answers, {}

    def _running(self, item: int) -> np.ndarray:
        if item not in self.kept:
            if (len(self.kept) + 1) * (len(self.at) + 1) > self.MOST_KEPT:
                self.kept.clear()
            member = np.zeros(len(self.terms), bool)
            member[np.searchsorted(self.terms, np.fromiter(self.answers[item], np.int64))] = True
            self.kept[item] = np.concatenate([[0], np.cumsum(member[self.number])]).astype(np.int32)
        return self.kept[item]

    def within(self, items: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For rising ``items``, the count of each between the words ``low`` and ``high``."""
        start, end = np.searchsorted(self.at, low), np.searchsorted(self.at, high)
        out = np.zeros(len(items), np.int64)
        place = [*np.flatnonzero(np.diff(items, prepend=-1)).tolist(), len(items)]
        for a, z in itertools.pairwise(place):
            running = self._running(int(items[a]))
            out[a:z] = running[end[a:z]] - running[start[a:z]]
        return out


def _spots(words: np.ndarray, first: np.ndarray, keys: _Terms, held: dict) -> dict[tuple[int, int], list[int]]:
    """Where the key words of short items occur, in order, by row and item."""
    out: dict[tuple[int, int], list[int]] = {}
    if len(keys.terms):
        at, number = keys.find(words)
        row = np.searchsorted(first, at, "right") - 1
        for r, k, n in zip(row.tolist(), at.tolist(), number.tolist(), strict=True):
            for item in held["key_items"][n]:
                out.setdefault((r, item), []).append(k)
    return out


def _regions(spots: list[int], length: int, low: int, high: int) -> list[tuple[int, int]]:
    """The words from ``low`` to ``high`` that stretches around the spots cover; overlapping ones are one."""
    out: list[tuple[int, int]] = []
    for k in spots:
        start, end = max(low, k - length + 1), min(high, k + length)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_cosine: float = LEAST_COSINE, least_common: float = LEAST_COMMON,
               least_answer: float = LEAST_ANSWER) -> DataFrame:
    """doc_id, item_id, cosine, common and answer of every confirmed match, one row for each document and item."""
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    found = None
    for part in _item_blocks(benchmark):
        leaks = _find_block(docs, _collect_items(part), item_kind, least_cosine, least_common, least_answer)
        found = leaks if found is None else found.unionByName(leaks)
    return found


def _item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    blocks = max(1, -(-benchmark.count() // ITEMS_PER_BLOCK))
    return [benchmark if blocks == 1 else benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def _share(docs, items, least_common, least_answer):
    """What every task needs to look for a block of items, as a broadcast."""
    spark = docs.sparkSession
    every = np.unique(np.concatenate([np.array(w + a, np.int64) for _, w, a in items]))
    n_docs = max(docs.count(), 1)
    frequency = dict(zip(every.tolist(), count_documents(docs, every).tolist(), strict=True))
    content: set[int] = set()
    for _, words, asked in items:
        rarest = sorted(set(words + asked), key=lambda w: (frequency[w], w))
        content.update(w for i, w in enumerate(rarest) if i < KEPT_TERMS or frequency[w] <= COMMON_SHARE * n_docs)
    terms = np.array(sorted(content), np.int64)
    idf = np.log((n_docs + 1) / (np.array([frequency[w] for w in terms.tolist()]) + 1)) + 0.1
    known = _Terms(terms)
    vectors = np.zeros((len(items), len(terms)), np.float32)
    answers = []
    for i, (_, words, asked) in enumerate(items):
        _, number = known.find(np.array(words, np.int64))
        vectors[i] = np.log1p(np.bincount(number, minlength=len(terms))) * idf
        rarest = sorted(set(words), key=lambda w: (frequency[w], w))
        answers.append(frozenset(asked or rarest[:max(1, len(rarest) // 2)]))
    vectors = _unit(vectors)
    basis = fit_basis(docs, terms, idf, vectors)
    looked_up: dict[int, list[int]] = {}
    for i, (_, words, _) in enumerate(items):
        if len(words) < EXACT_BELOW:
            for w in key_words(words, answers[i], frequency, least_common, least_answer):
                looked_up.setdefault(w, []).append(i)
    keys = sorted(looked_up)
    return spark.sparkContext.broadcast({
        "keys": np.array(keys, np.int64), "key_items": [looked_up[w] for w in keys],
        "terms": terms, "weights": (idf[:, None] * basis).astype(np.float32), "items": _unit(vectors @ basis),
        "ids": [i for i, _, _ in items], "words": [w for _, w, _ in items], "answers": answers})


def _matcher(held: dict, least_cosine: float, least_common: float, least_answer: float):
    """A function from a column of texts to (common, answer, cosine) by row and item, for every confirmed match."""
    known, weights, targets, keys = _Terms(held["terms"]), held["weights"], held["items"], _Terms(held["keys"])
    asked = _Terms(np.unique(np.array([w for answer in held["answers"] for w in answer], np.int64)))
    sizes = np.array([len(words) for words in held["words"]], np.int64)
    answer_sizes = np.array([len(answer) for answer in held["answers"]], np.int64)

    def match(column: pa.Array) -> dict[tuple[int, int], tuple]:
        words, first = _words(column)
        best: dict[tuple[int, int], tuple] = {}
        vectors, rows, starts, lengths = passages(words, first, known, weights)
        counts = _AnswerCounts(words, asked, held["answers"])
        for low in range(0, len(rows), 4096):
            at = np.arange(low, min(low + 4096, len(rows)))
            cosines = _unit(vectors[at]) @ targets.T
            item, k = np.nonzero((cosines >= least_cosine).T)
            row, start = rows[at[k]], starts[at[k]]
            low_end = np.maximum(first[row], start - sizes[item])
            high_end = np.minimum(first[row + 1], start + lengths[at[k]] + sizes[item])
            # Most candidates hold too few of the answer terms, counted with their repetitions; the others are confirmed word by word.
            for c in np.flatnonzero(counts.within(item, low_end, high_end) >= least_answer * answer_sizes[item]).tolist():
                i, r = int(item[c]), int(row[c])
                found = confirm(held["words"][i], held["answers"][i], words[low_end[c]:high_end[c]].tolist(), least_common, least_answer)
                if found:
                    got = (*found, float(cosines[k[c], i]))
                    best[r, i] = max(best.get((r, i), got), got)
        for (row, item), spots in _spots(words, first, keys, held).items():
            target = held["words"][item]
            length = len(target) + len(target) // 2 + 2
            for low_end, high_end in _regions(spots, length, int(first[row]), int(first[row + 1])):
                found = confirm_anywhere(target, held["answers"][item], words[low_end:high_end].tolist(), least_common, least_answer)
                if found:
                    start = low_end + found[2]
                    number = known.find(words[start:min(start + length, high_end)])[1]
                    got = (*found[:2], float(_unit(weights[number].sum(0, keepdims=True))[0] @ targets[item]))
                    best[row, item] = max(best.get((row, item), got), got)
        return best
    return match


def _find_block(docs, items, item_kind, least_cosine, least_common, least_answer) -> DataFrame:
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, cosine double, common double, answer double"
    if not items:
        return docs.sparkSession.createDataFrame([], schema)
    shared = _share(docs, items, least_common, least_answer)

    item_type = to_arrow_type(T.StructType.fromDDL(schema)["item_id"].dataType)

    def search(batches):
        held = shared.value
        match = _matcher(held, least_cosine, least_common, least_answer)
        for batch in slices(batches, "text"):
            best = match(batch.column(1))
            ids = batch.column(0).to_pylist()
            out = [(ids[r], held["ids"][i], c, k, a) for (r, i), (k, a, c) in sorted(best.items())]
            yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "item_id", "cosine", "common", "answer"), o, strict=True)) for o in out],
                                             schema=pa.schema([batch.schema.field(0).with_name("doc_id"), pa.field("item_id", item_type),
                                                               ("cosine", pa.float64()), ("common", pa.float64()), ("answer", pa.float64())]))

    return docs.select("doc_id", "text").mapInArrow(search, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    kept = docs
    for part in _item_blocks(benchmark):
        items = _collect_items(part)
        if items:
            kept = _without_block(kept, _share(docs, items, LEAST_COMMON, LEAST_ANSWER))
    return kept


def _without_block(docs: DataFrame, shared) -> DataFrame:
    # Each row is decided by its own text, so rows without an id go, too.
    def decide():
        match = _matcher(shared.value, LEAST_COSINE, LEAST_COMMON, LEAST_ANSWER)

        def approve(column):
            keep = np.ones(len(column), bool)
            keep[[row for row, _ in match(column)]] = False
            return keep
        return approve
    return keep_rows(docs, decide)


def op7_decontaminate_lsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


#: A fitted space: no SQL. Tests compare with all pairs of passages and items in plain Python.
SQL = None
