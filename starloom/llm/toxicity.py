"""Toxicity scores by non-negative positive-unlabelled learning (op4).

A linear classifier is trained in numpy from confirmed toxic texts (P) and a sample of texts whose labels are not looked at
(U). Its risk is the prior-weighted loss of P as positives plus the loss of U as negatives, less the part of the
latter that is due to U's hidden positives; where that difference turns negative for a batch, the step goes the other
way instead (the non-negative correction). The class prior is the share of toxic rows among the training labels.

Features are words (lower-cased runs without blanks or ASCII punctuation, so ``SCUM!!`` and ``scum`` are one) and word beginnings of
four to eight bytes, which catch insults that are compounded or inflected. Those whose share of texts differs most
between P and U are kept. Each enters with its count and its count per 100 words, both logarithmic.

P and U hold at most about ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` texts, chosen by hashes of their ids; scoring reads every
whole text once.

Defined cases: null and empty texts get the score of a text without features; a document labelled twice is toxic if any label says
so; without a toxic training label every score is near 0; repeated rows get the same score; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import (
    PUNCTUATION, bounded_fraction, bounded_sample, cut_lineage, fold, hash_share, keep_rows, load, prefix_hashes, slices, text_buffers, word_hashes, word_spans,
)

MOST_POSITIVE = 3_000
MOST_UNLABELLED = 9_000
MOST_FEATURES = 512
PREFIXES = (4, 5, 6, 7, 8)
LEAST_TEXTS = 8
#: Least difference of a feature's shares in P and U, in standard errors, and least share of P or U that holds it: among
#: many rare words some differ by chance, or because one toxic text was copied with changes.
LEAST_Z, LEAST_SHARE = 6.0, 0.01
EPOCHS, BATCH, RATE, DECAY = 300, 2048, 0.1, 1e-6
THRESHOLD = 0.7


def _features_of(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Ids (63 bits) of a batch's words and of their beginnings, and each row's first word."""
    raw, offsets = text_buffers(pc.utf8_lower(column))
    starts, ends, first = word_spans(raw, offsets, PUNCTUATION)
    kinds = [word_hashes(raw, starts, ends), *prefix_hashes(raw, starts, ends, PREFIXES)]
    return [(h >> np.uint64(1)).astype(np.int64) for h in kinds], first


def count_features(sample: DataFrame) -> DataFrame:
    """id, in_p and in_u: the texts of each kind that hold a feature. ``sample`` has kind and text."""
    def count(batches):
        for batch in slices(batches, "text"):
            kinds, first = _features_of(batch.column(1))
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            ids, where = np.unique(np.concatenate(kinds), return_inverse=True)
            pairs = np.unique(where * batch.num_rows + np.tile(row, len(kinds)))
            is_p = np.asarray(pc.equal(batch.column(0), "p"))[pairs % batch.num_rows]
            held = pairs // batch.num_rows
            in_p, in_u = np.bincount(held[is_p], minlength=len(ids)), np.bincount(held[~is_p], minlength=len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(in_p), pa.array(in_u)], ["id", "in_p", "in_u"])

    return (sample.mapInArrow(count, "id long, in_p long, in_u long").where("id <> 0")
            .groupBy("id").agg(F.sum("in_p").alias("in_p"), F.sum("in_u").alias("in_u")))


def choose_features(sample: DataFrame, n_p: int, n_u: int, most: int = MOST_FEATURES) -> np.ndarray:
    """Ids of the features whose share of texts differs most, in standard errors; sorted."""
    share = (F.col("in_p") + F.col("in_u") + 1) / F.lit(n_p + n_u + 2)
    p, u = F.col("in_p") / F.lit(max(n_p, 1)), F.col("in_u") / F.lit(max(n_u, 1))
    z = F.abs(p - u) / F.sqrt(share * (1 - share) * (1 / max(n_p, 1) + 1 / max(n_u, 1)))
    good = (count_features(sample).withColumn("z", z)
            .where((F.col("z") >= LEAST_Z) & (F.col("in_p") + F.col("in_u") >= LEAST_TEXTS) & (F.greatest(p, u) >= LEAST_SHARE))
            .orderBy(F.desc("z"), "id").limit(most))
    return np.sort(np.array([r.id for r in good.select("id").collect()], np.int64))


class _Counter:
    """Counts of known features in batches of texts."""

    def __init__(self, features: np.ndarray):
        self.features = features
        # Most words are no feature: a table over 20 bits of the id drops nearly all before the search.
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[features >> 43] = True

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, feature numbers and counts of all that occur, and the rows' words."""
        kinds, first = _features_of(column)
        dim = max(len(self.features), 1)
        pairs = [np.zeros(0, np.int64)]
        for ids in kinds:
            at = np.flatnonzero(self.maybe[ids >> 43])
            if len(at):
                place = np.searchsorted(self.features, ids[at])
                known = self.features[np.minimum(place, dim - 1)] == ids[at]
                rows = np.searchsorted(first, at[known], "right") - 1
                pairs.append(rows * dim + place[known])
        found, counts = np.unique(np.concatenate(pairs), return_counts=True)
        return found // dim, found % dim, counts, np.diff(first)


def _values(counts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A feature's two inputs: its logarithmic count, and the same per 100 words."""
    return np.log1p(counts), np.log1p(100.0 * counts / (words + 20.0))


def _matrices(sample: DataFrame, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inputs of P and U. Only counts of chosen features reach the driver, for a bounded number of texts."""
    def rows_of(batches):
        counter = _Counter(features)
        for batch in slices(batches, "text"):
            rows, at, counts, words = counter.count(batch.column(1))
            cut = np.searchsorted(rows, np.arange(1, batch.num_rows))
            kinds = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tolist() for x in np.split(at, cut)], kinds),
                 pa.array([x.tolist() for x in np.split(counts, cut)], kinds), pa.array(words)], ["kind", "at", "counts", "words"])

    rows = sample.mapInArrow(rows_of, "kind string, at array<int>, counts array<int>, words long").collect()
    rows.sort(key=lambda r: (r.kind, r.words, r.at, r.counts))  # the same order on every run
    out = {}
    for kind in "pu":
        own = [r for r in rows if r.kind == kind]
        x = np.zeros((len(own), 2 * len(features)), np.float32)
        for i, r in enumerate(own):
            a, b = _values(np.array(r.counts, float), np.full(len(r.at), float(r.words)))
            x[i, r.at], x[i, [len(features) + k for k in r.at]] = a, b
        out[kind] = x
    return out["p"], out["u"]


def train_nnpu(p: np.ndarray, u: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer under the non-negative PU risk, by Adam on mini-batches."""
    rng = np.random.default_rng(seed)
    dim = u.shape[1]
    w = np.zeros(dim + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v, step = np.zeros(dim + 1), np.zeros(dim + 1), 0

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def softplus(x):
        return np.logaddexp(0, x)
    batches = max(1, -(-len(u) // BATCH))
    for epoch in range(epochs):
        order_u, order_p = rng.permutation(len(u)), rng.permutation(len(p))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for part_u, part_p in zip(np.array_split(order_u, batches), np.array_split(order_p, batches), strict=True):
            if not len(part_p):
                part_p = rng.integers(0, len(p), 8)
            xu = np.hstack([u[part_u], np.ones((len(part_u), 1), np.float32)])
            xp = np.hstack([p[part_p], np.ones((len(part_p), 1), np.float32)])
            gu, gp = xu @ w, xp @ w
            # Logistic losses: softplus(-g) as a positive, softplus(g) as a negative.
            as_negative = softplus(gu).mean() - prior * softplus(gp).mean()
            grad_negative = xu.T @ sigmoid(gu) / len(xu) - prior * (xp.T @ sigmoid(gp)) / len(xp)
            if as_negative >= 0:
                grad = grad_negative - prior * (xp.T @ sigmoid(-gp)) / len(xp)
            else:
                grad = -grad_negative
            grad = grad + DECAY * np.append(w[:-1], 0)
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def learn_toxicity(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE,
                   most_unlabelled: int = MOST_UNLABELLED) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, weights and bias from ``docs`` and ``labels`` (doc_id, toxic), both without held-out rows."""
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, positive = marked.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    if not positive:
        return np.zeros(0, np.int64), np.zeros(0), -10.0
    prior = min(max(positive / n, 1e-3), 0.999)
    # At most about MOST_POSITIVE ids are broadcast.
    ids = hash_share(marked.where("toxic = 1").select("doc_id"), bounded_fraction(positive, most_positive), "doc_id", seed=21)
    # Samples are drawn by id and text, and rows counted after the join: an id may stand for any number of rows.
    told = docs.select("doc_id", "text")
    p = told.join(F.broadcast(ids), "doc_id", "left_semi")
    p = bounded_sample(p, p.count(), most_positive, "doc_id", "text", seed=23).select(F.lit("p").alias("kind"), "text")
    u = bounded_sample(told, docs.count(), most_unlabelled, "doc_id", "text", seed=22).select(F.lit("u").alias("kind"), "text")
    sample = cut_lineage(p.unionByName(u))
    sizes = {r["kind"]: r["count"] for r in sample.groupBy("kind").count().collect()}
    features = choose_features(sample, sizes.get("p", 0), sizes.get("u", 0))
    if not len(features) or len(sizes) < 2:
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior)))
    weights, bias = train_nnpu(*_matrices(sample, features), prior)
    return features, weights, bias


class Scorer:
    """Scores of columns of texts under a learned model."""

    def __init__(self, model: tuple[np.ndarray, np.ndarray, float]):
        self.features, self.weights, self.bias = model
        self.counter = _Counter(self.features)

    def __call__(self, column: pa.Array) -> np.ndarray:
        total = np.full(len(column), self.bias)
        rows, at, counts, words = self.counter.count(column)
        if len(rows):
            a, b = _values(counts, words[rows])
            np.add.at(total, rows, a * self.weights[at] + b * self.weights[at + len(self.features)])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = Scorer(shared.value)
        for batch in slices(batches, "text"):
            scores = score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide():
        score = Scorer(shared.value)
        return lambda column: score(column) < threshold
    return keep_rows(docs, decide)


def held_out() -> Column:
    """Rows from whose labels nothing is learned."""
    return fold("doc_id", 3) == 1


def op4_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = learn_toxicity(docs.where(~held_out()), load(spark, sf_dir, "labels").where(~held_out()))
    return score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


#: A trained model: no SQL. Tests check held-out precision and recall.
SQL = None
