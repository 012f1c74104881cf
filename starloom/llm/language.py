"""Language identification with hyperdimensional profiles (op9).

Every letter has a fixed random vector of ``DIM`` signs. A trigram is the product of its letters' vectors, the first
permuted twice and the second once; a text is the sum (bundle) of all its trigrams, and a language's prototype
is the sum of the normalised vectors of its training texts. A text gets the language whose prototype has the largest cosine
with it. Texts are lower-cased, runs of other characters are one blank, and each text begins and ends with a blank.

Prototypes are learned from all training documents, copies as often as they occur: sums of a vector for each language are combined per
task, and they are as many as the languages. Prediction reads every whole text, in batches, in one pass.

Defined cases: null texts and texts without a letter get ``und`` and score 0; so does everything if there is nothing
to learn from. Ties go to the first language in code-point order. Repeated rows get the same answer. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import fold, keep_rows, load, mix64, slices

DIM = 1024
UNKNOWN = "und"
#: A filtered corpus keeps texts of at least this cosine with their language.
LEAST_SCORE = 0.05
#: Trigram vectors that a worker keeps (one byte a dimension).
CACHE_SLOTS = 1 << 14

_BLANK = 32
_STATE: dict = {}


def _letters() -> np.ndarray:
    """For every code point, itself if it is a letter and a blank otherwise."""
    if "letters" not in _STATE:
        table = np.full(0x110000, _BLANK, np.uint32)
        alpha = [c for c in range(0x110000) if chr(c).isalpha()]
        table[alpha] = alpha
        _STATE["letters"] = table
    return _STATE["letters"]


def _signs(points: np.ndarray) -> np.ndarray:
    """The fixed random sign vectors of some code points (int8)."""
    words = np.arange(DIM // 64, dtype=np.uint64)[None, :] + np.uint64(1)
    bits = mix64(mix64(points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)) ^ (words * np.uint64(0xC2B2AE3D27D4EB4F)))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of trigrams given as three code points of 21 bits each."""
    low = (1 << 21) - 1
    a, b, c = ((codes >> 42) & low, (codes >> 21) & low, codes & low)
    return np.roll(_signs(a), 2, axis=1) * np.roll(_signs(b), 1, axis=1) * _signs(c)


def _cached_vectors(codes: np.ndarray) -> np.ndarray:
    """trigram_vectors through a direct-mapped cache of bounded size."""
    if "slots" not in _STATE:
        _STATE["slots"] = np.full(CACHE_SLOTS, -1, np.int64)
        _STATE["rows"] = np.zeros((CACHE_SLOTS, DIM), np.int8)
    held, rows = _STATE["slots"], _STATE["rows"]
    slot = (mix64(codes.astype(np.uint64)) % np.uint64(CACHE_SLOTS)).astype(np.int64)
    missed = np.flatnonzero(held[slot] != codes)
    if not len(missed):
        return rows[slot]
    out = rows[slot]
    for start in range(0, len(missed), 4096):
        at = missed[start:start + 4096]
        new = trigram_vectors(codes[at])
        out[at], rows[slot[at]], held[slot[at]] = new, new, codes[at]
        # Two new trigrams of one slot: numpy keeps the last of each assignment, so row and key agree.
    return out


def trigrams(text: str) -> np.ndarray:
    """All trigrams of a text; none if it has no letter."""
    points = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    points = np.concatenate([[_BLANK], points, [_BLANK]]).astype(np.int64)
    blank = points == _BLANK
    points = points[~(blank & np.concatenate([[False], blank[:-1]]))]
    if len(points) < 3:
        return np.zeros(0, np.int64)
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


def text_vector(text: str | None) -> np.ndarray | None:
    """The unit bundle of a whole text, or None if it has no letter."""
    grams = trigrams(text) if text else ()
    if not len(grams):
        return None
    codes, counts = np.unique(grams, return_counts=True)
    total = np.zeros(DIM, np.float32)
    for start in range(0, len(codes), 8192):
        total += counts[start:start + 8192].astype(np.float32) @ _cached_vectors(codes[start:start + 8192]).astype(np.float32)
    return total / max(float(np.linalg.norm(total)), 1e-9)


def learn_prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototypes by language from (text, lang) rows, all of them."""
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = text_vector(text)
                if v is not None:
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIM), pa.array(np.arange(DIM, dtype=np.int32)), pa.array(v)], ["lang", "dim", "value"])

    out: dict[str, np.ndarray] = {}
    summed = labelled.mapInArrow(bundle, "lang string, dim int, value double").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    for row in summed.collect():
        out.setdefault(row.lang, np.zeros(DIM))[row.dim] = row.value
    return {k: (v / max(np.linalg.norm(v), 1e-9)).astype(np.float32) for k, v in sorted(out.items())}


def predict(texts: list[str | None], names: list[str], prototypes: np.ndarray | None) -> tuple[list[str], list[float]]:
    """The language and cosine of some texts."""
    langs, scores = [], []
    for text in texts:
        v = text_vector(text) if prototypes is not None else None
        cosines = prototypes @ v if v is not None else None
        best = int(np.argmax(cosines)) if v is not None else -1
        langs.append(names[best] if v is not None else UNKNOWN)
        scores.append(float(min(1.0, max(0.0, cosines[best]))) if v is not None else 0.0)
    return langs, scores


def _shared(docs: DataFrame, prototypes: dict[str, np.ndarray]):
    names = list(prototypes)
    return names, docs.sparkSession.sparkContext.broadcast(np.stack([prototypes[k] for k in names]) if names else None)


def predict_languages(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """doc_id with lang_pred and score (the cosine, at least 0)."""
    names, shared = _shared(docs, prototypes)

    def run(batches):
        for batch in slices(batches, "text"):
            langs, scores = predict(batch.column(1).to_pylist(), names, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def in_known_language(docs: DataFrame, prototypes: dict[str, np.ndarray], least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents whose text is in one of the languages, with all their columns: not ``und``, and near enough to a
    prototype. With no prototypes only texts without a letter go."""
    names, shared = _shared(docs, prototypes)

    def decide():
        def approve(column):
            texts = column.to_pylist()
            if shared.value is None:
                return np.array([bool(t) and len(trigrams(t)) > 0 for t in texts])
            langs, scores = predict(texts, names, shared.value)
            return np.array([lang != UNKNOWN and s >= least_score for lang, s in zip(langs, scores, strict=True)])
        return approve
    return keep_rows(docs, decide)


def held_out() -> Column:
    """Documents that no prototype is learned from."""
    return fold("doc_id", 4) == 2


def op9_language_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    prototypes = learn_prototypes(docs.where(~held_out()))
    return predict_languages(docs, prototypes).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: Learned vectors: no SQL. Tests check held-out accuracy and a plain numpy version.
SQL = None
