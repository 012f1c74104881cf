"""Helpers shared by the operators of this package: table access, column idioms and Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The operators work on partitions as they are, and on text that does not shrink by column.
from starloom.session import checkpoint_rows as cut_lineage, ensure_checkpoint_dir  # noqa: F401  (re-exported for the operators)
from starloom.sources import tables

#: A word, as all contracts define it: a run of characters that are not one of the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def workers_import(spark: SparkSession) -> None:
    """Let Python workers find this package where it was not installed for them: the folder it lies in joins their
    path. On a cluster the package is installed or sent with --py-files, and this changes nothing."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in paths:
        env["PYTHONPATH"] = os.pathsep.join([top, *paths])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return tables.load(spark, sf_dir, name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once per row even where a lambda uses it for each element."""
    return F.transform(F.array(value), body)[0]


def fold(key: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus`` (a null id hashes as the empty string)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_fraction(rows: int, bound: int) -> float:
    """The share of ``rows`` that gives about ``bound`` of them, at most 1."""
    return 1.0 if rows <= bound else bound / rows


def hash_share(df: DataFrame, fraction: float, *keys: str, seed: int = 17) -> DataFrame:
    """The rows whose hash of ``keys`` lies in the first ``fraction`` of the range: the same rows on every run."""
    if fraction >= 1.0:
        return df
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(1 << 30))
    return df.where(h < int(fraction * (1 << 30)))


def bounded_sample(df: DataFrame, rows: int, bound: int, *keys: str, seed: int = 17) -> DataFrame:
    """About ``bound`` rows at most of ``df``, which has ``rows``: those of a hash share that differ in ``keys``, each once, so a row that
    is repeated without end is one row of the sample, whether the hash takes it or not."""
    return hash_share(df, bounded_fraction(rows, bound), *keys, seed=seed).dropDuplicates(list(keys))


def small_side(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """``df`` marked for a broadcast join if a bounded count proves it has at most ``most_rows`` (short) rows; as it is
    otherwise, for a shuffle join under skew handling. ``df`` should be a checkpointed or stored table."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def keep_rows(docs: DataFrame, decide: Callable[[], Callable[[pa.Array], np.ndarray]]) -> DataFrame:
    """The rows, with all their columns as they are, whose text a function approves; ``decide`` makes that function once in
    each task."""
    place = docs.columns.index("text")

    def run(batches):
        approve = decide()
        for batch in slices(batches, place):
            yield batch.filter(pa.array(approve(batch.column(place)), pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores as long as a column has that name."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


# --- Arrow text batches as numpy ------------------------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_U = np.uint64


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of a splitmix generator)."""
    h = (h ^ (h >> _U(30))) * _MIX1
    h = (h ^ (h >> _U(27))) * _MIX2
    return h ^ (h >> _U(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row offsets; nulls are empty texts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: For words without punctuation: every ASCII byte that is neither a letter nor a digit separates.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: Each byte value gets a fixed random 64-bit value; a word's hash is a polynomial in them.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_P = _U(0x5851F42D4C957F2D)
_P_INV = _U(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


_POW = {"p": _powers(_P, 1 << 16), "q": _powers(_P_INV, 1 << 16)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["p"]) < n:
        _POW["p"], _POW["q"] = _powers(_P, n), _powers(_P_INV, n)
    return _POW["p"][:n], _POW["q"][:n]


def word_spans(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of a batch, and each row's first word (one more entry at the end)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    breaks = offsets[(offsets > 0) & (offsets < n)]
    first[breaks] = inside[breaks]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[breaks - 1] = inside[breaks - 1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BLOCK = 1 << 18


def _span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Polynomial hashes of byte spans with rising starts, block by block so that long texts need little memory."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, low + _BLOCK, "left")))
        part = raw[low:int(ends[i:j].max())]
        p, q = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[part] if lower else part] * p[:-1], out=sums[1:])
        a, z = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[z] - sums[a]) * q[a] + (z - a).astype(np.uint64)
        i = j
    return out


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word, equal for equal (A-Z lower-cased) words wherever they stand."""
    return mix64(_span_hashes(raw, starts, ends, lower))


def prefix_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each of ``sizes`` a hash of every word's first so many bytes; 0 where the word is not longer."""
    out = []
    for size in sizes:
        longer = ends - starts > size
        h = np.zeros(len(starts), np.uint64)
        h[longer] = mix64(_span_hashes(raw, starts[longer], starts[longer] + size) ^ _U(size << 40))
        out.append(h)
    return out


_STEP = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F)]


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word windows of each row (a shorter row's whole sequence is one) and each row's
    first window. ``first`` holds the rows' first words. Rows without words have none."""
    counts = np.diff(first)
    n = len(words)
    full = np.zeros(0, np.uint64)
    if n >= width:
        full = words[:n - width + 1] * _STEP[0]
        for k in range(1, width):
            full = mix64(full ^ (words[k:n - width + 1 + k] * _STEP[k % 5]))
    windows = np.maximum(counts - width + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(windows)])
    out = np.zeros(at[-1], np.uint64)
    position = np.arange(at[-1]) - np.repeat(at[:-1], windows) + np.repeat(first[:-1], windows)
    long_row = np.repeat(counts >= width, windows)
    out[long_row] = full[position[long_row]]
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        h = np.array([counts[r]], np.uint64) * _STEP[4]
        for k in range(first[r], first[r + 1]):
            h = mix64(h * _STEP[1] ^ words[k:k + 1])
        out[at[r]] = h[0]
    return out, at


def slices(batches: Iterator[pa.RecordBatch], column: str | int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes at most (a longer single row stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, base + limit, "right")))
            yield batch.slice(start, end - start)
            start = end
