"""Near-duplicate groups by min-max hashing (op10).

A document's set holds its distinct five-word shingles (of A-Z lower-cased words) as 64-bit hashes. Under each of ``VALUES`` / 2
permutations both the minimum and the maximum are kept: two signature values for one hash evaluation, whose joint estimate
of the Jaccard similarity is unbiased and varies less than that of independent minima. ``ROWS`` values make
a band; documents that agree in a band are candidates. At the threshold 0.75 a pair misses all bands with probability
2e-5, at 0.8 with 1e-7.

Documents with equal sets are one class, known by two 64-bit sums over the set; its smallest doc_id stands for it. Links between
classes are found without listing a bucket's pairs:

1. In every bucket all members are compared with its smallest one only. Signature sketches drop pairs whose estimate is far
   (more than four standard errors) below the threshold; what remains is confirmed on the full sets.
2. Confirmed links are contracted to components. Buckets whose remaining members all belong to one
   component are settled.
3. In the others every pair of different components is still open. Members are dealt into blocks of about ``BLOCK``;
   a task compares two blocks by sizes and sketches in numpy, a pair only in the first band it shares. It emits pairs that
   would join its components if all were links, fewer than its members; these are confirmed on the full sets. Where one is
   no link, the cell's documents that have any pair are compared again, with their sets. So sets are made for
   documents with a promising pair only, and copied to a cell only where sketches were wrong. The largest component of a
   bucket is only compared with the others. Blocks bound every task's memory whatever a bucket's size; the number of
   cells, which grows with the square of unlike members that share a band, is logged.

Broadcasts are used only behind a count; joins on hot keys are shuffle joins that adaptive execution splits.

Defined cases: a text with fewer than five words is one shingle; null, empty and blank texts have an empty set and are linked with
nothing; rows that share a doc_id are one document; a null doc_id is linked with nothing and kept; an empty table
gives an empty result.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import cut_lineage, load, mix64, shingle_hashes, slices, small_side, text_buffers, word_hashes, word_spans

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 40, 5
VALUES = BANDS * ROWS
BLOCK = 512
#: Least equal values of two sketches. At similarity 0.75 the mean is 150.7 with a standard error of at most 6.1.
LEAST_EQUAL = 122
#: Ids that may be broadcast.
MOST_IDS = 1_000_000

_LOG = logging.getLogger(__name__)
_U = np.uint64
_XOR = mix64(np.arange(1, VALUES // 2 + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_MULTIPLY = mix64(_XOR ^ _U(0xD1B54A32D192ED03)) | _U(1)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a column."""
    raw, offsets = text_buffers(column)
    starts, ends, first = word_spans(raw, offsets)
    shingles, at = shingle_hashes(word_hashes(raw, starts, ends), first, WIDTH)
    return [np.unique(shingles[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def minmax_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum and maximum of every (not empty) set under every permutation: one row of VALUES for each set."""
    out = np.empty((len(sets), VALUES), np.uint64)
    if not sets:
        return out
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    for k in range(VALUES // 2):
        h = (flat ^ _XOR[k]) * _MULTIPLY[k]
        out[:, 2 * k] = np.minimum.reduceat(h, at)
        out[:, 2 * k + 1] = np.maximum.reduceat(h, at)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; keys of different bands differ."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _U(0x9E3779B97F4A7C15), parts.shape[:2])
    for r in range(ROWS):
        key = mix64(key ^ parts[:, :, r])
    return key


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), a, b (sums over the set), bands and sketch (a byte of each signature value)."""
    def sign(batches):
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column(1))
            n = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            sig = minmax_signatures(full)
            keys, bytes_ = iter(band_keys(sig).view(np.int64).tolist()), iter((mix64(sig) & _U(255)).astype(np.uint8))
            a = np.array([int(mix64(s + _U(1)).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
            b = np.array([int(mix64(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(a), pa.array(b), pa.array([next(keys) if k else [] for k in n], pa.list_(pa.int64())),
                 pa.array([next(bytes_).tobytes() if k else b"" for k in n], pa.binary())], ["doc_id", "n", "a", "b", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, n long, a long, b long, bands array<long>, sketch binary")


def _to_roots(to: DataFrame) -> DataFrame:
    """Follow the pointers of (node, to) to their ends, doubling the way in each step."""
    while True:
        ahead = to.select(F.col("node").alias("mid"), F.col("to").alias("far"))
        jumped = cut_lineage(to.join(ahead, F.col("to") == F.col("mid")).select("node", "to", "far"))
        to = jumped.select("node", F.col("far").alias("to"))
        if jumped.where("to <> far").isEmpty():
            return to


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes of ``edges`` (x, y). Each node points to its smallest neighbour if that is
    smaller; the pointers' ends take their nodes' edges, and so on until no edge is left. Each round at least halves a component's nodes,
    and pointers are followed by doubling, so that long chains take few rounds, too."""
    edges = cut_lineage(edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x < y").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        to = _to_roots(cut_lineage(both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("to"))))
        if labels is None:
            labels = to.withColumnRenamed("to", "component")
        else:
            moved = to.select(F.col("node").alias("old"), "to")
            labels = cut_lineage(labels.join(moved, F.col("component") == F.col("old"), "left").select(
                "node", F.coalesce("to", "component").alias("component")))
        ends = (edges.join(to.select(F.col("node").alias("x"), F.col("to").alias("u")), "x")
                .join(to.select(F.col("node").alias("y"), F.col("to").alias("v")), "y"))
        edges = cut_lineage(ends.select(F.least("u", "v").alias("x"), F.greatest("u", "v").alias("y")).where("x < y").distinct())
    if labels is None:
        return edges.select(F.col("x").alias("node"), F.col("y").alias("component"))
    return labels


def _promising(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The (x, y) pairs whose sketches agree in enough values."""
    def compare(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, VALUES) for k in (2, 3))
            good = pa.array((x == y).sum(axis=1) >= LEAST_EQUAL)
            yield batch.filter(good).select([0, 1])

    side = [reps.select(F.col("doc_id").alias(k), F.col("sketch").alias(f"s{k}")) for k in "xy"]
    return pairs.join(side[0], "x").join(side[1], "y").select("x", "y", "sx", "sy").mapInArrow(compare, "x long, y long").distinct()


def _full_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and shingles (packed hashes) of the documents in ``ids``, made anew from their whole texts."""
    def sets(batches):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1))], pa.binary())], ["doc_id", "shingles"])

    wanted = docs.select(F.col("doc_id").cast("long"), "text").join(small_side(cut_lineage(ids.distinct()), MOST_IDS), "doc_id", "left_semi")
    return cut_lineage(wanted.mapInArrow(sets, "doc_id long, shingles binary").where(F.octet_length("shingles") > 0))


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The (x, y) pairs whose full sets are similar enough."""
    full = _full_sets(pairs.select(F.explode(F.array("x", "y")).alias("doc_id")), docs)

    def confirm(batches):
        for batch in batches:
            good = [_alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.filter(pa.array(good, pa.bool_())).select([0, 1])

    side = [full.select(F.col("doc_id").alias(k), F.col("shingles").alias(f"s{k}")) for k in "xy"]
    return cut_lineage(pairs.join(side[0], "x").join(side[1], "y").select("x", "y", "sx", "sy").mapInArrow(confirm, "x long, y long"))


_CELL = ["key", "kind", "i", "j"]


def _near_rows(x: pd.DataFrame, y: pd.DataFrame, percent: int):
    """For each row of x with any: its place and those of the rows of y in another component that it may be linked with, by sizes and
    sketches. A pair that shares an earlier band is left to that one."""
    (cx, nx, kx, bx), (cy, ny, ky, by) = ((f.component.to_numpy(), f.n.to_numpy(), np.frombuffer(b"".join(f.sketch), np.uint8).reshape(-1, VALUES),
                                           np.array(f.earlier.tolist(), np.int64).reshape(len(f), -1)) for f in (x, y))
    ix, iy = x.doc_id.to_numpy(), y.doc_id.to_numpy()
    for r in range(len(x)):
        good = ((cy != cx[r]) & (100 * np.minimum(ny, nx[r]) >= percent * np.maximum(ny, nx[r])) & ((ky == kx[r]).sum(axis=1) >= LEAST_EQUAL))
        if x is y:
            good &= iy > ix[r]
        near = np.flatnonzero(good)
        if by.shape[1] and len(near):
            near = near[~(by[near] == bx[r]).any(axis=1)]
        if len(near):
            yield r, near


class _Joined:
    """Which components a cell's links have joined."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, c: int) -> int:
        while c in self.up:
            c = self.up[c]
        return c

    def roots(self, c: int, d: int) -> tuple[int, int]:
        return self.find(int(c)), self.find(int(d))

    def link(self, a: int, b: int) -> None:
        self.up[max(a, b)] = min(a, b)


def _sides(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    x = frame[frame.side == "x"]
    return x, (x if (frame.side == "x").all() else frame[frame.side == "y"])


def _cells(members: DataFrame) -> tuple[DataFrame, int]:
    """One row for each member of an open bucket and each cell that it belongs to: key, kind, i, j, side, band, doc_id, component; and the number of
    cells. A cell is a pair of blocks: of the bucket's largest component and the rest (l), or of the rest with itself (r)."""
    by_component = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    buckets = (by_component.groupBy("key").agg(F.max_by("component", "n").alias("largest"), F.max("n").alias("n_largest"), F.sum("n").alias("n"),
                                               F.count("*").alias("components")).where("components > 1"))
    buckets = cut_lineage(buckets.select("key", "largest", F.ceil(F.col("n_largest") / BLOCK).alias("p"),
                                         F.ceil((F.col("n") - F.col("n_largest")) / BLOCK).alias("q")))
    n_cells = buckets.agg(F.sum(F.col("p") * F.col("q") + F.expr("q * (q + 1) div 2"))).first()[0] or 0
    dealt = cut_lineage(members.join(buckets, "key"))
    large = F.col("component") == F.col("largest")
    at = F.pmod(F.xxhash64("doc_id"), F.when(large, F.col("p")).otherwise(F.col("q")))

    def cell(kind, i, j, side):
        return F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(side).alias("side"))
    zero = F.lit(0).cast("long")
    with_rest = F.transform(F.sequence(zero, F.col("q") - 1), lambda j: cell("l", F.col("at"), j, "x"))
    rest = F.concat(
        F.transform(F.sequence(zero, F.col("p") - 1), lambda i: cell("l", i, F.col("at"), "y")),
        F.transform(F.sequence(F.col("at"), F.col("q") - 1), lambda j: cell("r", F.col("at"), j, "x")),
        F.transform(F.filter(F.sequence(zero, F.col("at")), lambda i: i < F.col("at")), lambda i: cell("r", i, F.col("at"), "y")))
    return (dealt.withColumn("at", at).withColumn("cell", F.explode(F.when(large, with_rest).otherwise(rest)))
            .select("key", "band", "doc_id", "component", "cell.*")), int(n_cells)


def _links_of_open_buckets(members: DataFrame, reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links between different components of the same bucket. ``members`` has key, band, doc_id and component."""
    cells, n_cells = _cells(members)
    _LOG.info("cells of open buckets: %d", n_cells)
    told = reps.select("doc_id", "n", "bands", "sketch")

    def with_sketch(rows: DataFrame) -> DataFrame:
        return rows.join(told, "doc_id").withColumn("earlier", F.slice("bands", F.lit(1), F.col("band"))).drop("bands")

    def by_sketch(frame: pd.DataFrame) -> pd.DataFrame:
        """Pairs that would join the cell's components if all were links; if that left out any pair, all documents of pairs, too (y null)."""
        x, y = _sides(frame)
        pairs, joined, left_out, in_pairs = [], _Joined(), False, set()
        for r, near in _near_rows(x, y, percent) if len(x) and len(y) else ():
            one = int(x.doc_id.iloc[r])
            in_pairs.add(one)
            for k in near:
                other = int(y.doc_id.iloc[k])
                in_pairs.add(other)
                a, b = joined.roots(x.component.iloc[r], y.component.iloc[k])
                if a == b:
                    left_out = True
                else:
                    joined.link(a, b)
                    pairs.append((min(one, other), max(one, other)))
        rows = pairs + ([(d, None) for d in sorted(in_pairs)] if left_out else [])
        first = frame.iloc[0]
        return pd.DataFrame({"key": first.key, "kind": first.kind, "i": first.i, "j": first.j, "x": pd.array([r[0] for r in rows], "Int64"),
                             "y": pd.array([r[1] for r in rows], "Int64")})

    found = cut_lineage(with_sketch(cells).groupBy(*_CELL).applyInPandas(by_sketch, "key long, kind string, i long, j long, x long, y long"))
    pairs = cut_lineage(found.where("y IS NOT NULL").select("x", "y").distinct())
    links = _confirmed(pairs, docs, percent)
    # In a cell with a pair that is no link, pairs left out for it are still open: their documents are compared again, with their sets.
    wrong = pairs.join(links, ["x", "y"], "left_anti")
    doubtful = found.where("y IS NOT NULL").join(wrong, ["x", "y"], "left_semi").select(*_CELL).distinct()
    again = cut_lineage(found.where("y IS NULL").join(doubtful, _CELL, "left_semi").select(*_CELL, F.col("x").alias("doc_id")))
    if again.isEmpty():
        return links
    sets = _full_sets(again.select("doc_id"), docs)

    def by_sets(frame: pd.DataFrame) -> pd.DataFrame:
        x, y = _sides(frame)
        out, joined = [], _Joined()
        if len(x) and len(y):
            sx, sy = ([np.frombuffer(s, np.uint64) for s in f.shingles] for f in (x, y))
            for r, near in _near_rows(x, y, percent):
                one = int(x.doc_id.iloc[r])
                for k in near:
                    # What this cell has already joined needs no second link.
                    a, b = joined.roots(x.component.iloc[r], y.component.iloc[k])
                    if a != b and _alike(sx[r], sy[k], percent):
                        joined.link(a, b)
                        out.append((min(one, int(y.doc_id.iloc[k])), max(one, int(y.doc_id.iloc[k]))))
        return pd.DataFrame(out, columns=["x", "y"], dtype="int64")

    rows = with_sketch(cells.join(again, [*_CELL, "doc_id"], "left_semi")).join(sets, "doc_id")
    return cut_lineage(links.unionByName(rows.groupBy(*_CELL).applyInPandas(by_sets, "x long, y long")).distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    signed = cut_lineage(signatures(docs))
    real = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(real.groupBy("n", "a", "b").agg(F.min("doc_id").alias("rep")))
    # Rows that share a doc_id are one document, so all classes that hold it are linked by it.
    chosen = real.join(classes.withColumnRenamed("rep", "doc_id"), ["n", "a", "b", "doc_id"], "left_semi")
    reps = cut_lineage(chosen.select("doc_id", "n", "bands", "sketch"))
    entries = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    centres = cut_lineage(entries.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
                          .where("centre < last").select("key", "centre", "n"))
    shared = cut_lineage(entries.join(centres, "key").where("doc_id <> centre"))
    star = shared.select(F.col("centre").alias("x"), F.col("doc_id").alias("y")).distinct()
    links = _confirmed(cut_lineage(_promising(star, reps)), docs, percent)
    first = components(links)
    members = (shared.where("n > 2").select("key", "band", "doc_id")
               .join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left")
               .withColumn("component", F.coalesce("component", "doc_id")))
    more = _links_of_open_buckets(cut_lineage(members), reps, docs, percent)
    same_id = real.groupBy("doc_id").agg(F.min(F.struct("n", "a", "b")).alias("s"), F.max(F.struct("n", "a", "b")).alias("t")).where("s <> t")
    tied = (real.join(same_id.select("doc_id"), "doc_id", "left_semi").join(classes, ["n", "a", "b"])
            .select(F.col("doc_id").alias("x"), F.col("rep").alias("y")).where("x <> y"))
    final = components(links.unionByName(more).unionByName(tied))
    named = (signed.select("doc_id", "n", "a", "b").join(classes, ["n", "a", "b"], "left")
             .join(final.withColumnRenamed("node", "rep"), "rep", "left"))
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest doc_id, once. Rows without a
    doc_id stay."""
    groups = cut_lineage(near_duplicates(docs, percent).select("doc_id", "kept"))
    gone = cut_lineage(groups.where(~F.col("kept")).select("doc_id").distinct())
    left = docs.join(small_side(gone, MOST_IDS), "doc_id", "left_anti").select(docs.columns)
    kept, ids = groups.where("kept").agg(F.count("doc_id"), F.countDistinct("doc_id")).first()
    if kept == ids:
        return left
    return left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(left.where("doc_id IS NULL"))


def op10_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))


#: Hash bands, sketches and components: no SQL. Tests compare with all pairs in plain Python.
SQL = None
