"""Prefix trie of conversations on adaptive radix trees (op12).

A turn (role, text) becomes a fixed-width id of 16 big-endian bytes, its MD5, and a conversation the string of its turns'
ids. The distinct strings are range-partitioned and sorted, so each task holds one stretch of the trie. It inserts them into
an adaptive radix tree (nodes of 4, 16, 48 or 256 children that grow as needed; bytes without a branch are compressed
into a node's prefix) and walks that tree in byte order. Only depths of whole turns emit trie nodes, so branches inside an id and
compressed stretches over several turns cost nothing of their own and lose no node.

Range partitions split a prefix that a third of all conversations share like any other. Trie nodes that reach over the end of
a partition are prefixes of its first or last string; each task is told its neighbours' strings, hence knows them. All
totals of a node are sums over partitions (a child, leaf or node that began in an earlier partition is not counted again), so
these few nodes are emitted as parts and added up afterwards; all others are final.

Equal conversations are one string with a count. Their ids are hashed as a sorted stream, which holds one id at a time.

Defined cases: rows without conv_id belong to no conversation; null roles and texts are empty; turns are ordered with nulls first, equal
turns by role, then by MD5, and repeated rows are turns of their own; a conversation may lose all its turns and then ends at the root; an empty
table has no nodes. A conversation's string, 16 bytes a turn, must fit a task; texts of any length are read once and
not shuffled. Extra columns are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import cut_lineage, load, small_side

#: Bytes of a turn's id.
WIDTH = 16
#: The shared beginnings of rebuilt conversations: of each block of so many ids, at most so many turns of its first one.
BLOCK, MOST_SHARED = 100, 5
#: Distinct conversations in a partition, about.
KEYS_PER_TASK = 50_000


# --- the adaptive radix tree ----------------------------------------------------------------------------------------------

class _Sorted:
    """Node layout of up to 4 or 16 children: their bytes in order, beside the children."""

    __slots__ = ("prefix", "value", "keys", "children", "size")

    def __init__(self, prefix: bytes, value=None, size: int = 4):
        self.prefix, self.value, self.size = prefix, value, size
        self.keys, self.children = bytearray(), []

    def get(self, byte: int):
        at = self.keys.find(byte)
        return self.children[at] if at >= 0 else None

    def put(self, byte: int, child) -> _Sorted | _Indexed:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.children[at] = child
            return self
        if len(self.keys) < self.size:
            self.keys.insert(at, byte)
            self.children.insert(at, child)
            return self
        grown = _Sorted(self.prefix, self.value, 16) if self.size == 4 else _Indexed(self.prefix, self.value)
        for k, c in self.items():
            grown = grown.put(k, c)
        return grown.put(byte, child)

    def items(self) -> Iterator[tuple]:
        return zip(self.keys, self.children, strict=True)


class _Indexed:
    """Node layout of up to 48 children: a byte's entry in ``index`` is its child's place, from 1 on."""

    __slots__ = ("prefix", "value", "index", "children")

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value = prefix, value
        self.index, self.children = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, child) -> _Indexed | _Direct:
        at = self.index[byte]
        if at:
            self.children[at - 1] = child
            return self
        if len(self.children) < 48:
            self.children.append(child)
            self.index[byte] = len(self.children)
            return self
        grown = _Direct(self.prefix, self.value)
        for k, c in self.items():
            grown.put(k, c)
        return grown.put(byte, child)

    def items(self) -> Iterator[tuple]:
        return ((k, self.children[at - 1]) for k, at in enumerate(self.index) if at)


class _Direct:
    """Node layout of up to 256 children, one place for each byte."""

    __slots__ = ("prefix", "value", "children")

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value = prefix, value
        self.children = [None] * 256

    def get(self, byte: int):
        return self.children[byte]

    def put(self, byte: int, child) -> _Direct:
        self.children[byte] = child
        return self

    def items(self) -> Iterator[tuple]:
        return ((k, c) for k, c in enumerate(self.children) if c is not None)


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    """Byte strings with values; one string may be a prefix of another."""

    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = _Sorted(key, value)
            return
        node, above, byte, at = self.root, None, 0, 0
        while True:
            rest = key[at:at + len(node.prefix)]
            same = _common(node.prefix, rest)
            if same < len(node.prefix):      # the compressed prefix splits here
                fork = _Sorted(node.prefix[:same])
                down = node.prefix[same]
                node.prefix = node.prefix[same + 1:]
                fork = fork.put(down, node)
                at += same
                if at == len(key):
                    fork.value = value
                else:
                    fork = fork.put(key[at], _Sorted(key[at + 1:], value))
                self._replace(above, byte, fork)
                return
            at += same
            if at == len(key):
                node.value = value
                return
            child = node.get(key[at])
            if child is None:
                grown = node.put(key[at], _Sorted(key[at + 1:], value))
                if grown is not node:
                    self._replace(above, byte, grown)
                return
            above, byte, node, at = node, key[at], child, at + 1

    def _replace(self, above, byte: int, node) -> None:
        if above is None:
            self.root = node
        else:
            above.put(byte, node)            # the byte has a place already: no growth

    def walk(self) -> Iterator[tuple[int, bytes, object]]:
        """(bytes shared with the string before it, the bytes beyond them, value) of each string, in order."""
        if self.root is None:
            return
        stack, key, shared = [(self.root, 0, b"")], bytearray(), 0   # nodes with the depth of their edge
        while stack:
            node, depth, edge = stack.pop()
            shared = min(shared, depth)
            del key[depth:]
            key += edge + node.prefix
            if node.value is not None:
                yield shared, bytes(key[shared:]), node.value
                shared = len(key)
            depth = len(key)
            stack.extend((c, depth, bytes((k,))) for k, c in reversed(list(node.items())))


# --- trie nodes of one partition ------------------------------------------------------------------------------------------

NODE = ("node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _digest(prefix: bytes) -> bytes:
    return hashlib.md5(prefix).digest()


class _Open:
    """A trie node on the path to the string at hand."""

    __slots__ = ("depth", "length", "convs", "least", "children", "inner", "leaves", "saved", "ends", "shared", "continues", "waiting")

    def __init__(self, depth: int, length: int, shared: bool, continues: bool):
        self.depth, self.length, self.shared, self.continues = depth, length, shared, continues
        self.convs = self.children = self.leaves = self.saved = 0
        self.inner, self.least, self.ends, self.waiting = False, None, NO_ENDS, []

    @property
    def in_parts(self) -> bool:
        return self.shared or self.continues

    def count(self, convs: int, least: int) -> None:
        self.convs += convs
        self.least = least if self.least is None else min(self.least, least)


def trie_nodes(tree: RadixTree, before: bytes | None, after: bytes | None) -> Iterator[tuple]:
    """Rows of ``NODE`` for the strings of a partition, whose values are (n, least id, hash of ids, lengths of turns). ``before`` and
    ``after`` are the neighbouring partitions' last and first strings. ``node`` is the digest of a node that has other parts,
    ``parent`` that of a parent that has."""
    path: list[_Open] = []
    key = bytearray()

    def close(keep: int) -> Iterator[tuple]:
        while len(path) > keep:
            n = path.pop()
            n.saved += (n.convs - (not n.shared)) * n.length
            if not n.inner and not n.continues:
                n.leaves = 1
            for row in n.waiting:       # a parent in parts has none waiting
                yield (*row[:4], n.least, *row[5:])
            name = _digest(bytes(key[:n.depth * WIDTH])) if n.in_parts else None
            row = (name, None, n.least, n.depth, None, n.convs, n.children, n.leaves, n.saved, n.ends)
            if not path:
                yield row
                return
            up = path[-1]
            up.count(n.convs, n.least)
            up.inner = True
            up.children += not n.shared
            up.leaves += n.leaves
            up.saved += n.saved
            if up.in_parts:
                yield (name, _digest(bytes(key[:up.depth * WIDTH])), *row[2:])
            else:
                up.waiting.append(row)

    for shared, rest, (n, least, ends, lengths) in tree.walk():
        yield from close(shared // WIDTH + 1)
        del key[shared:]
        key += rest
        whole = bytes(key)
        # Depths up to these lie on a neighbour's path, too.
        reach_before = _common(whole, before) // WIDTH if before is not None else -1
        reach_after = _common(whole, after) // WIDTH if after is not None else -1
        for depth in range(len(path), len(whole) // WIDTH + 1):
            path.append(_Open(depth, lengths[depth - 1] if depth else 0, depth <= reach_before, depth <= reach_after))
        path[-1].count(n, least)
        path[-1].ends = ends
    yield from close(0)


# --- on Spark -------------------------------------------------------------------------------------------------------------

def _parts(turns: Column, field: str) -> Column:
    return F.transform(turns, lambda t: t[field])


def rebuilt_conversations(conversations: DataFrame, block: int = BLOCK, most_shared: int = MOST_SHARED) -> DataFrame:
    """conv_id, key (ids of the rebuilt turns, one string) and lengths (code points of their texts): the first h turns of the
    first conversation of the block, then the conversation's own after its first h."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn_id = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", role.alias("role"), turn_id.alias("id"), F.char_length(text).alias("length")).alias("t"))

    def sequences(df: DataFrame) -> DataFrame:
        own = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["length"].alias("length")))
        return df.groupBy("conv_id").agg(own.alias("own"))

    heads = sequences(rows.where(F.col("conv_id") % block == 0)).select(
        F.col("conv_id").alias("first_id"), F.slice("own", 1, most_shared).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most_shared + 1)).cast("int")
    both = sequences(rows).withColumn("h", h).join(heads, F.col("conv_id") - F.col("conv_id") % block == F.col("first_id"), "left")
    none = F.array().cast("array<struct<id:string,length:int>>")
    shared = F.when(F.col("head").isNotNull(), F.slice("head", 1, F.col("h"))).otherwise(none)
    kept = F.when(F.size("own") > F.col("h"), F.slice("own", F.col("h") + 1, F.size("own"))).otherwise(none)
    turns = both.select("conv_id", F.concat(shared, kept).alias("turns"))
    return turns.select("conv_id", F.unhex(F.array_join(_parts(F.col("turns"), "id"), "")).alias("key"),
                        _parts(F.col("turns"), "length").alias("lengths"))


def distinct_keys(rebuilt: DataFrame) -> DataFrame:
    """key, n, least, ends (SHA-256 of the sorted conv_ids) and lengths of each distinct string."""
    def run(batches):
        last, state = None, None
        out: list[tuple] = []
        for batch in batches:
            keys, ids, lengths = (batch.column(n) for n in ("key", "conv_id", "lengths"))
            for i, (key, conv) in enumerate(zip(keys.to_pylist(), ids.to_pylist(), strict=True)):
                if key == last:
                    state[0] += 1
                    state[2].update(b",%d" % conv)
                    continue
                if state:
                    out.append((last, state[0], state[1], state[2].hexdigest(), state[3]))
                last, state = key, [1, conv, hashlib.sha256(b"%d" % conv), lengths[i].as_py()]
            if out:
                yield _rows(out, KEYS)
                out = []
        if state:
            yield _rows([(last, state[0], state[1], state[2].hexdigest(), state[3])], KEYS)

    spread = rebuilt.withColumn("h", F.xxhash64("key"))
    return spread.repartition("h").sortWithinPartitions("h", "key", "conv_id").select("key", "conv_id", "lengths").mapInArrow(run, KEYS)


KEYS = "key binary, n long, least long, ends string, lengths array<int>"
_KINDS = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "int": pa.int32()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)], list(names))


def _neighbours(keys: DataFrame) -> dict[int, tuple[bytes | None, bytes | None]]:
    """For each partition that has strings, the last one before it and the first one after it: two strings a partition."""
    def ends(batches):
        first = last = None
        for batch in batches:
            if batch.num_rows:
                column = batch.column(0)
                first = column[0].as_py() if first is None else first
                last = column[batch.num_rows - 1].as_py()
        if first is not None:
            yield _rows([(TaskContext.get().partitionId(), first, last)], "task int, first binary, last binary")

    found = sorted((r.task, bytes(r.first), bytes(r.last)) for r in keys.select("key").mapInArrow(ends, "task int, first binary, last binary").collect())
    return {task: (found[i - 1][2] if i else None, found[i + 1][1] if i + 1 < len(found) else None) for i, (task, _, _) in enumerate(found)}


def prefix_trie(conversations: DataFrame, keys_per_task: int = KEYS_PER_TASK, block: int = BLOCK, most_shared: int = MOST_SHARED) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    distinct = cut_lineage(distinct_keys(rebuilt_conversations(conversations, block, most_shared)))
    found = distinct.count()
    tasks = max(1, -(-found // keys_per_task), min(spark.sparkContext.defaultParallelism, found // 1_000))
    ordered = cut_lineage(distinct.repartitionByRange(tasks, "key").sortWithinPartitions("key"))
    around = spark.sparkContext.broadcast(_neighbours(ordered))

    def build(batches):
        tree = RadixTree()
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree.insert(r[0], r[1:])
        if tree.root is None:
            return
        out = []
        for row in trie_nodes(tree, *around.value[TaskContext.get().partitionId()]):
            out.append(row)
            if len(out) == 10_000:
                yield _rows(out, NODE)
                out = []
        yield _rows(out, NODE)

    nodes = cut_lineage(ordered.mapInArrow(build, NODE))
    # The few nodes with parts: at most two paths a partition.
    in_parts = nodes.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends_sha256"))
    in_parts = cut_lineage(in_parts)
    whole = nodes.where(F.col("node").isNull()).unionByName(in_parts)
    parents = small_side(in_parts.select(F.col("node").alias("up"), F.col("conv_id").alias("up_conv_id")))
    named = whole.join(parents, F.col("parent") == F.col("up"), "left")
    return named.select("conv_id", "depth", F.coalesce("parent_conv_id", "up_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", "saved_tokens", "ends_sha256")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(load(spark, sf_dir, "conversations"))


#: DuckDB SQL for op12. ``crc`` spells out the CRC-32 of the decimal ids; a node is a distinct list of turns, its subtree the
#: distinct longer lists of its members.
SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) r(b)),
turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT)),
                                  lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, length(text) AS len,
         md5(CAST(length(role) AS VARCHAR) || ':' || role || text) AS id
  FROM rebuilt),
paths AS (
  SELECT conv_id, 0 AS depth, 0 AS len, '' AS path FROM convs
  UNION ALL
  SELECT conv_id, depth, len, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth) FROM placed),
ends AS (SELECT conv_id, max(depth) AS last FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, any_value(p.depth) AS depth, any_value(len) AS len, min(p.conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (p.depth = e.last), '')) AS ends_sha256
  FROM paths p JOIN ends e USING (conv_id) GROUP BY path),
children AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT v.path, sum((u.n_convs - 1) * u.len) AS saved_tokens, count(*) FILTER (c.path IS NULL) AS n_leaves
  FROM (SELECT DISTINCT a.path, b.path AS down FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth) v
  JOIN nodes u ON u.path = v.down LEFT JOIN children c ON c.path = v.down GROUP BY v.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN children c USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)
"""
