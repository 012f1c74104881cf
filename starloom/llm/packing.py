"""Bounded-space online packing of documents into training sequences (op11).

Each task tokenizes its documents and packs them as they come, with at most ``windows`` open sequences:

* A document's ids and the end id make one run. Whole sequences' worth of it are emitted at once.
* The rest goes into the open window in which it leaves the least room (best fit).
* If it fits in none and fewer than ``windows`` are open, it opens one. Otherwise the fullest window is topped up with the
  beginning of the run, which the contract lets be cut anywhere, and emitted without padding; the rest is placed again.
* At the end of its input a task pours its emptiest windows into its fullest ones and keeps less than one sequence.

These leftovers, of less than ``capacity`` ids a task, are merged in rounds: each task of a round takes those of ``FAN_IN`` tasks,
in order, and again keeps less than one sequence, until one is left. That one is cut into sequences whose lengths are
powers of two, which need no padding. So no sequence is padded at all, and a document of n ids lies in few pieces.

Ids are those of the library for the vocabulary file. A faster encoder of the same vocabulary stands in for texts in the range of
characters where both are known to agree; texts with other characters or with a special token's string go to the library itself.

Defined cases: null and empty texts consist of the end id alone; repeated rows, also of one id, are packed each; very long
texts are encoded in stretches that end where a word must end, so a task holds one text's ids and ``windows`` sequences;
of equally good windows the oldest takes a run; an empty table gives an empty result; only ``doc_id`` and ``text`` are read, so
other columns may have any names. Pieces are stored before the merge, so a lost executor cannot change them.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starloom.llm.common import cut_lineage, load, slices

VOCABULARY = "byte_bpe_50k"
END_ID = 1
CAPACITY = 2048
#: Open windows of a task.
WINDOWS = 64
#: Tasks whose leftovers one task of a merging round takes.
FAN_IN = 256
#: Characters of a very long text that are encoded at a time.
STRETCH = 1 << 20

#: Beyond these characters, or with this string, a text goes to the library: ASCII, Latin letters, quotes and dashes.
_LIBRARY = re.compile(r"[^\x09-\x0D\x20-\x7E¡-ſ‐-‟…€]|<\|endoftext\|>")
#: A blank before a letter, after a non-blank: a pre-token ends there whatever surrounds it.
_SEAM = re.compile(r"(?<=\S) (?=[A-Za-z])")


class Encoder:
    """Token ids of whole texts; one per worker process."""

    _by_path: dict = {}

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None):
        import base64

        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(json_path)
        self.library.no_padding()
        self.library.no_truncation()
        self.fast = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding(json_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> Encoder:
        if json_path not in cls._by_path:
            cls._by_path[json_path] = cls(json_path, ranks_path, pattern)
        return cls._by_path[json_path]

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of a text, without added ones."""
        if not text:
            return np.zeros(0, "<u4")
        if self.fast is None or _LIBRARY.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        if len(text) <= STRETCH:
            return np.array(self.fast.encode_ordinary(text), "<u4")
        parts, start = [], 0
        while start < len(text):
            seam = _SEAM.search(text, start + STRETCH)
            end = seam.start() if seam else len(text)
            parts.append(np.array(self.fast.encode_ordinary(text[start:end]), "<u4"))
            start = end
        return np.concatenate(parts)


class Packer:
    """At most ``windows`` open sequences of ``capacity`` ids. A run is (doc, first, doc_tokens, ids): ids of a document from
    its id number ``first`` on. ``rows`` gathers the pieces of emitted sequences."""

    def __init__(self, capacity: int, windows: int, first_sequence: int):
        self.capacity, self.windows, self.next = capacity, windows, first_sequence
        self.room: list[tuple[int, int]] = []     # (free, window), in order
        self.open: dict[int, list] = {}           # window -> its runs
        self.opened = 0
        self.rows: list[tuple] = []

    def add(self, doc, first: int, total: int, ids: np.ndarray) -> None:
        at = 0
        while len(ids) - at >= self.capacity:
            self._emit([(doc, first + at, total, ids[at:at + self.capacity])])
            at += self.capacity
        while at < len(ids):
            n = len(ids) - at
            fit = bisect_left(self.room, (n, -1))
            if fit < len(self.room):
                free, window = self.room.pop(fit)
                self.open[window].append((doc, first + at, total, ids[at:].copy()))
                if free == n:
                    self._emit(self.open.pop(window))
                else:
                    insort(self.room, (free - n, window))
                return
            if len(self.room) < self.windows:
                self.open[self.opened] = [(doc, first + at, total, ids[at:].copy())]
                insort(self.room, (self.capacity - n, self.opened))
                self.opened += 1
                return
            free, window = self.room.pop(0)       # the fullest takes what it has room for
            self._emit([*self.open.pop(window), (doc, first + at, total, ids[at:at + free])])
            at += free

    def pour(self) -> list[tuple]:
        """Close all windows: the emptiest are poured into the fullest. Returns the runs of what is left, less than a sequence."""
        order = [window for _, window in self.room]
        room = {window: free for free, window in self.room}
        self.room, i, j = [], 0, len(order) - 1
        while i < j:
            full, empty = order[i], order[j]
            doc, first, total, ids = self.open[empty].pop()
            n = min(room[full], len(ids))
            # The end of the run moves, so that what stays keeps its place.
            self.open[full].append((doc, first + len(ids) - n, total, ids[len(ids) - n:]))
            if n < len(ids):
                self.open[empty].append((doc, first, total, ids[:len(ids) - n]))
            room[full] -= n
            room[empty] += n
            if not room[full]:
                self._emit(self.open.pop(full))
                i += 1
            if not self.open[empty]:
                self.open.pop(empty)
                j -= 1
        left = [run for window in order[i:j + 1] for run in self.open.pop(window)]
        if sum(len(run[3]) for run in left) == self.capacity:
            self._emit(left)
            left = []
        return left

    def powers_of_two(self, runs: list[tuple]) -> None:
        """Emit the runs in sequences whose lengths are the powers of two that add up to theirs."""
        size = sum(len(run[3]) for run in runs)
        for bit in reversed(range(size.bit_length())):
            if not size >> bit & 1:
                continue
            need, sequence = 1 << bit, []
            while need:
                doc, first, total, ids = runs.pop()
                n = min(need, len(ids))
                sequence.append((doc, first, total, ids[:n]))
                if n < len(ids):
                    runs.append((doc, first + n, total, ids[n:]))
                need -= n
            self._emit(sequence)

    def _emit(self, runs: list[tuple]) -> None:
        offset = 0
        for doc, first, total, ids in runs:
            self.rows.append((doc, first, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset, None, None))
            offset += len(ids)
        self.next += 1


def _sequences_of(level: int, task: int) -> int:
    """The first number of a task's sequences: level, task and a running number share the 63 bits."""
    return level << 58 | task << 32


def _pieces_type(doc_type: T.DataType) -> T.StructType:
    long = T.LongType()
    return T.StructType([T.StructField("doc_id", doc_type), *[T.StructField(n, long) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "task")], T.StructField("ids", T.BinaryType())])


def _batch(rows: list[tuple], kind: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kind)
    return pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, kind, strict=True)], kind.names)


def _left_rows(runs: list[tuple], task: int) -> list[tuple]:
    return [(doc, first, len(ids), None, total, None, None, task, ids.tobytes()) for doc, first, total, ids in runs]


def pack_documents(docs: DataFrame, encoder: tuple, end_id: int = END_ID, capacity: int = CAPACITY, windows: int = WINDOWS,
                   fan_in: int = FAN_IN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset. ``encoder`` holds the
    arguments of ``Encoder.of``."""
    kind = _pieces_type(docs.schema["doc_id"].dataType)

    def pack(batches):
        task = TaskContext.get().partitionId()
        tokens, packer = Encoder.of(*encoder), Packer(capacity, windows, _sequences_of(0, task))
        end = np.array([end_id], "<u4")
        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([tokens.ids(text), end])
                packer.add(doc, 0, len(ids), ids)
            yield _batch(packer.rows, kind)
            packer.rows = []
        yield _batch(_left_rows(packer.pour(), task) + packer.rows, kind)

    out = []
    packed = cut_lineage(docs.select("doc_id", "text").mapInArrow(pack, kind))
    level = 1
    while True:
        out.append(packed.where(F.col("ids").isNull()))
        left = packed.where(F.col("ids").isNotNull())
        last = left.agg(F.max("task"), F.count_distinct("task")).first()
        if not last[1]:
            break
        packed = cut_lineage(_merge(left, kind, capacity, windows, fan_in, level, last[1] <= fan_in))
        level += 1
    pieces = out[0]
    for more in out[1:]:
        pieces = pieces.unionByName(more)
    return pieces.drop("task", "ids")


def _merge(left: DataFrame, kind: T.StructType, capacity: int, windows: int, fan_in: int, level: int, final: bool) -> DataFrame:
    """A round of merging: the leftovers of ``fan_in`` tasks become sequences and one leftover; in the last round none."""
    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer = Packer(capacity, windows, _sequences_of(level, group))
        rows = sorted(table.to_pylist(), key=lambda r: (r["task"], str(r["doc_id"]), r["start"], r["ids"]))
        for r in rows:
            packer.add(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4"))
        runs = packer.pour()
        if final:
            packer.powers_of_two(runs)
            runs = []
        return pa.Table.from_batches([_batch(packer.rows + _left_rows(runs, group), kind)])

    group = F.lit(0).cast("long") if final else F.floor(F.col("task") / fan_in)
    return left.groupBy(group.alias("group")).applyInArrow(merge, kind)


def op11_pack_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    encoder = (public_tokenizers.path(f"{VOCABULARY}.json"), public_tokenizers.path(f"{VOCABULARY}.tiktoken"), public_tokenizers.PATTERN)
    return pack_documents(load(spark, sf_dir, "documents"), encoder)


#: SQL has no tokenizer; tests hold every document's ids against the library and check every sequence.
SQL = None
