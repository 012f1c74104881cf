"""Tables in blocks: a load reads and writes the blocks that it changes, not the table.

Rows are dealt to blocks by their key alone: by ranges of a whole-number id (``IdRanges``; new and recently changed ids, which is what an
incremental extract holds, lie in few blocks) or by a hash (``HashBlocks``; evenly, whatever the key is). Each block is one or more
immutable folders; a version of the table is a file that lists the folders of every block, and one pointer file names the version that
readers get. A load

1. finds the blocks that its extract's keys belong to and reads key, hash and row id of those only;
2. marks each row of the extract as insert, update or unchanged;
3. rewrites the blocks with an insert or update (``upsert``) or adds a folder to them (``append``), all others being taken over by
   reference; a load without changes writes no row;
4. swaps the pointer. A run that fails leaves readers at the version before; ``remove_versions`` deletes what no version refers to.

What reaches the driver is a label and three counts per touched block; the number of blocks is fixed (``HashBlocks``) or the largest id by the width
(``IdRanges``), so choose a width that keeps it to some ten thousand. Written rows are rebalanced by block: small blocks share a
task, a large one is split over several. Counts of what was written come from the writing job itself (``observe``) and must agree with what was marked.

Defined cases: repeated ids of an extract count with their latest row (``order_cols``, then all columns); a row with a NULL in its key is no id,
lies in block ``none`` and is inserted by every ``upsert`` (``append(null_safe=True)`` compares it like a value); an empty extract changes nothing;
an extract whose columns or types differ from the table's is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.operators.keys import assign_keys, sortable_columns
from starloom.operators.loads import append_new, latest_of_extract
from starloom.operators.lookups import latest_per_key
from starloom.plans.tables import _Files
from starloom.session import cut_lineage

_BLOCK, _ACTION, _OLD = "_block", "_action", "_old_"
_NO_BLOCK = "none"
#: Narrow keys of updated rows are broadcast up to this many.
KEYS_BROADCAST_MAX_ROWS = 200_000


@dataclass(frozen=True)
class HashBlocks:
    """``n`` blocks by a hash of all key columns."""
    n: int = 256

    def label(self, keys: list[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.n)).cast("string")


@dataclass(frozen=True)
class IdRanges:
    """Blocks of ``width`` consecutive values of the first key column, a whole number."""
    width: int = 10_000_000

    def label(self, keys: list[str]) -> Column:
        return F.floor(F.col(keys[0]) / F.lit(self.width)).cast("string")


@dataclass(frozen=True)
class Days:
    """Blocks of ``days`` days, counted from 1970-01-01, of the first key column, a date or timestamp; named by their first day."""
    days: int = 1

    def label_of(self, moment: Column) -> Column:
        day = moment.cast("date")
        return F.date_format(F.date_sub(day, F.pmod(F.datediff(day, F.lit("1970-01-01").cast("date")), F.lit(self.days))), "yyyy-MM-dd")

    def label(self, keys: list[str]) -> Column:
        return self.label_of(F.col(keys[0]))


@dataclass(frozen=True)
class Counts:
    """What one load did. ``blocks_read`` and ``blocks_written`` are the labels of blocks."""
    rows_read: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_unchanged: int = 0
    rows_written: int = 0
    blocks_read: tuple = ()
    blocks_written: tuple = ()


@dataclass(frozen=True)
class _Version:
    version: int = 0
    blocks: dict = field(default_factory=dict)      # label -> folders below the root
    schema: str | None = None
    last_id: int = 0
    tag: int | None = None
    layout: tuple | None = None
    counts: dict | None = None
    note: dict | None = None


class BlockTable:
    """One table below ``root``. ``keys`` identify a row and ``layout`` deals them; the layout of a table that exists must be the one it was made with.

    ``row_id`` names a column of gap-free numbers that the table gives to new rows and that updates keep. ``append`` needs neither it nor
    ``hash_col``.
    """

    #: A block that appends have split into this many folders is written anew with the next one.
    MAX_FOLDERS = 8

    def __init__(self, spark: SparkSession, root: str, keys: tuple[str, ...] = ("id",), layout=HashBlocks(),
                 row_id: str | None = None, hash_col: str = "row_hash", valid_col: str | None = None):
        self.spark, self.keys, self.layout = spark, list(keys), layout
        self.row_id, self.hash_col, self.valid_col = row_id, hash_col, valid_col
        self._files = _Files(spark, root)

    # ------------------------------------------------------------------------------------------------- versions
    def _open(self) -> _Version:
        text = self._files.read("CURRENT")
        if not text:
            return _Version()
        found = _Version(**json.loads(text))
        if list(found.layout) != self._layout():
            raise ValueError(f"{self._files.root}: dealt by {found.layout}, not by {self._layout()}")
        return found

    def _layout(self) -> list:
        return [type(self.layout).__name__, asdict(self.layout), self.keys]

    def _commit(self, before: _Version, **changes) -> None:
        now = self._open().version
        if now != before.version:
            raise RuntimeError(f"{self._files.root}: another run wrote version {now} meanwhile")
        after = {**asdict(before), **changes, "version": before.version + 1, "layout": self._layout()}
        self._files.replace(f"_versions/{after['version']:06d}.json", json.dumps(after))
        self._files.replace("CURRENT", json.dumps(after))

    @property
    def tag(self) -> int | None:
        """The tag of the last load that had one."""
        return self._open().tag

    @property
    def version(self) -> int:
        return self._open().version

    def restore(self, version: int) -> int:
        """Make an earlier version that was not removed (0: the empty table) current again, as a new version; returns its number."""
        now = self._open()
        text = self._files.read(f"_versions/{version:06d}.json") if version else None
        if version and not text:
            raise ValueError(f"{self._files.root}: no version {version}")
        then = _Version(**json.loads(text)) if version else _Version()
        self._commit(now, **{k: v for k, v in asdict(then).items() if k not in ("version", "layout")})
        return now.version + 1

    def labels(self) -> list[str]:
        return sorted(self._open().blocks)

    def folders(self) -> dict[str, list[str]]:
        return dict(self._open().blocks)

    def _read(self, version: _Version, labels) -> DataFrame | None:
        if version.schema is None:
            return None
        schema = StructType.fromJson(json.loads(version.schema))
        paths = [f"{self._files.root}/{p}" for b in labels for p in version.blocks.get(b, ())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, labels: list[str] | None = None) -> DataFrame | None:
        """The rows of the version that is current now, or those of some blocks; None before the first load."""
        version = self._open()
        return self._read(version, version.blocks if labels is None else labels)

    def remove_versions(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last ``keep`` versions refers to, those of failed runs included. Not while a run writes."""
        now = self._open().version
        kept = [json.loads(self._files.read(f"_versions/{v:06d}.json")) for v in range(max(1, now - keep + 1), now + 1)]
        used = {p for v in kept for folders in v["blocks"].values() for p in folders}
        gone = []
        for load in [n for n in self._files.names() if n.startswith("b-")]:
            parts = [n for n in self._files.names(load) if n.startswith(f"{_BLOCK}=")]
            stale = [f"{load}/{n}" for n in parts if f"{load}/{n}" not in used]
            gone += [load] if len(stale) == len(parts) else stale
        for name in gone:
            self._files.delete(name)
        for name in self._files.names("_versions"):
            if name.endswith(".json") and int(name.split(".")[0]) <= now - keep:
                self._files.delete(f"_versions/{name}")
        return gone

    # ------------------------------------------------------------------------------------------------- loads
    def _dealt(self, df: DataFrame) -> DataFrame:
        known = F.lit(True)
        for k in self.keys:
            known = known & F.col(k).isNotNull()
        return df.withColumn(_BLOCK, F.when(known, self.layout.label(self.keys)).otherwise(F.lit(_NO_BLOCK)))

    def _labels_of(self, rows: DataFrame) -> list[str]:
        return sorted(r[0] for r in rows.select(_BLOCK).distinct().collect())      # one label per block

    def _check(self, version: _Version, df: DataFrame) -> None:
        if version.schema is None:
            return
        have = {f.name: f.dataType for f in StructType.fromJson(json.loads(version.schema)).fields if f.name != self.row_id}
        got = {f.name: f.dataType for f in df.schema.fields if f.name != self.row_id}
        if have != got:
            odd = sorted(set(map(str, have.items())) ^ set(map(str, got.items())))
            raise ValueError(f"{self._files.root}: columns differ from the table's: {odd}")

    def _write(self, version: _Version, rows: DataFrame) -> tuple[dict, dict]:
        """Write rows (with block and action) below a new folder; returns label -> folder and what the job observed."""
        folder = f"b-{version.version + 1:06d}-{uuid.uuid4().hex}"
        seen = Observation()
        action = F.col(_ACTION)
        (rows.hint("rebalance", _BLOCK)
             .observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(action == "insert", 1)).alias("insert"),
                      F.count(F.when(action == "update", 1)).alias("update"))
             .drop(_ACTION).write.option("compression", "zstd").partitionBy(_BLOCK).parquet(f"{self._files.root}/{folder}"))
        prefix = f"{_BLOCK}="
        return {n[len(prefix):]: f"{folder}/{n}" for n in self._files.names(folder) if n.startswith(prefix)}, seen.get

    def _done(self, tag: int | None, version: _Version) -> Counts | None:
        if tag is None or version.tag is None or version.tag < tag:
            return None
        if version.tag > tag:
            return Counts()
        return Counts(**{k: tuple(v) if isinstance(v, list) else v for k, v in version.counts.items()})

    def _mark(self, version: _Version, incoming: DataFrame, order_cols, carried: list[str], unique: bool = False) -> tuple[DataFrame, list[str]]:
        """The latest row per id of an extract with its block, what it is (insert, update, unchanged) and, as ``_old_<name>``, columns of the row it
        meets; and the labels of the blocks that were read for it. An extract that is ``unique`` has one row per id and is a stored table."""
        self._check(version, incoming)
        cols = incoming.columns
        rows = self._dealt(incoming) if unique else cut_lineage(self._dealt(latest_of_extract(incoming, self.keys, list(order_cols))))
        present = [b for b in self._labels_of(rows) if b in version.blocks]
        if not present:
            return rows.withColumn(_ACTION, F.lit("insert")), present
        extra = [c for c in [self.hash_col, self.valid_col, *carried] if c]
        narrow = self._read(version, present).select(*[F.col(c).alias(f"{_OLD}key_{c}") for c in self.keys], *[F.col(c).alias(_OLD + c) for c in extra])
        was = {c: F.col(_OLD + c) for c in extra}
        differs = F.col(self.hash_col).isNull() | was[self.hash_col].isNull() | (F.col(self.hash_col) != was[self.hash_col])
        if self.valid_col:
            differs = differs | ~F.coalesce(was[self.valid_col], F.lit(False))
        same = F.lit(True)
        for k in self.keys:
            same = same & (F.col(k) == F.col(f"{_OLD}key_{k}"))
        found = F.when(F.col(f"{_OLD}key_{self.keys[0]}").isNull(), "insert").when(differs, "update").otherwise("unchanged")
        return cut_lineage(rows.join(narrow, same, "left").select(_BLOCK, *cols, *[was[c] for c in carried], found.alias(_ACTION))), present

    def upsert(self, incoming: DataFrame, order_cols: tuple[str, ...] = (), tag: int | None = None) -> Counts:
        """K2: rows whose hash differs (or is NULL, or whose old row is invalid) replace the old row and keep its row id; rows of new keys are
        inserted; others stay as they are. A load whose ``tag`` is not above the table's last one was done before and is not repeated."""
        version = self._open()
        if (done := self._done(tag, version)) is not None:
            return done
        cols = [c for c in incoming.columns if c != self.row_id]
        carried = [self.row_id] if self.row_id else []
        marked, present = self._mark(version, incoming.select(*cols), order_cols, carried)
        return self._apply(version, marked, present, cols, tag)

    def _apply(self, version: _Version, marked: DataFrame, present: list[str], cols: list[str], tag: int | None = None) -> Counts:
        """Write what ``_mark`` found in the blocks ``present`` of this version."""
        carried = [self.row_id] if self.row_id else []
        old = bool(present)
        tally = marked.groupBy(_BLOCK).agg(*[F.count(F.when(F.col(_ACTION) == a, 1)).alias(a) for a in ("insert", "update", "unchanged")]).collect()
        n = {a: sum(r[a] for r in tally) for a in ("insert", "update", "unchanged")}
        changed = sorted(r[_BLOCK] for r in tally if r["insert"] or r["update"])
        schema, last_id, blocks, written = version.schema, version.last_id, dict(version.blocks), 0
        if changed:
            inserts = marked.where(F.col(_ACTION) == "insert").select(_BLOCK, *cols)
            if self.row_id:
                inserts = assign_keys(inserts, self.keys, self.row_id, base=last_id, known_rows=n["insert"])
            out = [inserts.select(_BLOCK, *carried, *cols, F.lit("insert").alias(_ACTION))]
            if old:
                updates = marked.where(F.col(_ACTION) == "update")
                if self.row_id:
                    updates = updates.withColumnRenamed(_OLD + self.row_id, self.row_id)
                gone = updates.select(*self.keys)
                kept = self._dealt(self._read(version, changed)).join(
                    F.broadcast(gone) if n["update"] <= KEYS_BROADCAST_MAX_ROWS else gone, self.keys, "left_anti")
                out += [updates.select(_BLOCK, *carried, *cols, _ACTION), kept.select(_BLOCK, *carried, *cols, F.lit("kept").alias(_ACTION))]
            rewritten = out[0]
            for part in out[1:]:
                rewritten = rewritten.unionByName(part)
            if schema is None:
                schema = rewritten.drop(_BLOCK, _ACTION).schema.json()
            folders, seen = self._write(version, rewritten)
            if (seen["insert"], seen["update"]) != (n["insert"], n["update"]):
                raise RuntimeError(f"{self._files.root}: wrote {seen}, marked {n}")
            blocks |= {b: [p] for b, p in folders.items()}
            last_id, written = last_id + n["insert"], seen["rows"]
        counts = Counts(sum(n.values()), n["insert"], n["update"], n["unchanged"], written, tuple(present), tuple(changed))
        if changed or tag is not None:
            self._commit(version, blocks=blocks, schema=schema, last_id=last_id, counts=asdict(counts), tag=version.tag if tag is None else tag)
        return counts

    def append(self, candidates: DataFrame, null_safe: bool = False, distinct: bool = False, tag: int | None = None) -> Counts:
        """Candidates whose key the table does not have yet are added; ``distinct`` keeps one row per key of the candidates (the greatest by all
        columns). Old rows are not written again, but for blocks in ``MAX_FOLDERS`` folders, which become one."""
        version = self._open()
        if (done := self._done(tag, version)) is not None:
            return done
        self._check(version, candidates)
        if distinct:
            order = [c for c in sortable_columns(candidates) if c not in self.keys]
            candidates = latest_per_key(candidates, self.keys, order) if order else candidates.dropDuplicates(self.keys)
        rows = cut_lineage(self._dealt(candidates))
        touched = self._labels_of(rows)
        present = [b for b in touched if b in version.blocks]
        n_read = rows.count()
        new = rows
        if present:
            new = append_new(rows, self._read(version, present).select(*self.keys), self.keys, null_safe)
        new = cut_lineage(new.withColumn(_ACTION, F.lit("insert")))
        into = self._labels_of(new)
        if not into:
            counts = Counts(n_read, 0, 0, n_read, 0, tuple(present), ())
            if tag is not None:
                self._commit(version, counts=asdict(counts), tag=tag)
            return counts
        schema = version.schema or new.drop(_BLOCK, _ACTION).schema.json()
        full = [b for b in into if len(version.blocks.get(b, ())) >= self.MAX_FOLDERS]
        if full:
            kept = self._dealt(self._read(version, full)).withColumn(_ACTION, F.lit("kept"))
            new = new.unionByName(kept)
        folders, seen = self._write(version, new)
        blocks = dict(version.blocks)
        for b, path in folders.items():
            blocks[b] = [path] if b in full else [*blocks.get(b, ()), path]
        counts = Counts(n_read, seen["insert"], 0, n_read - seen["insert"], seen["rows"], tuple(present), tuple(into))
        self._commit(version, blocks=blocks, schema=schema, counts=asdict(counts), tag=version.tag if tag is None else tag)
        return counts
