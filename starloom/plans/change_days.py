"""Rows by the day of their change, so that a change window reads its days and no others (SC5, SC1).

``COALESCE(updated, created)`` is a column of no file, so a window on it is not pushed to the scan. Here a row lies in the block of the day of its
coalesced change time. A row that changes again moves: the block of its old day is written anew without it, and it is added to
that of its new day. Where a key's row lies is known from an index (key, row hash, day) in hash blocks, of which a load reads those of its
own keys; no load scans the rows to find what it replaces. ``window`` names the folders of the days between its bounds
before Spark plans the scan and then applies the exact predicate. ``days_per_block`` puts several days, counted from 1970-01-01, in a block (named by
its first day), for tables whose days are too small for files of their own.

The rows' version records the version of the index that belongs to it, and is swapped last: after a run that failed between the two the next one puts the
index back. Defined cases: a row without any change time lies in block ``none``, belongs to ``read()`` and to no window; a row with a NULL in its key
is inserted by every load; repeated ids of an extract count with their latest row; an empty extract changes nothing.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.loads import latest_of_extract
from starloom.plans.blocks import _ACTION, _BLOCK, _OLD, KEYS_BROADCAST_MAX_ROWS, BlockTable, Counts, Days, HashBlocks
from starloom.session import cut_lineage
from starloom.sources.watermark import change_window

_DAY = "change_day"


class ChangeDays:
    """A table below ``root`` by day of change. ``times`` are the columns of the change time, the first that is not NULL counts."""

    def __init__(self, spark: SparkSession, root: str, keys: tuple[str, ...] = ("id",), times: tuple[str, ...] = ("updated_at", "created_at"),
                 hash_col: str = "row_hash", index_blocks: int = 256, days_per_block: int = 1):
        self.keys, self.times, self.hash_col, self.days_per_block = list(keys), list(times), hash_col, days_per_block
        self._rows = _DayBlocks(spark, f"{root.rstrip('/')}/rows", times, Days(days_per_block), hash_col=hash_col)
        self._index = BlockTable(spark, f"{root.rstrip('/')}/index", keys, HashBlocks(index_blocks), hash_col=hash_col)

    def read(self) -> DataFrame | None:
        return self._rows.read()

    def days(self) -> list[str]:
        return self._rows.labels()

    def _label(self, moment: _dt.datetime) -> str:
        day = moment.date()
        return (day - _dt.timedelta(days=(day - _dt.date(1970, 1, 1)).days % self.days_per_block)).isoformat()

    def window(self, start: _dt.datetime, end: _dt.datetime) -> DataFrame | None:
        """SC5: rows whose change time is in [start, end), from the blocks of those days."""
        first, last = self._label(start), self._label(end)
        rows = self._rows.read([d for d in self._rows.labels() if first <= d <= last and d != "none"])
        return None if rows is None else change_window(rows, start, end, self.times)

    def upto(self, to_date: _dt.datetime) -> DataFrame | None:
        """SC1: rows whose change time is at or before ``to_date``."""
        day = self._label(to_date)
        rows = self._rows.read([d for d in self._rows.labels() if d <= day and d != "none"])
        return None if rows is None else rows.where(F.coalesce(*self.times) <= F.lit(to_date).cast("timestamp_ntz"))

    def remove_versions(self, keep: int = 2) -> list[str]:
        """Of the rows; of the index all versions stay that the kept ones need."""
        gone = self._rows.remove_versions(keep)
        needed = [v for v in self._rows.index_versions(keep) if v]
        if needed:
            self._index.remove_versions(self._index.version - min(needed) + 1)
        return gone

    def load(self, incoming: DataFrame) -> Counts:
        """K2 over days: rows of new keys and rows whose hash differs are written to the day of their change, and leave the day where they were."""
        version = self._rows._open()
        belongs = (version.note or {}).get("index", 0)
        if self._index.version != belongs:
            self._index.restore(belongs)
        self._rows._check(version, incoming)
        cols = incoming.columns
        rows = cut_lineage(self._rows._dealt(latest_of_extract(incoming, self.keys, self.times)))
        narrow = rows.select(*self.keys, self.hash_col, F.col(_BLOCK).alias(_DAY))
        listed = self._index._open()
        marked, blocks_read = self._index._mark(listed, narrow, (), [_DAY], unique=True)
        if _OLD + _DAY not in marked.columns:
            marked = marked.withColumn(_OLD + _DAY, F.lit(None).cast("string"))
        left = F.when(F.col(_ACTION) == "update", F.col(_OLD + _DAY))
        tally = marked.groupBy(_ACTION).count().collect()
        n = {a: 0 for a in ("insert", "update", "unchanged")} | {r[_ACTION]: r["count"] for r in tally}
        if not n["insert"] + n["update"]:
            return Counts(sum(n.values()), 0, 0, n["unchanged"], 0, tuple(blocks_read), ())
        old_days = sorted(r[0] for r in marked.where(left.isNotNull()).select(left).distinct().collect())     # one label per day
        into = sorted(r[0] for r in marked.where(F.col(_ACTION) != "unchanged").select(_DAY).distinct().collect())
        again = sorted(set(old_days) | {d for d in into if len(version.blocks.get(d, ())) >= BlockTable.MAX_FOLDERS})
        moved = marked.where(F.col(_ACTION) == "update").select(*self.keys)
        # Rows with a NULL key are inserts by definition; all others take their mark by key.
        known = F.lit(True)
        for k in self.keys:
            known = known & F.col(k).isNotNull()
        acts = marked.where(known & (F.col(_ACTION) != "unchanged")).select(*self.keys, _ACTION)
        out = rows.join(acts, self.keys).select(_BLOCK, *cols, _ACTION).unionByName(
            rows.where(~known).select(_BLOCK, *cols, F.lit("insert").alias(_ACTION)))
        if again:
            gone = F.broadcast(moved) if n["update"] <= KEYS_BROADCAST_MAX_ROWS else moved
            kept = self._rows._dealt(self._rows._read(version, again)).join(gone, self.keys, "left_anti")
            out = out.unionByName(kept.select(_BLOCK, *cols, F.lit("kept").alias(_ACTION)))
        folders, seen = self._rows._write(version, out)
        if (seen["insert"], seen["update"]) != (n["insert"], n["update"]):
            raise RuntimeError(f"wrote {seen}, marked {n}")
        blocks = {d: f for d, f in version.blocks.items() if d not in again}
        for day, folder in folders.items():
            blocks[day] = [*blocks.get(day, ()), folder]
        self._index._apply(listed, marked, blocks_read, narrow.columns)
        counts = Counts(sum(n.values()), n["insert"], n["update"], n["unchanged"], seen["rows"], tuple(again), tuple(sorted(set(again) | set(into))))
        self._rows._commit(version, blocks=blocks, schema=version.schema or incoming.schema.json(), counts=asdict(counts),
                           note={"index": self._index.version})
        return counts


class _DayBlocks(BlockTable):
    """Blocks by the day of the first time that is not NULL."""

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_BLOCK, F.coalesce(self.layout.label_of(F.coalesce(*self.keys)), F.lit("none")))

    def index_versions(self, keep: int) -> list[int]:
        now = self.version
        texts = [self._files.read(f"_versions/{v:06d}.json") for v in range(max(1, now - keep + 1), now + 1)]
        return [(json.loads(t).get("note") or {}).get("index", 0) for t in texts if t]
