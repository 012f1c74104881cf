"""Persisting job outputs.

``publish`` writes the tables of a run into a folder of their own, then swaps one pointer file: readers of ``current`` see all
tables of one version or all of another, also after a crash between two tables, and what they read stays until
``remove_versions`` finds it in none of the versions to keep. Tables that a run did not change are taken over by reference.

``write_tables`` writes each table as Parquet under ``<root>/<table>``.

Facts whose rows never move are partitioned by their date or month key, so readers prune by key. Rows of the
accumulating facts (``MOVING``) change their date key when they are recomputed, so those tables are not partitioned.
A written version replaces the whole table: partitions that a recomputation left empty do not survive, whatever the session's
``partitionOverwriteMode`` is. Dimensions and small tables are written whole, too. A job's outputs are only written after the
whole job succeeded, so a failed run leaves the previous version intact.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Made when they are read, from tables that are written.
LAZY = frozenset({"fact_daily_student_task_progress"})
MOVING = frozenset({"fact_child_snapshot_accumulation", "fact_donation_lifecycle"})
PARTITION_COLUMNS = ("date_key", "month_key", "snapshot_date_key")


def partition_column(df: DataFrame) -> str | None:
    for c in PARTITION_COLUMNS:
        if c in df.columns:
            return c
    return None


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """Write every frame; facts with a date/month key are partitioned by it. Returns the paths."""
    paths = {}
    for name, df in tables.items():
        if df is None or name in LAZY:
            continue
        path = f"{root.rstrip('/')}/{name}"
        w = df.write.mode(mode).option("partitionOverwriteMode", "static")
        part = partition_column(df) if name.startswith("fact_") and name not in MOVING else None
        if part:
            w = w.partitionBy(part)
        w.parquet(path)
        paths[name] = path
    return paths


def read_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in paths.items()}


# ------------------------------------------------------------------------------------ several tables at once
_POINTER, _HISTORY = "CURRENT", "_versions"


class _Files:
    """The few file operations of a root folder, through Spark's own file system for it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file beside ``name`` and rename it over it."""
        draft = self._path(f"{name}.{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        rename = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        qualified = [self._fs.makeQualified(p) for p in (draft, self._path(name))]
        context.rename(*qualified, options)

    def names(self, folder: str = "") -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def _pointer(files: _Files) -> dict:
    text = files.read(_POINTER)
    return json.loads(text) if text else {"version": 0, "tables": {}}


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> int:
    """Write ``tables`` as the next version under ``root``; other tables of the version before stay as they are. Returns its number. One
    writer at a time: a run that finds the pointer moved since it began fails and leaves it as it is."""
    files = _Files(spark, root)
    before = _pointer(files)
    folder = f"v-{before['version'] + 1:06d}-{uuid.uuid4().hex}"
    paths = write_tables(tables, f"{files.root}/{folder}")
    if _pointer(files)["version"] != before["version"]:
        raise RuntimeError(f"{root}: another run published version {_pointer(files)['version']} meanwhile")
    after = {"version": before["version"] + 1, "tables": {**before["tables"], **{n: f"{folder}/{n}" for n in paths}}}
    files.replace(f"{_HISTORY}/{after['version']:06d}.json", json.dumps(after))
    files.replace(_POINTER, json.dumps(after))
    return after["version"]


def current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the version that is published now; later versions do not change what these frames read."""
    files = _Files(spark, root)
    return read_tables(spark, {n: f"{files.root}/{p}" for n, p in _pointer(files)["tables"].items()})


def remove_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the last ``keep`` versions refers to, those of failed runs included, and return them. Not to be
    called while a run writes."""
    files = _Files(spark, root)
    version = _pointer(files)["version"]
    kept = [json.loads(files.read(f"{_HISTORY}/{v:06d}.json")) for v in range(max(1, version - keep + 1), version + 1)]
    used = {p.split("/")[0] for v in kept for p in v["tables"].values()}
    gone = [n for n in files.names() if n.startswith("v-") and n not in used]
    for name in gone:
        files.delete(name)
    for name in files.names(_HISTORY):
        if name.split(".")[0].isdigit() and int(name.split(".")[0]) not in {v["version"] for v in kept}:
            files.delete(f"{_HISTORY}/{name}")
    return gone
