"""Session helpers: a tuned session builder and lineage cutting.

Nothing here hard-codes a cluster path. The checkpoint folder is read from the
session (``spark.checkpoint.dir``); only a local-mode session without one gets a
fresh scratch folder, which is what tests need.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings that matter at scale; all can be overridden by the caller's builder.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoints that nothing refers to any more are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster[...] has executors of its own
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="starloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def checkpoint_rows(df: DataFrame) -> DataFrame:
    """Materialise ``df`` by Spark's own reliable checkpoint, which keeps its partitions and the order of rows within them. Its files
    hold whole rows without compression: for narrow rows, or where the next step works on the partitions as they are."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and return the re-read frame.

    Used where a plan is reused many times or where a later step must see exactly the
    same rows as an earlier one (surrogate keys, iterative SCD2 runs), so that a lost
    executor recomputes from the folder, not from a non-deterministic lineage.

    The folder holds compressed Parquet: the constant envelope of staged rows takes next to no room, and a reader fetches the
    columns that it asks for. Rows keep neither partitions nor order. What Parquet cannot hold is checkpointed.
    """
    return cut_in_parts([df])


def cut_in_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """``cut_lineage`` of the rows of several frames of one schema, which are written one after the other: the disk holds the shuffles of one
    part at a time. The next part is made when the one before is written."""
    paths, out = [], None
    name = f"{_WORK}{uuid.uuid4().hex}"
    for i, df in enumerate(parts):
        spark, schema = df.sparkSession, df.schema
        folder = ensure_checkpoint_dir(spark)
        if not _fits_parquet(schema):
            rows = checkpoint_rows(df)
            out = rows if out is None else out.unionByName(rows)
            continue
        paths.append(f"{folder}/{name}-{i}" if i else f"{folder}/{name}")
        with shuffles_removed(spark):
            df.write.options(**_WORK_OPTIONS).parquet(paths[-1])
    if paths:
        whole = out is None
        out = spark.read.schema(schema).parquet(*paths)
        out._work_folders = tuple(paths)
        if whole:
            out._work_schema = schema
    return out


def stored_parts(df: DataFrame) -> list[DataFrame]:
    """The rows of each of the frames that ``cut_in_parts`` wrote into ``df``, in their order; ``discard`` of one removes its files only."""
    parts = []
    for path in getattr(df, "_work_folders", ()) if hasattr(df, "_work_schema") else ():
        parts.append(df.sparkSession.read.schema(df._work_schema).parquet(path))
        parts[-1]._work_folders = (path,)
    return parts or [df]


def holding(df: DataFrame, *made_of: DataFrame) -> DataFrame:
    """``df``, made from frames that ``cut_lineage`` returned: ``discard`` of it removes their files."""
    df._work_folders = tuple(dict.fromkeys(f for x in (df, *made_of) if x is not None for f in getattr(x, "_work_folders", ())))
    return df


#: Pages of the second version hold sorted and sequential numbers, as ids and places are, as differences.
_WORK_OPTIONS = {"compression": "zstd", "parquet.writer.version": "v2"}
_WORK = "work-"
_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_REMOVING: dict[str, list] = {}
_REMOVING_LOCK = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that start inside have their shuffle files removed when they end, not when the JVM next collects garbage: a run that
    writes one work table after the other holds the shuffles of the current ones only. May be entered from several threads."""
    session = spark._jsparkSession.sessionUUID()
    with _REMOVING_LOCK:
        inside = _REMOVING.setdefault(session, [0, spark.conf.get(_REMOVE, None)])
        inside[0] += 1
        spark.conf.set(_REMOVE, "true")
    try:
        yield
    finally:
        with _REMOVING_LOCK:
            inside[0] -= 1
            if not inside[0]:
                del _REMOVING[session]
                if inside[1] is None:
                    spark.conf.unset(_REMOVE)
                else:
                    spark.conf.set(_REMOVE, inside[1])


def _fits_parquet(schema: StructType) -> bool:
    names = [f.name.lower() for f in schema.fields]
    odd = ("void", "interval", "variant")
    return bool(names) and len(set(names)) == len(names) and not any(t in f.dataType.simpleString() for f in schema.fields for t in odd)


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that ``cut_lineage`` or ``holding`` returned. Only for one that no frame still in use was made from."""
    spark = df.sparkSession
    for path in getattr(df, "_work_folders", ()):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def run_concurrently(tasks: dict, workers: int = 4) -> dict:
    """Run independent job builders from several driver threads; Spark schedules their jobs
    side by side, so small per-table jobs do not leave executors idle. Returns name -> result
    and re-raises the first failure."""
    from concurrent.futures import ThreadPoolExecutor
    if workers <= 1 or len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
