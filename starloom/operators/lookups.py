"""Joins of the loaders: latest version, dimension lookups with the unknown member.

Lookups are plain equi-joins. Small dimensions get broadcast by AQE from their
measured runtime size (``spark.sql.adaptive.autoBroadcastJoinThreshold``); large ones
stay sort-merge. Per-key "top 1" is a ``max_by`` aggregate, which combines map-side,
so a hot key never lands whole in one task.
"""

from __future__ import annotations

import threading
import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import UNKNOWN_KEY

# A dimension side is broadcast only after a bounded count proves it has at most this many
# rows (the de-duplicated (natural key, key) pairs: tens of bytes per row). Larger dimensions
# use a shuffle join, where AQE's skew-join splitting protects against hot fact keys.
DIM_BROADCAST_MAX_ROWS = 1_000_000


_ROWS_SEEN: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()
_ROWS_LOCK = threading.Lock()      # jobs may be built from several driver threads


#: Up to this bound a count stops early: the rows up to it are moved to one task, which costs more than counting all when they are many.
STOPS_EARLY_ROWS = 200_000


def bounded_count(df: DataFrame, max_rows: int) -> int:
    """Rows of ``df`` counted up to max_rows + 1 (the scan of a small bound stops early); cached per frame object."""
    with _ROWS_LOCK:
        cached = _ROWS_SEEN.get(df)
    if cached is not None and cached[0] >= max_rows:
        return min(cached[1], max_rows + 1)
    whole = max_rows > STOPS_EARLY_ROWS
    n = df.count() if whole else df.limit(max_rows + 1).count()
    with _ROWS_LOCK:
        _ROWS_SEEN[df] = (float("inf") if whole else max_rows, n)
    return min(n, max_rows + 1)


def checked_broadcast(df: DataFrame, max_rows: int = DIM_BROADCAST_MAX_ROWS,
                      bound_by: DataFrame | None = None) -> DataFrame:
    """Broadcast ``df`` if a bounded count proves it small. ``bound_by`` may name a frame known to
    have at least as many rows (e.g. the dimension a de-duplicated lookup side comes from)."""
    if max_rows is None or max_rows <= 0:
        return df
    n = bounded_count(bound_by if bound_by is not None else df, max_rows)
    return F.broadcast(df) if n <= max_rows else df


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per ``keys`` (MAX(stg_row_id) self-join)."""
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    best = F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_sl_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_sl_best.*").select(*df.columns)


def dedup_dim(dim: DataFrame, nk: list[str], key_col: str, pick: str = "min") -> DataFrame:
    """One key per natural key: MIN(key) (oldest) or MAX(key) (newest)."""
    agg = F.min(key_col) if pick == "min" else F.max(key_col)
    return dim.groupBy(*nk).agg(agg.alias(key_col))


def lookup_key(fact: DataFrame, dim: DataFrame, on: dict[str, str] | list, key_col: str,
               out_col: str | None = None, pick: str | None = "min",
               dim_filter: Column | None = None,
               broadcast_max_rows: int | None = DIM_BROADCAST_MAX_ROWS) -> DataFrame:
    """Left join ``fact`` to ``dim`` and replace a miss by the unknown key -1.

    ``on`` maps fact column (or Column) -> dim column. ``pick`` de-duplicates the dimension
    per natural key first (``None`` when the dimension is already unique).
    """
    out_col = out_col or key_col
    pairs = list(on.items()) if isinstance(on, dict) else list(on)
    d = dim if dim_filter is None else dim.filter(dim_filter)
    dim_cols = [dc for _, dc in pairs]
    d = dedup_dim(d, dim_cols, key_col, pick) if pick else d.select(*dim_cols, key_col)
    renamed = {dc: f"_sl_k{i}" for i, (_, dc) in enumerate(pairs)}
    d = d.select(*[F.col(dc).alias(renamed[dc]) for dc in dim_cols], F.col(key_col).alias("_sl_key"))
    # The de-duplicated side has at most as many rows as the dimension itself.
    d = checked_broadcast(d, broadcast_max_rows, bound_by=dim)
    cond = None
    for fc, dc in pairs:
        left = F.col(fc) if isinstance(fc, str) else fc
        c = left == F.col(renamed[dc])
        cond = c if cond is None else cond & c
    joined = fact.join(d, cond, "left")
    key_type = d.schema["_sl_key"].dataType
    return (joined.withColumn(out_col, F.coalesce(F.col("_sl_key"), F.lit(UNKNOWN_KEY).cast(key_type)))
                  .drop("_sl_key", *renamed.values()))


def current_key(fact: DataFrame, dim: DataFrame, fact_col, nk: str, key_col: str, out_col: str,
                current_col: str = "is_current") -> DataFrame:
    """Newest current SCD2 version (TOP 1 ... WHERE is_current ORDER BY key DESC)."""
    return lookup_key(fact, dim, {fact_col: nk}, key_col, out_col, pick="max",
                      dim_filter=F.col(current_col) == F.lit(True))


def latest_value(status: DataFrame, keys: list[str], value_cols: list[str], order_col: str) -> DataFrame:
    """Per key tuple, the value(s) of the row with the greatest ``order_col``."""
    aggs = [F.max_by(F.col(v), F.col(order_col)).alias(v) for v in value_cols]
    return status.groupBy(*keys).agg(*aggs)


def either_or_key(fact: DataFrame, dim: DataFrame, first: tuple, second: tuple, key_col: str,
                  out_col: str, first_guard: Column | None = None,
                  second_guard: Column | None = None) -> DataFrame:
    """Match on ``first`` mapping, else on ``second`` mapping; top key of each; never an OR join.

    ``first``/``second`` are dicts fact col -> dim col. ``second_guard`` restricts which fact
    rows may use the fallback (e.g. template id IS NULL).
    """
    a = lookup_key(fact, dim, first[0], key_col, "_sl_first", pick="max", dim_filter=first[1])
    if first_guard is not None:
        a = a.withColumn("_sl_first", F.when(first_guard, F.col("_sl_first")).otherwise(F.lit(UNKNOWN_KEY)))
    b = lookup_key(a, dim, second[0], key_col, "_sl_second", pick="max", dim_filter=second[1])
    if second_guard is not None:
        b = b.withColumn("_sl_second", F.when(second_guard, F.col("_sl_second")).otherwise(F.lit(UNKNOWN_KEY)))
    return (b.withColumn(out_col, F.when(F.col("_sl_first") != UNKNOWN_KEY, F.col("_sl_first"))
                                   .otherwise(F.col("_sl_second")))
             .drop("_sl_first", "_sl_second"))
