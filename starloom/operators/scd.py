"""K6 (Type 1 rebuild keeping keys) and K8 (Type 2 close-and-insert) dimension loads."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import UNKNOWN_KEY, ts_lit
from starloom.operators.keys import assign_keys, max_key


def unknown_member(like: DataFrame, values: dict) -> DataFrame:
    """One row with the schema of ``like``: given values, NULL elsewhere (key -1 member)."""
    spark = like.sparkSession
    exprs = []
    for f in like.schema.fields:
        v = values.get(f.name)
        exprs.append(F.lit(v).cast(f.dataType).alias(f.name))
    return spark.range(1).select(*exprs)


def scd1_rebuild(src: DataFrame, old_dim: DataFrame | None, nk: list[str], key_col: str,
                 unknown: dict | None = None) -> DataFrame:
    """K6: members matched to the old dimension keep their key, new members get fresh keys
    after the current maximum (ordered by natural key), members gone from ``src`` are dropped,
    and the unknown member (-1) is re-added. ``src`` holds one row per natural key.
    """
    cols = [c for c in src.columns if c != key_col]
    if old_dim is None:
        keyed = assign_keys(src.select(*cols), nk, key_col, base=0)
    else:
        old = old_dim.filter(F.col(key_col) != UNKNOWN_KEY).groupBy(*nk).agg(F.min(key_col).alias(key_col))
        matched = src.select(*cols).join(old, nk, "left")
        kept = matched.filter(F.col(key_col).isNotNull())
        fresh = assign_keys(matched.filter(F.col(key_col).isNull()).drop(key_col), nk, key_col,
                            base=max_key(old_dim, key_col))
        keyed = kept.unionByName(fresh)
    keyed = keyed.select(key_col, *cols)
    if unknown is not None:
        row = dict(unknown)
        row.setdefault(key_col, UNKNOWN_KEY)
        keyed = unknown_member(keyed, row).unionByName(keyed)
    return keyed


def scd2_merge(dim: DataFrame | None, src: DataFrame, nk: list[str], key_col: str,
               hash_col: str, start_time: _dt.datetime, end_time: _dt.datetime,
               unknown: dict | None = None) -> DataFrame:
    """K8: one pass of a Type 2 load.

    First load (``dim`` is None): every source member becomes a current version effective
    from ``start_time``. Incremental: a current version whose hash differs is closed at
    ``end_time`` and a new current version effective from ``end_time`` is added; brand-new
    members get a first version from ``end_time``; equal hashes change nothing.
    Columns added: key_col, effective_from, effective_to, is_current.
    """
    attrs = [c for c in src.columns if c not in (key_col, "effective_from", "effective_to", "is_current")]
    ts = "timestamp_ntz"
    if dim is None:
        versions = assign_keys(src.select(*attrs), nk, key_col, base=0)
        out = versions.select(key_col, *attrs,
                              ts_lit(start_time).alias("effective_from"),
                              F.lit(None).cast(ts).alias("effective_to"),
                              F.lit(True).alias("is_current"))
        if unknown is not None:
            row = dict(unknown, **{key_col: UNKNOWN_KEY, "is_current": True})
            out = unknown_member(out, row).unionByName(out)
        return out

    cur = (dim.filter(F.col("is_current") & (F.col(key_col) != UNKNOWN_KEY))
              .select(*[F.col(c) for c in nk], F.col(key_col).alias("_sl_cur_key"),
                      F.col(hash_col).alias("_sl_cur_hash")))
    j = src.select(*attrs).join(cur, nk, "left")
    is_new = F.col("_sl_cur_key").isNull()
    changed = ~is_new & ~F.col(hash_col).eqNullSafe(F.col("_sl_cur_hash"))
    inserts = j.filter(is_new | changed)
    closing = j.filter(changed).select(F.col("_sl_cur_key").alias("_sl_close"))
    closed = (dim.join(closing, F.col(key_col) == F.col("_sl_close"), "left")
                 .withColumn("effective_to", F.when(F.col("_sl_close").isNotNull(),
                                                    ts_lit(end_time)).otherwise(F.col("effective_to")))
                 .withColumn("is_current", F.when(F.col("_sl_close").isNotNull(), F.lit(False))
                                            .otherwise(F.col("is_current")))
                 .drop("_sl_close"))
    fresh = assign_keys(inserts.select(*attrs), nk, key_col, base=max_key(dim, key_col))
    fresh = fresh.select(key_col, *attrs, ts_lit(end_time).alias("effective_from"),
                         F.lit(None).cast(ts).alias("effective_to"), F.lit(True).alias("is_current"))
    return closed.select(*fresh.columns).unionByName(fresh)
