"""SC1-SC7: extract predicates written so that Parquet can skip row groups.

``coalesce(updated_at, created_at) <= t`` is opaque to Parquet pushdown; the equivalent
``updated_at <= t OR (updated_at IS NULL AND created_at <= t)`` is pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import ts_lit


def _ts(v) -> Column:
    return ts_lit(v) if not isinstance(v, Column) else v


def inclusive_watermark(df: DataFrame, to_ts, updated_col: str = "updated_at",
                        created_col: str = "created_at") -> DataFrame:
    """SC1: rows with COALESCE(updated_at, created_at) <= to_ts."""
    t = _ts(to_ts)
    u, c = F.col(updated_col), F.col(created_col)
    return df.filter((u <= t) | (u.isNull() & (c <= t)))


def created_watermark(df: DataFrame, to_ts, created_col: str = "created_at") -> DataFrame:
    """SC2: rows created at or before the watermark."""
    return df.filter(F.col(created_col) <= _ts(to_ts))


def date_watermark(df: DataFrame, to_ts, date_col: str) -> DataFrame:
    """SC3: a DATE column compared as midnight timestamp."""
    return df.filter(F.col(date_col).cast("timestamp_ntz") <= _ts(to_ts))


def parent_watermark(child: DataFrame, parents: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """SC4/J12: keep child rows whose every parent key exists in the (already extracted)
    parent: [(parent_df, child_fk_col, parent_pk_col), ...] as left-semi joins."""
    out = child
    for parent, fk, pk in parents:
        keys = parent.select(F.col(pk).alias(f"_sl_pk_{fk}"))
        out = out.join(keys, F.col(fk) == F.col(f"_sl_pk_{fk}"), "left_semi")
    return out


def change_window(df: DataFrame, start, end, cols: list[str], prune_col: str | None = None) -> DataFrame:
    """SC5: COALESCE(cols...) in [start, end).

    ``prune_col`` names a column that is always <= the coalesced value (for example the
    creation time); bounding it lets Parquet and partition pruning skip data, because the
    coalesce itself is not pushed down.
    """
    s, e = _ts(start), _ts(end)
    c = F.coalesce(*[F.col(x) for x in cols])
    out = df.filter((c >= s) & (c < e))
    if prune_col is not None:
        out = out.filter(F.col(prune_col).isNull() | (F.col(prune_col) < e))
    return out


def business_window(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """SC6: business date in [start, end) (DATETIME comparison of the date)."""
    d = F.col(date_col).cast("timestamp_ntz")
    return df.filter((d >= _ts(start)) & (d < _ts(end)))


def history_before(df: DataFrame, date_col: str, end) -> DataFrame:
    """SC7: the whole history before ``end`` (the start of the window is ignored)."""
    return df.filter(F.col(date_col).cast("timestamp_ntz") < _ts(end))
