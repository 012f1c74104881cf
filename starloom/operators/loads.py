"""Load strategies as DataFrame algebra over immutable snapshots.

Without MERGE, every load returns the next full version of the target (or the rows to
append); ``plans.tables.write_tables`` persists it. Anti-joins are equi-joins: they shuffle
on the key, or broadcast a side whose size was checked first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import sortable_columns, tasks_for
from starloom.operators.lookups import checked_broadcast, latest_per_key

#: Narrow (key, hash) rows of an extract are broadcast up to this many (about 100 bytes each).
EXTRACT_BROADCAST_MAX_ROWS = 200_000


def full_refresh(valid: DataFrame) -> DataFrame:
    """K1: the new table is exactly the current valid extract; deletes propagate."""
    return valid


def latest_of_extract(incoming: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_cols`` and then by every sortable column, so repeated ids of an extract
    (two files for one id, say) have one defined winner. Rows with a NULL key are not ids of anything and all stay."""
    known = None
    for k in keys:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    order = list(order_cols) + [c for c in sortable_columns(incoming) if c not in order_cols and c not in keys]
    return latest_per_key(incoming.filter(known), keys, order).unionByName(incoming.filter(~known))


def hash_upsert(target: DataFrame | None, incoming: DataFrame, keys: list[str],
                hash_col: str = "row_hash", valid_col: str | None = "is_valid",
                keep_old: tuple[str, ...] = (), order_cols: tuple[str, ...] = (), unique: bool = False,
                broadcast_max_rows: int | None = EXTRACT_BROADCAST_MAX_ROWS) -> DataFrame:
    """K2: update rows whose key matches and whose hash differs (or is NULL, or the old row is
    invalid); insert absent keys; keep unchanged rows with their old metadata; never delete.

    Returns the next version with an ``upsert_action`` column (insert/update/unchanged).
    ``keep_old`` columns (e.g. the staging row id) keep the target's value on update. Repeated ids in ``incoming`` are
    reduced to their latest row first (``order_cols``) unless the caller knows there are none (``unique``).

    One algorithm for every size: the matched keys are found and materialised as narrow rows (key and change
    flag, at most one per extract key); old rows of all other keys pass through an anti-join; only extract rows are rebuilt.
    A small extract's narrow rows are broadcast, so the target is scanned and not shuffled; beyond the bound the
    same joins shuffle narrow rows.
    """
    from starloom.session import cut_lineage, holding
    cols = incoming.columns
    if not unique:
        incoming = latest_of_extract(incoming, keys, list(order_cols))
    if target is None:
        return incoming.withColumn("upsert_action", F.lit("insert"))
    old = target.select(*cols)
    probe = incoming.select(*[F.col(k).alias(f"_i_{k}") for k in keys], F.col(hash_col).alias("_i_h"))
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"_i_{k}")
        cond = c if cond is None else cond & c
    extra = [c for c in ([valid_col] if valid_col else []) + list(keep_old) if c not in keys and c != hash_col]
    found = old.select(*keys, hash_col, *extra).join(checked_broadcast(probe, broadcast_max_rows), cond)
    changed = F.col(hash_col).isNull() | F.col("_i_h").isNull() | (F.col(hash_col) != F.col("_i_h"))
    if valid_col:
        changed = changed | ~F.coalesce(F.col(valid_col), F.lit(False))
    kept_cols = [c for c in keep_old if c not in keys]
    matched = cut_lineage(found.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in kept_cols], changed.alias("_changed")))
    found = checked_broadcast(matched, broadcast_max_rows)
    touched = checked_broadcast(found.filter("_changed").select(*keys).distinct(), broadcast_max_rows, bound_by=found)
    kept = old.join(touched, keys, "left_anti").withColumn("upsert_action", F.lit("unchanged"))
    upd = incoming.join(found.filter("_changed"), keys).select(
        *[F.col(f"_o_{c}").alias(c) if c in kept_cols else F.col(c) for c in cols], F.lit("update").alias("upsert_action"))
    ins = incoming.join(found.select(*keys), keys, "left_anti").withColumn("upsert_action", F.lit("insert"))
    return holding(kept.unionByName(upd).unionByName(ins.select(*cols, "upsert_action")), matched)


def null_safe_key(cols: list[str]) -> list[Column]:
    """ISNULL(k, -1) for numeric keys, ISNULL(k, '') for text keys (K4)."""
    return [F.coalesce(F.col(c), F.lit(-1)) for c in cols]


def append_new(candidates: DataFrame, existing: DataFrame, keys: list[str],
               null_safe: bool = False, rows: int | None = None) -> DataFrame:
    """K3/K4/K5: candidate rows whose key tuple is not yet in ``existing`` (left anti join). ``rows``, the rows of the larger side if they
    are known, bounds what one task of the join gets: beyond the session's partitions both sides are dealt to more."""
    # No distinct(): an anti-join only asks whether a key exists.
    e = existing.select(*[F.col(k).alias(f"_e_{k}") for k in keys])
    n = tasks_for(candidates.sparkSession, rows) if rows else None
    if n is not None:
        # Both sides are dealt by what the join compares, so that it shuffles neither again. With a NULL in its key a row meets none
        # unless NULLs are alike; a hash of the whole key deals such rows evenly.
        cols = candidates.columns
        dealt = F.pmod(F.xxhash64(*keys), F.lit(1 << 40)).alias("_deal")
        candidates = candidates.select("*", dealt).repartition(n, "_deal")
        e = e.select("*", F.pmod(F.xxhash64(*[f"_e_{k}" for k in keys]), F.lit(1 << 40)).alias("_e_deal")).repartition(n, "_e_deal")
        same = F.col("_deal") == F.col("_e_deal")
        for k in keys:
            same = same & (F.col(k).eqNullSafe(F.col(f"_e_{k}")) if null_safe else F.col(k) == F.col(f"_e_{k}"))
        return candidates.join(e, same, "left_anti").select(*cols)
    cond = None
    for k in keys:
        if null_safe:
            c = F.col(k).eqNullSafe(F.col(f"_e_{k}"))
        else:
            c = F.col(k) == F.col(f"_e_{k}")
        cond = c if cond is None else cond & c
    return candidates.join(e, cond, "left_anti")


def replace_touched(old: DataFrame, recomputed: DataFrame, keys: list[str]) -> DataFrame:
    """Recomputed groups replace their old rows; untouched old groups are kept."""
    return recomputed.unionByName(untouched(old, recomputed, keys))


def untouched(old: DataFrame, recomputed: DataFrame, keys: list[str]) -> DataFrame:
    """The old rows whose group was not recomputed."""
    return old.join(recomputed.select(*keys).distinct(), keys, "left_anti").select(*recomputed.columns)


def insert_missing_distinct(new_rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """De-duplicate new rows on ``keys`` and keep those not already present."""
    return append_new(new_rows.dropDuplicates(keys), existing, keys)
