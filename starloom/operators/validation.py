"""Row validation with an accumulated message, valid/rejected split and counts.

A rule is (failure condition, message). The message of a row is the concatenation of
every failed rule's text (NULL when none failed); a row is valid when nothing failed.
Referential rules need a join, done once per parent with the parent's distinct keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import norm_lower


@dataclass(frozen=True)
class Rule:
    fails: Column
    message: str


def required(col: str) -> Rule:
    """V4: NOT NULL."""
    return Rule(F.col(col).isNull(), f"{col} missing; ")


def in_domain(col: str, values: list[str], normalise: bool = True) -> Rule:
    """V5: enumerated domain; NULL is left to ``required``."""
    c = norm_lower(col) if normalise else F.col(col)
    return Rule(F.col(col).isNotNull() & ~c.isin(*values), f"{col} invalid; ")


def greater_than(col: str, bound, inclusive: bool = False) -> Rule:
    """V6: numeric bound (x > b, or x >= b)."""
    ok = F.col(col) >= bound if inclusive else F.col(col) > bound
    return Rule(F.col(col).isNotNull() & ~ok, f"{col} out of range; ")


def between(col: str, low, high) -> Rule:
    c = F.col(col)
    return Rule(c.isNotNull() & ((c < low) | (c > high)), f"{col} out of range; ")


def ordered(first: str, second: str) -> Rule:
    """V7: first <= second when both present."""
    a, b = F.col(first), F.col(second)
    return Rule(a.isNotNull() & b.isNotNull() & (a > b), f"{first} after {second}; ")


def custom(fails: Column, message: str) -> Rule:
    return Rule(F.coalesce(fails, F.lit(False)), message)


#: Parent keys are broadcast up to this many rows (one id each), as the sides of lookups are.
PARENT_BROADCAST_MAX_ROWS = 1_000_000


@dataclass(frozen=True)
class ForeignKey:
    """V8: non-null ``col`` must exist in ``parent.parent_col``; ``when`` makes it conditional (V9)."""
    col: str
    parent: DataFrame
    parent_col: str
    message: str | None = None
    when: Column | None = None
    of_type: tuple[str, str] | None = None    # (type column, value): the row's type names the parent


def _spread(key: Column, kind: str, by: str) -> Column:
    """``key`` with its NULLs replaced by negative values scattered by a hash of column ``by`` (the same on every retry) for whole numbers, so rows without a reference do not meet in one
    shuffle partition. Whether a scattered value happens to exist does not matter: such rows are never reported."""
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        return key
    width = {"tinyint": 100, "smallint": 30_000}.get(kind, 1 << 20)
    return F.coalesce(key, (-2 - F.pmod(F.xxhash64(by), F.lit(width))).cast(kind))


def typed_together(fks: list[ForeignKey]) -> dict[tuple[str, str], list[int]]:
    """The places in ``fks`` of references that are checked in one join, by their type column and column."""
    groups: dict[tuple[str, str], list[int]] = {}
    for i, fk in enumerate(fks):
        if fk.of_type is not None:
            groups.setdefault((fk.of_type[0], fk.col), []).append(i)
    return {k: at for k, at in groups.items() if len(at) > 1 and len({fks[i].of_type[1] for i in at}) == len(at)}


def _attach_typed_flags(df: DataFrame, fks: list[ForeignKey]) -> tuple[DataFrame, dict[int, Column]]:
    """References of one column to several parents, told apart by one type column, are checked in one join (V9). Returns the frame
    with a flag per such column, and each reference's failure by its place in ``fks``."""
    from starloom.operators.references import PolymorphicKey, with_missing_parent
    from starloom.session import holding
    failures, made = {}, df
    for (type_col, col), places in typed_together(fks).items():
        codes = [fks[i].of_type[1] for i in places]
        flag = f"_sl_typed{places[0]}"
        parents = {code: (fks[i].parent, fks[i].parent_col) for code, i in zip(codes, places)}
        df = holding(with_missing_parent(df, PolymorphicKey(type_col, col, parents), flag), made)
        made = df
        for code, i in zip(codes, places):
            failures[i] = F.col(flag) & (norm_lower(type_col) == code)
    return df, failures


def attach_fk_flags(df: DataFrame, fks: list[ForeignKey]) -> tuple[DataFrame, list[Rule]]:
    """Left join each parent's distinct keys; return the frame plus the failure rules. A parent that a bounded count proves small
    is broadcast (counted once for all tables of a run); keys that are NULL, or whose condition does not hold, stay out of the shuffle's
    hot spots."""
    from starloom.operators.lookups import checked_broadcast
    from starloom.session import holding
    rules = []
    df, typed = _attach_typed_flags(df, fks)
    made = df
    for i, fk in enumerate(fks):
        if i in typed:
            rules.append(Rule(typed[i], fk.message or f"{fk.col} not found; "))
            continue
        flag = f"_sl_fk{i}"
        parent = fk.parent.select(F.col(fk.parent_col).alias(flag + "_k")).distinct() \
                          .withColumn(flag, F.lit(True))
        parent = checked_broadcast(parent, PARENT_BROADCAST_MAX_ROWS, bound_by=fk.parent)
        asked = F.col(fk.col) if fk.when is None else F.when(fk.when, F.col(fk.col))
        df = (df.withColumn(flag + "_j", _spread(asked, df.schema[fk.col].dataType.simpleString(), df.columns[0]))
              .join(parent, F.col(flag + "_j") == F.col(flag + "_k"), "left").drop(flag + "_k", flag + "_j"))
        missing = F.col(fk.col).isNotNull() & F.col(flag).isNull()
        if fk.when is not None:
            missing = F.coalesce(fk.when, F.lit(False)) & missing
        rules.append(Rule(missing, fk.message or f"{fk.col} not found; "))
    return holding(df, made), rules


def validate(df: DataFrame, rules: list[Rule], fks: list[ForeignKey] = ()) -> DataFrame:
    """Add ``is_valid`` and ``validation_message`` (V3). ``discard`` of the result removes the work tables of its references."""
    from starloom.session import holding
    cols = df.columns
    df, fk_rules = attach_fk_flags(df.select("*"), list(fks))      # a frame of its own: not the files that ``df`` holds
    all_rules = list(rules) + fk_rules
    if not all_rules:
        return df.select(*cols).withColumn("is_valid", F.lit(True)) \
                 .withColumn("validation_message", F.lit(None).cast("string"))
    parts = [F.when(F.coalesce(r.fails, F.lit(False)), F.lit(r.message)).otherwise(F.lit("")) for r in all_rules]
    msg = F.nullif(F.concat(*parts), F.lit(""))
    return holding(df.withColumn("validation_message", msg)
                     .withColumn("is_valid", F.col("validation_message").isNull())
                     .select(*cols, "is_valid", "validation_message"), df)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows)."""
    return validated.filter(F.col("is_valid")), validated.filter(~F.col("is_valid"))


def validation_counts(validated: DataFrame) -> DataFrame:
    """One row: rows_read, rows_valid, rows_rejected (single pass, partial aggregation)."""
    v = F.col("is_valid").cast("long")
    return validated.agg(F.count(F.lit(1)).alias("rows_read"),
                         F.sum(v).alias("rows_valid"),
                         F.sum(1 - v).alias("rows_rejected")).select(
        F.col("rows_read").cast("long"), F.coalesce("rows_valid", F.lit(0)).cast("long").alias("rows_valid"),
        F.coalesce("rows_rejected", F.lit(0)).cast("long").alias("rows_rejected"))


def valid_rows(df: DataFrame, id_col: str = "id") -> DataFrame:
    """is_valid = 1 AND id IS NOT NULL."""
    return df.filter(F.col("is_valid") & F.col(id_col).isNotNull())


def settled(df: DataFrame, status_col: str, settled_codes: list[str]) -> DataFrame:
    """Keep rows whose normalised status is settled (pending excluded)."""
    return df.filter(norm_lower(F.coalesce(F.col(status_col), F.lit(""))).isin(*settled_codes))


def require_params(**params) -> None:
    """Parameter guard."""
    for name, value in params.items():
        if value is None:
            raise ValueError(f"{name} is required")
    start, end = params.get("start_time"), params.get("end_time")
    if start is not None and end is not None and not start < end:
        raise ValueError("start_time must be earlier than end_time")
