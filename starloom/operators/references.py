"""V9/Q17: references to several parents, told apart by a type column, checked in one join.

A row names its parent's type and id. All parents go into one table of keys tagged with their type, and all rows into one
join with it, not one join per parent. Whole-number ids are kept as sets of 64-bit words (type, id / 64, bits): a dense parent of a
billion ids is sixteen million narrow rows, and the check is a join on (type, word) and a bit test.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parent words, short rows of a type code and two numbers, that may be broadcast.
MOST_BROADCAST = 1_000_000
_WHOLE = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class PolymorphicKey:
    """``id_col`` refers to the parent that ``type_col`` (lower-cased and trimmed) names: ``parents`` maps a type to (frame, id column) and
    ``messages`` to the text for a missing parent. Types that are not listed are not checked here; null ids refer to nothing."""

    type_col: str
    id_col: str
    parents: dict[str, tuple[DataFrame, str]]
    messages: dict[str, str] = field(default_factory=dict)


def _type(key: PolymorphicKey) -> Column:
    return F.lower(F.trim(F.col(key.type_col)))


def parent_words(parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """_type, _word and _bits: the ids that each type's parent has."""
    out = None
    for code, (parent, id_col) in parents.items():
        i = F.col(id_col).cast("long")
        ids = parent.where(i.isNotNull()).select(
            F.lit(code).alias("_type"), F.shiftright(i, 6).alias("_word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(63).cast("int")).alias("_bit"))
        out = ids if out is None else out.unionByName(ids)
    return out.groupBy("_type", "_word").agg(F.bit_or("_bit").alias("_bits"))


def with_missing_parent(df: DataFrame, key: PolymorphicKey, out_col: str) -> DataFrame:
    """``df`` with a boolean: whether the row names a listed type and an id that its parent lacks."""
    from starloom.operators.lookups import checked_broadcast
    from starloom.session import cut_lineage, holding
    id_type = df.schema[key.id_col].dataType.simpleString()
    asked = _type(key).isin(*key.parents) & F.col(key.id_col).isNotNull()
    asked = F.coalesce(asked, F.lit(False))
    # Rows that refer to nothing are scattered over keys of no type, so they do not meet in one partition.
    scatter = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns[:2]]), F.lit(1 << 20))
    if id_type in _WHOLE and all(p.schema[c].dataType.simpleString() in _WHOLE for p, c in key.parents.values()):
        stored = cut_lineage(parent_words(key.parents))
        known = checked_broadcast(stored, MOST_BROADCAST)
        i = F.col(key.id_col).cast("long")
        placed = df.withColumns({"_k_type": F.when(asked, _type(key)).otherwise(F.lit("")), "_k_word": F.when(asked, F.shiftright(i, 6)).otherwise(scatter)})
        there = F.call_function("getbit", F.coalesce("_bits", F.lit(0).cast("long")), i.bitwiseAND(63).cast("int")) == 1
        joined = placed.join(known, (F.col("_k_type") == F.col("_type")) & (F.col("_k_word") == F.col("_word")), "left")
    else:
        tagged = None
        for code, (parent, id_col) in key.parents.items():
            ids = parent.where(F.col(id_col).isNotNull()).select(F.lit(code).alias("_type"), F.col(id_col).cast("string").alias("_word"))
            tagged = ids if tagged is None else tagged.unionByName(ids)
        stored = cut_lineage(tagged.distinct().withColumn("_bits", F.lit(1)))
        known = checked_broadcast(stored, MOST_BROADCAST)
        placed = df.withColumns({"_k_type": F.when(asked, _type(key)).otherwise(F.lit("")),
                                 "_k_word": F.when(asked, F.col(key.id_col).cast("string")).otherwise(scatter.cast("string"))})
        there = F.col("_bits").isNotNull()
        joined = placed.join(known, (F.col("_k_type") == F.col("_type")) & (F.col("_k_word") == F.col("_word")), "left")
    return holding(joined.withColumn(out_col, asked & ~there).drop("_k_type", "_k_word", "_type", "_word", "_bits"), stored)


def polymorphic_orphans(df: DataFrame, key: PolymorphicKey) -> DataFrame:
    """Q17: for each type that occurs, the number of rows, of rows without an id, and of rows whose parent is missing. Types that are not listed
    count as missing altogether; a null type is the type ''."""
    flagged = with_missing_parent(df, key, "_missing")
    code = F.coalesce(_type(key), F.lit(""))
    return flagged.groupBy(code.alias("entity_type")).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"), F.count_if(F.col(key.id_col).isNull()).cast("long").alias("n_without_id"),
        F.count_if(F.col("_missing") | ~code.isin(*key.parents)).cast("long").alias("n_orphans"))
