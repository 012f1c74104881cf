"""String expressions used by the loaders (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_lower(c) -> Column:
    """LOWER(LTRIM(RTRIM(x))): codes are compared case- and padding-insensitively."""
    return F.lower(F.trim(_col(c)))


def norm_upper(c) -> Column:
    return F.upper(F.trim(_col(c)))


def blank_to_null(c) -> Column:
    """NULLIF(LTRIM(RTRIM(x)), '')."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def concat_nulls_as_empty(*cols) -> Column:
    """CONCAT where a NULL argument counts as the empty string."""
    return F.concat(*[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def keyword_flags(text: Column, groups: list[tuple[str, list[str]]], other: str = "other"):
    """Classify ``text`` by substring keywords.

    ``groups`` is an ordered list of (category, [keywords]); the first group with any
    keyword contained in lower(text) wins. Returns (category column, {category: 0/1 flag}).
    """
    low = F.lower(text)
    flags = {}
    category = None
    for name, words in groups:
        hit = None
        for w in words:
            cond = low.contains(w)
            hit = cond if hit is None else (hit | cond)
        hit = F.coalesce(hit, F.lit(False))
        flags[name] = hit.cast("int")
        category = F.when(hit, F.lit(name)) if category is None else category.when(hit, F.lit(name))
    return category.otherwise(F.lit(other)), flags
