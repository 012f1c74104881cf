"""Row hashes (V1/V2): SHA-256 over pipe-joined column text, NULLs skipped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator used between hashed column texts.
HASH_SEPARATOR = "|"


def row_hash(*cols) -> Column:
    """sha2(concat_ws('|', c1, c2, ...), 256) as lowercase hex.

    ``concat_ws`` skips NULL arguments, so ('a', NULL, 'b') and ('a', 'b', NULL) hash alike;
    that matches the loaders this library replaces. Doubles should be cast to a decimal by
    the caller first so that the text form is stable across engines.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
