"""Date keys and calendar arithmetic."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unknown member key and date of the date dimension.
UNKNOWN_KEY = -1
UNKNOWN_DATE = "1900-01-01"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """yyyymmdd integer key of a date/timestamp; NULL stays NULL."""
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_or_unknown(c) -> Column:
    return F.coalesce(date_key(c), F.lit(UNKNOWN_KEY))


def date_from_key(c) -> Column:
    k = _col(c)
    return F.when(k == UNKNOWN_KEY, F.lit(None).cast("date")).otherwise(
        F.make_date((k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int")))


def month_start(c) -> Column:
    return F.trunc(F.to_date(_col(c)), "month")


def ts_lit(v) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so no process or session time zone shifts it."""
    if isinstance(v, Column):
        return v
    if v is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(v, _dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        text = v.isoformat(sep=" ")
    elif isinstance(v, _dt.date):
        text = v.isoformat() + " 00:00:00"
    else:
        text = str(v)
    return F.lit(text).cast("timestamp_ntz")
