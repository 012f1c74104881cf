"""The date dimension, one row per day, key yyyymmdd, plus the unknown day -1."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key

# The unknown row of the date dimension.
UNKNOWN_DATE_ROW = {
    "TimeKey": -1, "FullDateAlternateKey": _dt.date(1900, 1, 1), "PersianFullDateAlternateKey": "نامشخص",
    "DayNumberOfWeek": 0, "PersianDayNumberOfWeek": 0, "EnglishDayNameOfWeek": "Unknown",
    "PersianDayNameOfWeek": "نامشخص", "DayNumberOfMonth": 0, "PersianDayNumberOfMonth": 0,
    "DayNumberOfYear": 0, "PersianDayNumberOfYear": 0, "WeekNumberOfYear": 0, "PersianWeekNumberOfYear": 0,
    "EnglishMonthName": "Unknown", "PersianMonthName": "نامشخص", "MonthNumberOfYear": 0,
    "PersianMonthNumberOfYear": 0, "CalendarQuarter": 0, "PersianCalendarQuarter": 0,
    "CalendarYear": 1900, "PersianCalendarYear": 0, "CalendarSemester": 0, "PersianCalendarSemester": 0,
}

COLUMNS = list(UNKNOWN_DATE_ROW)
_SHORT = {"PersianFullDateAlternateKey", "EnglishDayNameOfWeek", "PersianDayNameOfWeek",
          "EnglishMonthName", "PersianMonthName"}


def _type(name: str) -> str:
    if name == "FullDateAlternateKey":
        return "date"
    if name in _SHORT:
        return "string"
    return "int"


def build_dim_date(bounds: DataFrame, lo_col: str = "lo", hi_col: str = "hi",
                   with_unknown: bool = True) -> DataFrame:
    """Days from ``lo`` to ``hi`` inclusive; ``bounds`` is a one-row frame (derived in-plan)."""
    d = F.col("FullDateAlternateKey")
    days = bounds.select(F.explode(F.sequence(F.col(lo_col), F.col(hi_col))).alias("FullDateAlternateKey"))
    month = F.month(d)
    dim = days.select(
        date_key(d).alias("TimeKey"), d,
        F.lit(None).cast("string").alias("PersianFullDateAlternateKey"),
        (F.weekday(d) + 1).alias("DayNumberOfWeek"),
        F.lit(None).cast("int").alias("PersianDayNumberOfWeek"),
        F.date_format(d, "EEEE").alias("EnglishDayNameOfWeek"),
        F.lit(None).cast("string").alias("PersianDayNameOfWeek"),
        F.dayofmonth(d).alias("DayNumberOfMonth"),
        F.lit(None).cast("int").alias("PersianDayNumberOfMonth"),
        F.dayofyear(d).alias("DayNumberOfYear"),
        F.lit(None).cast("int").alias("PersianDayNumberOfYear"),
        F.weekofyear(d).alias("WeekNumberOfYear"),
        F.lit(None).cast("int").alias("PersianWeekNumberOfYear"),
        F.date_format(d, "MMMM").alias("EnglishMonthName"),
        F.lit(None).cast("string").alias("PersianMonthName"),
        month.alias("MonthNumberOfYear"),
        F.lit(None).cast("int").alias("PersianMonthNumberOfYear"),
        F.quarter(d).alias("CalendarQuarter"),
        F.lit(None).cast("int").alias("PersianCalendarQuarter"),
        F.year(d).alias("CalendarYear"),
        F.lit(None).cast("int").alias("PersianCalendarYear"),
        F.when(month <= 6, F.lit(1)).otherwise(F.lit(2)).alias("CalendarSemester"),
        F.lit(None).cast("int").alias("PersianCalendarSemester"),
    ).select(*[F.col(c).cast(_type(c)).alias(c) for c in COLUMNS])
    if with_unknown:
        unk = bounds.sparkSession.range(1).select(
            *[F.lit(v).cast(_type(k)).alias(k) for k, v in UNKNOWN_DATE_ROW.items()])
        dim = unk.unionByName(dim)
    return dim


def dim_date_between(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return build_dim_date(bounds)
