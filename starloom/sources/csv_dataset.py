"""SC9: a folder of CSV tables (one sub-folder per table) plus a ``_manifest`` table.

CSV conventions: header row, NULL written as the empty string, dates ``yyyy-MM-dd`` and
timestamps ``yyyy-MM-dd HH:mm:ss``. Reading always applies the declared schema (no inference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans import schemas

CSV_OPTIONS = {"header": "true", "nullValue": "", "emptyValue": "", "dateFormat": "yyyy-MM-dd",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def write_dataset(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write each table under ``folder/<table>/`` and return the manifest (table, file, rows, columns)."""
    manifest = None
    for name, df in tables.items():
        df.write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{folder}/{name}")
        # Row count from the written files, so the manifest describes what is on storage.
        rows = df.sparkSession.read.options(**CSV_OPTIONS).schema(df.schema).csv(f"{folder}/{name}") \
                 .agg(F.count(F.lit(1)).alias("rows"))
        entry = rows.select(F.lit(name).alias("table"), F.lit(f"{name}/").alias("file"), F.col("rows").cast("long"),
                            F.lit(len(df.columns)).alias("columns"))
        manifest = entry if manifest is None else manifest.unionByName(entry)
    manifest = manifest.coalesce(1)   # one small file: one row per table
    manifest.write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{folder}/_manifest")
    return manifest


def read_table(spark: SparkSession, folder: str, name: str, ddl: str | None = None) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema(ddl or schemas.source_ddl(name)).csv(f"{folder}/{name}")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema("table string, file string, rows long, columns int") \
                .csv(f"{folder}/_manifest")
