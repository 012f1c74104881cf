"""SC10: stamp extracted rows with batch and source lineage columns (all literals)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import ts_lit


def stamp_lineage(df: DataFrame, batch_id: int, source_system: str, source_database: str,
                  source_schema: str, source_table: str, extracted_at, source_updated_at: Column) -> DataFrame:
    return df.withColumns({
        "etl_batch_id": F.lit(batch_id).cast("int"),
        "source_system": F.lit(source_system),
        "source_database": F.lit(source_database),
        "source_schema": F.lit(source_schema),
        "source_table": F.lit(source_table),
        "extracted_at": ts_lit(extracted_at),
        "source_updated_at": source_updated_at.cast("timestamp_ntz"),
    })
