"""Micro-batch incremental staging with Structured Streaming.

New extract files of one source table land in a folder; a file stream picks them up and
``foreachBatch`` applies the same staging job as the batch path (validation + hash-diff
upsert) to a table in blocks, so a micro-batch rewrites the blocks that its rows change and no others. The stream's
checkpoint records which files were processed, so a restarted query neither skips nor
repeats an extract; the table's pointer, swapped last, records the epoch, so a replayed epoch changes nothing.
Old versions beyond the last ``keep_versions`` are removed after each micro-batch.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from starloom.plans import schemas
from starloom.plans.blocks import HashBlocks
from starloom.plans.staging import SPEC_BY_NAME, stage_into, staging_blocks


def latest_version(spark: SparkSession, table: str, target: str, layout=HashBlocks()) -> DataFrame | None:
    """The staging table under ``target`` as the last complete micro-batch left it (None before the first one)."""
    return staging_blocks(spark, SPEC_BY_NAME[table], target, layout).read()


def stage_stream(spark: SparkSession, table: str, landing: str, target: str, checkpoint: str,
                 parents: dict[str, DataFrame] | None = None, to_date: _dt.datetime | None = None,
                 available_now: bool = True, layout=HashBlocks(), keep_versions: int = 2):
    """Start a stream that stages every new extract file of ``table``; returns the StreamingQuery.

    ``parents`` supplies the parent source tables used by referential checks. A micro-batch holds some files, not the
    whole table, so tables that batch runs refresh in full (K1) are upserted here (K2): rows of earlier files stay, and
    a deletion only shows in the next batch run. Several files for one id count with their latest row.
    """
    spec = replace(SPEC_BY_NAME[table], load="upsert")
    stream = spark.readStream.schema(schemas.source_ddl(table)).option("recursiveFileLookup", "true").parquet(landing)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        store = staging_blocks(spark, spec, target, layout)
        if store.tag is not None and store.tag > epoch_id:
            return
        cutoff = to_date or _dt.datetime(9999, 12, 31)
        stage_into(spec, {**(parents or {}), table: batch}, store, cutoff, batch_id=int(epoch_id) + 1, tag=int(epoch_id) + 1)
        store.remove_versions(keep_versions)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

