"""Incremental bronze -> silver with Structured Streaming.

Every bronze -> silver step is row-local (filters, recodes, casts, renames), so the same
functions apply unchanged to a streaming frame. New bronze files are picked up by a file
stream, cleaned, and appended to the silver folder; the stream's progress lives in the shared
checkpoint folder, so a restarted job (or one that lost executors) resumes exactly where it
stopped and every bronze file lands in silver once. ``availableNow`` processes what has arrived
and stops, which fits a scheduled refresh; a continuous trigger interval works the same way.

The stream is for bronze tables that grow by new files. A full refresh of the bronze table rewrites
files that silver has already, and a full refresh of the silver table removes the stream's own log;
either is refused with ``StreamStateError`` until the stream is begun anew (silver emptied, or a new
checkpoint folder).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kpi_lake.plans.pipelines import SILVER_STEPS
from kpi_lake.session import checkpoint_dir
from kpi_lake.sources.layers import Lake, _fs_path, refresh_id, write_mark

NO_REFRESH = "-"


class StreamStateError(RuntimeError):
    """Bronze or silver was rewritten since the stream last ran."""


def stream_checkpoint(spark: SparkSession, lake: Lake, silver_name: str) -> str:
    """The default folder of a stream's progress: the same in every process for the same lake."""
    digest = hashlib.sha256(lake.root.rstrip("/").encode()).hexdigest()[:20]
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{digest}/{silver_name}"


def _check_state(spark: SparkSession, lake: Lake, bronze_name: str, silver_name: str, checkpoint: str) -> None:
    """Refuse to go on with a bronze table that was refreshed, or a silver table without its log."""
    if lake.versioned:
        raise ValueError("a stream reads and writes plain folders, not versioned tables")
    current = refresh_id(spark, lake, "bronze", bronze_name) or NO_REFRESH
    mark = f"{checkpoint}/bronze_refresh"
    path, fs = _fs_path(spark, mark)
    if not fs.exists(path):
        write_mark(spark, mark, current)
        return
    stream = fs.open(path)
    known = stream.readUTF()
    stream.close()
    if known != current:
        raise StreamStateError(f"bronze table {bronze_name} was fully refreshed; begin the silver stream anew")
    started, _ = _fs_path(spark, f"{checkpoint}/commits/0")
    log, silver_fs = _fs_path(spark, f"{lake.path('silver', silver_name)}/_spark_metadata")
    if lake.fmt != "delta" and fs.exists(started) and not silver_fs.exists(log):
        raise StreamStateError(f"silver table {silver_name} was rewritten by a batch; begin the silver stream anew")


def bronze_stream(spark: SparkSession, lake: Lake, bronze_name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over a bronze table folder (schema taken from the files already there)."""
    path = lake.path("bronze", bronze_name)
    schema = spark.read.format(lake.fmt).load(path).schema
    reader = spark.readStream.format(lake.fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def start_silver_stream(
    spark: SparkSession,
    lake: Lake,
    silver_name: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the incremental cleaning of one table into ``<lake>/silver/<silver_name>``."""
    src, step = SILVER_STEPS[silver_name]
    cleaned = step(bronze_stream(spark, lake, src))
    ckpt = checkpoint or stream_checkpoint(spark, lake, silver_name)
    _check_state(spark, lake, src, silver_name, ckpt)
    writer = cleaned.writeStream.format(lake.fmt).outputMode("append").option("checkpointLocation", ckpt)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(lake.path("silver", silver_name))


def refresh_silver_incrementally(spark: SparkSession, lake: Lake, silver_name: str, checkpoint: str | None = None) -> str:
    """Process every bronze file not yet in silver, then stop; returns the silver path."""
    query = start_silver_stream(spark, lake, silver_name, checkpoint=checkpoint, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()  # type: ignore[misc]
    return lake.path("silver", silver_name)


__all__ = ["StreamStateError", "bronze_stream", "refresh_silver_incrementally", "start_silver_stream", "stream_checkpoint"]
