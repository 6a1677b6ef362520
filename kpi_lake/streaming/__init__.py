"""Incremental (Structured Streaming) form of the row-local bronze -> silver step."""

from kpi_lake.streaming.incremental import bronze_stream, refresh_silver_incrementally, start_silver_stream

__all__ = ["bronze_stream", "refresh_silver_incrementally", "start_silver_stream"]
