"""Layered table IO and the stand-in bronze tables."""

from kpi_lake.sources.layers import Lake, copy_table, read_table, source_lake, write_many, write_table

__all__ = ["Lake", "copy_table", "read_table", "source_lake", "write_many", "write_table"]
