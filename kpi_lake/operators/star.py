"""Star-schema builders: facts, dimensions, calendar dimensions, keys and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_lake.functions.clean import label, project


def fact_table(df: DataFrame, cols: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Fact extraction: the measure columns and foreign keys of one grain, renamed to model names."""
    return project(df, cols, renames)


def profile_dimension(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Entity dimension: one row per source row (the source is already one row per entity)."""
    return df.select(*cols)


def date_dimension(
    df: DataFrame,
    date_col: str,
    part_cols: Sequence[str],
    id_name: str | None = None,
    part_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Calendar dimension = the distinct dates a fact uses, with their calendar parts.

    It has gaps (days without facts) and keeps a null date when the fact has one. Only the date
    column and its parts are read; the distinct is a partial + final hash aggregate, so the
    shuffle carries at most one row per date and map task. The result is bounded by the number
    of calendar days in the data, which is what makes it safe to broadcast in joins.
    """
    renames = {date_col: id_name or date_col, **(part_names or {})}
    return project(df.select(date_col, *part_cols).distinct(), [date_col, *part_cols], renames)


def attribute_dimension(df: DataFrame, code_col: str, id_name: str, name_col: str, labels: Mapping[str, str], default: str) -> DataFrame:
    """Code dimension: distinct codes of a fact and their labels (null code included)."""
    return df.select(F.col(code_col).alias(id_name)).distinct().withColumn(name_col, label(id_name, labels, default))


def surrogate_key(df: DataFrame, cols: Sequence[str], name: str = "sk") -> DataFrame:
    """Stable key of the natural key columns: no shuffle, same value on every rerun. The SHA-256 of
    an encoding that keeps nulls, empty texts and column borders apart (``-`` for a null, else the
    text's length, a colon and the text), as 64 hexadecimal digits."""

    def encoded(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return df.withColumn(name, F.sha2(F.concat(*[encoded(c) for c in cols]), 256))


def sequence_key(df: DataFrame, order_cols: Sequence[Column | str], name: str = "sk") -> DataFrame:
    """Dense 1..N key in ``order_cols`` order, without funnelling rows through one task.

    The frame is range-partitioned by the sort (each task holds one contiguous slice; sort keys
    that tie on the first column are split by the following ones). Rows are numbered inside
    their partition from ``monotonically_increasing_id`` (partition id in the upper bits,
    position in the lower 33 bits); a second, tiny frame of one row per partition gives each
    partition its offset. That frame is bounded by the partition count, so it is broadcast.

    The numbered frame is read twice (counts and rows), so it is materialised once with a
    reliable ``checkpoint`` into the shared checkpoint folder: both reads then see the same
    partition ids, whatever AQE decides, and a lost executor re-reads files instead of
    recomputing a sort. ``order_cols`` must order rows totally for the key to be reproducible.

    The sort and the checkpoint run when this function is called: a batch step, not a lazy plan.
    Set ``spark.cleaner.referenceTracking.cleanCheckpoints`` so that the checkpoint's files go
    when the frame is no longer referenced.
    """
    from kpi_lake.session import checkpoint_dir

    pid = "__pid"
    pos = "__pos"
    checkpoint_dir(df.sparkSession)
    numbered = (
        df.orderBy(*order_cols)
        .withColumn("__mid", F.monotonically_increasing_id())
        .withColumn(pid, F.spark_partition_id())
        .withColumn(pos, F.col("__mid") - F.shiftleft(F.col(pid).cast("bigint"), 33))
        .drop("__mid")
        .checkpoint(eager=True)
    )
    counts = numbered.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        pid,
        (F.sum("__n").over(_running_window(pid)) - F.col("__n")).alias("__offset"),
    )
    return (
        numbered.join(F.broadcast(offsets), pid)
        .withColumn(name, F.col("__offset") + F.col(pos) + F.lit(1))
        .drop(pid, pos, "__offset")
    )


def _running_window(order_col: str):
    from pyspark.sql import Window

    # One row per partition only: this window is over the partition-count frame, never the data.
    return Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def duplicate_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (map-side combined count)."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def orphan_keys(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Fact rows whose non-null key has no row in the dimension."""
    keys = dim.select(F.col(dim_col).alias("__k"))
    return fact.filter(F.col(fact_col).isNotNull()).join(keys, F.col(fact_col) == F.col("__k"), "left_anti")


def null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, the number of nulls in a column the model declares not nullable."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in cols])


__all__ = [
    "attribute_dimension",
    "date_dimension",
    "duplicate_keys",
    "fact_table",
    "null_keys",
    "orphan_keys",
    "profile_dimension",
    "sequence_key",
    "surrogate_key",
]
