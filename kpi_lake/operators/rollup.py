"""Exact distinct counts that can be rolled up: bitmaps of dense keys.

A distinct count by day can't be added up to months, nor counts by industry to a total. A roll-up
table holds, per group and per bucket of 32,768 neighbouring keys, the bitmap of the keys that occur.
Bitmaps of any groups are united by ``or``, so one table answers the total, every subset of its
group columns and every filter on them, exactly, without reading the facts again; tables of different
loads are united the same way.

Keys are dense positive integers (a ``KeyMap``'s keys). All steps are built-in aggregates: the first
step combines on the map side, so a group or key that holds a third of all rows is one row per map
task, bucket and group. A bitmap takes 4 KB however few bits it has (zeros compress well in files),
so a roll-up pays where groups are coarser than about a thousand keys a bucket; below that, the
distinct rows themselves are smaller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "key_bucket", "key_bits"


def distinct_rollup(df: DataFrame, group_cols: Sequence[str], key: str) -> DataFrame:
    """``group_cols, key_bucket, key_bits``. Null keys don't count, as in ``count(distinct)``; a key
    below 1 is refused."""
    checked = F.when(F.col(key) >= 1, F.col(key)).otherwise(F.raise_error(F.lit(f"{key} must be a positive integer")).cast("bigint"))
    rows = df.filter(F.col(key).isNotNull()).select(*group_cols, checked.cast("bigint").alias("__key"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("__key")).alias(BITS)
    return rows.groupBy(*group_cols, F.bitmap_bucket_number("__key").alias(BUCKET)).agg(bits)


def merge_rollups(rollups: Sequence[DataFrame], group_cols: Sequence[str]) -> DataFrame:
    """One roll-up of the union of what each was made from; ``group_cols`` may be fewer than theirs."""
    every = rollups[0].select(*group_cols, BUCKET, BITS)
    for more in rollups[1:]:
        every = every.unionByName(more.select(*group_cols, BUCKET, BITS))
    return every.groupBy(*group_cols, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_count(rollup: DataFrame, group_cols: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Distinct keys per value of ``group_cols`` (none: one row, 0 for an empty table)."""
    total: Column = F.sum(F.bitmap_count(BITS))
    merged = merge_rollups([rollup], group_cols)
    if not group_cols:
        return merged.agg(F.coalesce(total, F.lit(0)).alias(name))
    return merged.groupBy(*group_cols).agg(total.alias(name))


__all__ = ["BITS", "BUCKET", "distinct_count", "distinct_rollup", "merge_rollups"]
