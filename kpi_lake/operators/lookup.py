"""Look-up of values in a table, for maps that are too large, or change too often, for literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFUSE, FIRST = "refuse", "first"


def table_lookup(
    df: DataFrame,
    columns: Sequence[str],
    table: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    duplicates: str = REFUSE,
    order_by: Sequence[Column | str] = (),
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """``df`` with ``values`` of the table's row whose ``keys`` equal ``columns``; one row out per row
    in, whatever the table holds.

    duplicates: ``refuse`` fails the query where a key has rows of different values (repeated equal
    rows are one); ``first`` takes the first in ``order_by``, ties by the values themselves. A null
    in a key matches nothing. Where no row matches, ``defaults`` (by value column) or null.

    The table is brought to one row a key by an aggregation that combines on the map side. How to
    join is left to Spark, which broadcasts the table only when it has measured it, and otherwise
    splits a key of ``df`` that holds a large part of its rows.
    """
    if duplicates not in (REFUSE, FIRST):
        raise ValueError(f"duplicates must be {REFUSE!r} or {FIRST!r}, not {duplicates!r}")
    if duplicates == FIRST and not order_by:
        raise ValueError("taking the first of several rows needs an order")
    clash = [v for v in values if v in df.columns]
    if clash:
        raise ValueError(f"columns {clash} are there already")
    names = [f"__key{i}" for i in range(len(keys))]
    row = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    known = table.where(" and ".join(f"`{k}` is not null" for k in keys))
    grouped = known.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    if duplicates == FIRST:
        order = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order_by)], row.alias("row"))
        found = grouped.agg(F.min(order).alias("first")).select(*names, F.col("first.row").alias("__row"))
    else:
        told = F.concat(F.lit("several rows of the table for the key "), F.concat_ws(", ", *[F.col(n).cast("string") for n in names]))
        least, largest = F.min(row), F.max(row)
        found = grouped.agg(least.alias("a"), largest.alias("b")).select(
            *names, F.when(F.col("a").eqNullSafe(F.col("b")), F.col("a")).otherwise(F.raise_error(told).cast(table.select(row.alias("r")).schema["r"].dataType)).alias("__row")
        )
    on = [F.col(f"`{c}`") == F.col(n) for c, n in zip(columns, names, strict=True)]
    joined = df.join(found, on, "left")
    chosen = []
    for i, v in enumerate(values):
        value = F.col(f"__row.v{i}")
        if defaults and v in defaults:
            value = F.when(F.col("__row").isNull(), F.lit(defaults[v])).otherwise(value)
        chosen.append(value.alias(v))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *chosen)


__all__ = ["FIRST", "REFUSE", "table_lookup"]
