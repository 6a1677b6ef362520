"""Filter context editing: exemptions, column replacement, literal bounds, hierarchy members."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpi_lake.operators import context as C

D = dt.date


def rows(spark, ctx, table):
    df = spark.createDataFrame(
        [(D(2024, 1, 5), 2024, 1, "Micro"), (D(2024, 4, 5), 2024, 2, "Small"), (D(2023, 7, 1), 2023, 3, None)],
        "d date, y int, q int, cat string",
    )
    pred = ctx.predicate_for(table)
    return sorted(r["d"] for r in (df.filter(pred) if pred is not None else df).collect())


def test_without_drops_named_slicers_only(spark):
    ctx = C.EMPTY.where("t", F.col("y") == 2024, "y", "year").where("t", F.col("cat") == "Micro", "cat", "category")
    assert rows(spark, ctx, "t") == [D(2024, 1, 5)]
    assert rows(spark, ctx.without("year"), "t") == [D(2024, 1, 5)]
    assert rows(spark, ctx.without("category"), "t") == [D(2024, 1, 5), D(2024, 4, 5)]
    assert ctx.without("nothing").same_as(ctx)


def test_replacing_and_removing_columns(spark):
    ctx = C.EMPTY.where("t", F.col("cat") == "Micro", "cat").where("t", F.col("y") == 2024, "y")
    assert rows(spark, ctx.replacing("t", "cat", F.col("cat") == "Small"), "t") == [D(2024, 4, 5)]
    assert rows(spark, ctx.removing_columns("t", ["cat"]), "t") == [D(2024, 1, 5), D(2024, 4, 5)]
    assert ctx.removing_table("t").predicate_for("t") is None
    assert ctx.tables() == {"t"}


def test_key_bounds_intersect_literal_ranges():
    ctx = C.EMPTY.where_range("cal", "d", "2024-01-01", "2024-06-01").where_range("cal", "d", "2024-02-01", None)
    assert ctx.key_bounds("cal", "d") == (D(2024, 2, 1), D(2024, 6, 1))
    assert ctx.key_bounds("cal", "other") is None
    assert C.EMPTY.where("cal", C.until("d", "2024-01-01"), "d").key_bounds("cal", "d") is None  # opaque predicate


def test_hierarchy_members(spark):
    ctx = C.EMPTY.where("t", C.hierarchy(["y", "q"], [(2023,), (2024, 2)]), ("y", "q"))
    assert rows(spark, ctx, "t") == [D(2023, 7, 1), D(2024, 4, 5)]
    with pytest.raises(ValueError):
        C.hierarchy(["y"], [(2024, 1)])


def test_equals_null_means_blank(spark):
    ctx = C.EMPTY.where("t", C.equals("cat", None), "cat")
    assert rows(spark, ctx, "t") == [D(2023, 7, 1)]
    ctx = C.EMPTY.where("t", C.values_not_blank("cat"), "cat")
    assert rows(spark, ctx, "t") == [D(2024, 1, 5), D(2024, 4, 5)]
