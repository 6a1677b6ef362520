"""Look-up tables, month shifts with gaps, date sets and highlights on a chart, versioned tables, nested merges."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from star_fixture import star_model

from kpi_lake.functions.formatting import format_kpi
from kpi_lake.operators import context as C
from kpi_lake.operators.lookup import table_lookup
from kpi_lake.operators.measures import evaluate, evaluate_by, highlight_by
from kpi_lake.operators.timeintel import shift_months
from kpi_lake.plans.pipelines import run_all
from kpi_lake.plans.semantic import CATALOG, LAST_MONTH_SALES, TOTAL_SALES
from kpi_lake.sources import layers
from kpi_lake.sources.layers import Lake, SchemaConflictError, read_table, remove_unreferenced, write_table


# --- look-ups ------------------------------------------------------------------------------------------


def test_lookup_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "zz"), (5, "b")], "i int, k string")
    table = spark.createDataFrame([("a", 10), ("a", 10), ("b", None), (None, 99)], "key string, v int")
    got = table_lookup(df, ["k"], table, ["key"], ["v"], defaults={"v": -1}).orderBy("i")
    assert [(r.i, r.v) for r in got.collect()] == [(1, 10), (2, -1), (3, 10), (4, -1), (5, None)]
    assert "BroadcastExchange" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_with_several_rows_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, k string")
    table = spark.createDataFrame([("a", 3, "x"), ("a", 2, "y"), ("a", 2, "w"), ("b", None, "z")], "key string, v int, t string")
    with pytest.raises(Exception, match="several rows of the table for the key a"):
        table_lookup(df, ["k"], table, ["key"], ["v"]).collect()
    got = table_lookup(df, ["k"], table, ["key"], ["v", "t"], "first", ["v"]).orderBy("i").collect()
    assert [(r.v, r.t) for r in got] == [(2, "w"), (None, "z")]
    for bad in (dict(duplicates="any"), dict(duplicates="first")):
        with pytest.raises(ValueError):
            table_lookup(df, ["k"], table, ["key"], ["v"], **bad)
    with pytest.raises(ValueError, match="already"):
        table_lookup(df.withColumn("v", F.lit(1)), ["k"], table, ["key"], ["v"])


# --- month shifts ---------------------------------------------------------------------------------------


def test_a_selection_with_a_gap_is_refused(spark):
    model = star_model(spark)
    gap = C.EMPTY.where("date_sales", C.in_list("date_sales_id", [dt.date(2024, 2, 15), dt.date(2024, 3, 1)]), "date_sales_id")
    with pytest.raises(Exception, match="have a gap"):
        evaluate(model, gap, ["last_month_sales"], CATALOG).collect()
    with pytest.raises(Exception, match="have a gap"):
        evaluate_by(model, gap, "success_profile", ["industry"], ["last_month_sales"], CATALOG).collect()
    with pytest.raises(Exception, match="have a gap"):
        LAST_MONTH_SALES.rows(model, gap).collect()
    by_day = shift_months(TOTAL_SALES, "date_sales", "date_sales_id", "by_day", -1, contiguous=False)
    # 15 March and 29 February, moved back by a month and by itself: only 29 February is in the calendar
    march = C.EMPTY.where("date_sales", C.in_list("date_sales_id", [dt.date(2024, 3, 15), dt.date(2024, 2, 29)]), "date_sales_id")
    assert evaluate(model, march, [by_day], CATALOG).first()[0] == 20
    assert evaluate(model, gap, ["current_month_sales", "total_sales"], CATALOG).first()[1] == 100  # no shift, no gap


def test_days_that_the_calendar_lacks_are_no_gap(spark):
    model = star_model(spark)
    ctx = C.EMPTY.where_range("date_sales", "date_sales_id", "2024-02-15", "2024-03-02")  # 15 and 29 February, 1 March
    assert evaluate(model, ctx, ["last_month_sales"], CATALOG).first()[0] is None  # 15 and 29 January, 1 February
    whole = C.EMPTY.where_range("date_sales", "date_sales_id", "2024-03-01", "2024-04-01")  # a whole month: February's end too
    assert evaluate(model, whole, ["last_month_sales"], CATALOG).first()[0] == 60
    end = C.EMPTY.where("date_sales", C.equals("date_sales_id", dt.date(2024, 3, 31)), "date_sales_id")
    assert evaluate(model, end, ["last_month_sales"], CATALOG).first()[0] == 40  # clamped to 29 February


@pytest.mark.parametrize(
    "bounds", [None, ("2024-02-15", "2024-03-16"), ("2024-03-01", "2024-04-01"), ("2030-01-01", None), (None, "2024-03-01")]
)
def test_date_sets_by_group_add_up(spark, bounds):
    """Per industry each measure equals its card under a filter on that industry."""
    model = star_model(spark)
    ctx = C.EMPTY if bounds is None else C.EMPTY.where_range("date_sales", "date_sales_id", *bounds)
    names = ["current_month_sales", "total_sales", "last_month_sales", "sales_target"]
    got = {r.industry: tuple(r[n] for n in names) for r in evaluate_by(model, ctx, "success_profile", ["industry"], names, CATALOG).collect()}
    want = {}
    for industry in ("Services", "Commerce", "Agribusiness"):
        row = tuple(evaluate(model, ctx.where("success_profile", C.equals("industry", industry), "industry"), names, CATALOG).first())
        if any(v is not None for v in row[:3]):
            want[industry] = row
    assert {k: v for k, v in got.items() if k is not None} == want
    total = evaluate(model, ctx, names, CATALOG).first()
    for i in range(3):
        assert sum(v[i] or 0 for v in got.values()) == (total[i] or 0)  # with the blank group


# --- highlights -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("picked", [("success_profile", "msme_category", "Micro"), ("date_success", "year_success", 2022), ("success_profile", "industry", "nothing")])
def test_highlights_equal_two_queries(spark, picked):
    model = star_model(spark)
    table, column, value = picked
    ctx = C.EMPTY.where("success_profile", C.in_list("departement", ["Nippes", "Ouest", "Sud-Est"]), "departement")
    selection = C.EMPTY.where(table, C.equals(column, value), column)
    chosen = [CATALOG[n] for n in ("total_msmes", "total_loan", "total_sales", "total_jobs")]
    names = [m.name for m in chosen]
    whole = {r.industry: r for r in evaluate_by(model, ctx, "success_profile", ["industry"], names, CATALOG).collect()}
    part = {r.industry: r for r in evaluate_by(model, ctx.merge(selection), "success_profile", ["industry"], names, CATALOG).collect()}
    got = {r.industry: r for r in highlight_by(model, ctx, selection, "success_profile", ["industry"], chosen).collect()}
    assert got.keys() == whole.keys()
    for industry, r in got.items():
        assert [r[n] for n in names] == [whole[industry][n] for n in names]
        assert [r[f"{n}_highlighted"] for n in names] == [part[industry][n] if industry in part else None for n in names]


# --- versioned tables -------------------------------------------------------------------------------------


def ids(spark, lake):
    return sorted(r.id for r in read_table(spark, lake, "gold", "t").collect())


def test_versions(spark, tmp_path):
    lake = Lake(root=str(tmp_path), versioned=True)
    write_table(spark.range(3), lake, "gold", "t")
    reader = read_table(spark, lake, "gold", "t")
    first = layers.refresh_id(spark, lake, "gold", "t")
    write_table(read_table(spark, lake, "gold", "t").where("id > 0"), lake, "gold", "t")  # reads what it replaces
    assert ids(spark, lake) == [1, 2] and reader.count() == 3  # begun before: the version before is still there
    assert layers.refresh_id(spark, lake, "gold", "t") != first
    write_table(spark.range(9, 10), lake, "gold", "t", mode="append")
    assert ids(spark, lake) == [1, 2, 9]
    write_table(spark.range(1), lake, "gold", "t")
    assert ids(spark, lake) == [0] and len([p for p in (tmp_path / "gold" / "t").iterdir() if p.name.startswith("v-")]) == 2
    with pytest.raises(SchemaConflictError):
        write_table(spark.range(2).selectExpr("cast(id as string) as id"), lake, "gold", "t")
    assert remove_unreferenced(spark, lake, "gold", "t") == []


@pytest.mark.parametrize("point", ["_point_to", "write_mark", "after", "save"])
def test_a_crash_at_any_point_leaves_a_table(spark, tmp_path, monkeypatch, point):
    lake = Lake(root=str(tmp_path), versioned=True)
    for n in (2, 3):
        write_table(spark.range(n), lake, "gold", "t")

    def crash(*_):
        raise RuntimeError("lost")

    bad = spark.range(5)
    if point == "save":
        bad = bad.select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    elif point == "after":
        monkeypatch.setattr(layers, "_delete", crash)
    else:
        monkeypatch.setattr(layers, point, crash)
    with pytest.raises(Exception, match="lost"):
        write_table(bad, lake, "gold", "t")
    assert ids(spark, lake) == ([0, 1, 2, 3, 4] if point == "after" else [0, 1, 2])
    monkeypatch.undo()
    write_table(spark.range(7), lake, "gold", "t")
    assert ids(spark, lake) == list(range(7))
    left = remove_unreferenced(spark, lake, "gold", "t")
    assert (left != []) == (point != "save") and ids(spark, lake) == list(range(7))


def test_a_whole_run_into_versions(spark, tmp_path):
    lake = Lake(root=str(tmp_path), versioned=True)
    for _ in range(2):
        report = run_all(spark, "/root/testdata/sf0.001", lake, durable_keys=True)
    assert report.quality["gold.sales_fact"]["rows_out"] == read_table(spark, lake, "gold", "sales_fact").count()


# --- nested merges -------------------------------------------------------------------------------------------


def test_merge_of_nested_columns(spark, tmp_path):
    lake = Lake(root=str(tmp_path))
    v1 = spark.sql("select 1 as id, named_struct('a', 1, 'b', named_struct('x', 'u')) as s, array(named_struct('p', 1)) as l, map('k', named_struct('m', 2)) as m")
    v2 = spark.sql(
        "select 2 as id, named_struct('b', named_struct('y', 5), 'c', 3L) as s, array(named_struct('q', 'w'), null) as l, map('k', named_struct('n', 1.5D), 'z', null) as m, 7 as fresh "
        "union all select 3, null, null, null, null"
    )
    write_table(v1, lake, "gold", "t", schema_mode="merge")
    write_table(v2, lake, "gold", "t", schema_mode="merge")
    got = read_table(spark, lake, "gold", "t").orderBy("id")
    assert got.schema["s"].dataType.simpleString() == "struct<a:int,b:struct<x:string,y:int>,c:bigint>"
    assert got.schema["l"].dataType.simpleString() == "array<struct<p:int,q:string>>"
    assert got.schema["m"].dataType.simpleString() == "map<string,struct<m:int,n:double>>"
    two, three = (r.asDict(recursive=True) for r in got.collect())
    assert two == {
        "id": 2, "s": {"a": None, "b": {"x": None, "y": 5}, "c": 3}, "l": [{"p": None, "q": "w"}, None],
        "m": {"k": {"m": None, "n": 1.5}, "z": None}, "fresh": 7,
    }
    assert three == {"id": 3, "s": None, "l": None, "m": None, "fresh": None}
    with pytest.raises(SchemaConflictError, match=r"s\.b\.y"):
        write_table(spark.sql("select 4 as id, named_struct('b', named_struct('y', 'text')) as s"), lake, "gold", "t", schema_mode="merge")


# --- display units ---------------------------------------------------------------------------------------------


def test_display_units_divide_exactly(spark):
    df = spark.sql("select 1.000000009D as v, 1e25D as big, -1234567.5D as neg, cast(null as double) as none")
    row = df.select(
        format_kpi("v", "currency", 1000).alias("v"), format_kpi("big", "currency").alias("big"), format_kpi("big", "integer", 1000).alias("k"),
        format_kpi("neg", "currency", 1000000).alias("neg"), format_kpi("none", "currency", 1000).alias("none"),
    ).first()
    assert tuple(row) == ("$0.001000000009K", "1.0E25", "1.0E25", "($1.2345675M)", None)
