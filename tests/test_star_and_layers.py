"""Dimensions, keys, layered writes (keep / replace / merge), full-refresh idempotence."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpi_lake.operators import star
from kpi_lake.sources.layers import Lake, SchemaConflictError, read_table, write_many, write_table

D = dt.date


def test_date_dimension_unique_with_gaps_and_null(spark):
    fact = spark.createDataFrame(
        [(D(2024, 1, 1), 1, 1, 1, 2024), (D(2024, 1, 1), 1, 1, 1, 2024), (D(2024, 1, 3), 3, 1, 1, 2024), (None, None, None, None, None)],
        "d date, day int, month int, quarter int, year int",
    )
    dim = star.date_dimension(fact, "d", ["day", "month", "quarter", "year"], id_name="date_id")
    rows = dim.collect()
    assert len(rows) == 3
    assert dim.groupBy("date_id").count().filter("count > 1").count() == 0
    assert {r["date_id"] for r in rows} == {D(2024, 1, 1), D(2024, 1, 3), None}


def test_attribute_dimension_labels_null_code(spark):
    fact = spark.createDataFrame([("sup01",), ("sup01",), (None,), ("x",)], "support_type string")
    dim = star.attribute_dimension(fact, "support_type", "support_id", "support_name", {"sup01": "Training"}, "Other")
    assert sorted((r[0] or "", r[1]) for r in dim.collect()) == [("", "Other"), ("sup01", "Training"), ("x", "Other")]


def test_sequence_key_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    keyed = star.sequence_key(df, ["k"], "sk")
    rows = keyed.collect()
    assert sorted(r["sk"] for r in rows) == list(range(1, 5001))
    assert all(r["sk"] == r["k"] + 1 for r in rows)


def test_surrogate_hash_key_is_stable(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int")
    a = {r["x"]: r["sk"] for r in star.surrogate_key(df, ["x", "y"]).collect()}
    b = {r["x"]: r["sk"] for r in star.surrogate_key(df.repartition(3), ["x", "y"]).collect()}
    assert a == b and a["a"] != a["b"]


def test_orphans_and_duplicates(spark):
    fact = spark.createDataFrame([("a1", "m1"), ("a9", "m2"), (None, "m3")], "activity_id string, msme_key string")
    dim = spark.createDataFrame([("a1",), ("a2",)], "activity_id string")
    assert [r["activity_id"] for r in star.orphan_keys(fact, "activity_id", dim, "activity_id").collect()] == ["a9"]
    hires = spark.createDataFrame([("j1",), ("j1",), ("j2",)], "job_key string")
    assert [(r[0], r[1]) for r in star.duplicate_keys(hires, ["job_key"]).collect()] == [("j1", 2)]
    nulls = star.null_keys(fact, ["activity_id"]).first()
    assert nulls["activity_id_nulls"] == 1


def test_write_keep_replace_merge(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    v1 = spark.createDataFrame([(1, "a", 7)], "id int, name string, area_id bigint")
    write_table(v1, lake, "gold", "t")
    v2 = spark.createDataFrame([(2, "b")], "id int, name string")
    write_table(v2, lake, "gold", "t", schema_mode="merge")
    got = read_table(spark, lake, "gold", "t")
    assert sorted(got.columns) == ["area_id", "id", "name"]
    assert [tuple(r) for r in got.select("id", "name", "area_id").collect()] == [(2, "b", None)]
    conflict = spark.createDataFrame([("x", "c")], "id string, name string")
    with pytest.raises(SchemaConflictError):
        write_table(conflict, lake, "gold", "t")
    write_table(conflict, lake, "gold", "t", schema_mode="replace")
    got = read_table(spark, lake, "gold", "t")
    assert got.columns == ["id", "name"] and [tuple(r) for r in got.collect()] == [("x", "c")]


def test_write_many_runs_plan_once_and_copies(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    df = spark.createDataFrame([("sup01", "Training")], "support_id string, support_name string")
    paths = write_many(df, [(lake, "silver", "s"), (lake, "gold", "s")])
    assert len(paths) == 2
    assert read_table(spark, lake, "gold", "s").collect() == read_table(spark, lake, "silver", "s").collect()


def test_full_refresh_is_idempotent(spark, scratch_dir):
    from kpi_lake.plans.pipelines import run_all

    lake = Lake(root=scratch_dir)
    run_all(spark, "/root/testdata/sf0.001", lake)
    first = {t: sorted(map(tuple, read_table(spark, lake, "gold", t).collect()), key=str) for t in ["success_fact", "activity_fact", "date_sales", "support_activity"]}
    run_all(spark, "/root/testdata/sf0.001", lake)
    second = {t: sorted(map(tuple, read_table(spark, lake, "gold", t).collect()), key=str) for t in first}
    assert first == second
    # gold tables land with the declared columns
    assert read_table(spark, lake, "gold", "hiring").columns == [
        "employee_key", "job_key", "age", "sex", "contract_duration", "is_full_time", "have_insurance",
        "thanks_to_project_support", "is_decent_work",
    ]
    assert "nom_employe" not in read_table(spark, lake, "gold", "firing").columns


def test_atomic_overwrite_keeps_old_table_on_failure_and_allows_self_overwrite(spark, scratch_dir):
    import os

    lake = Lake(root=scratch_dir)
    write_table(spark.createDataFrame([(1, "a")], "id int, v string"), lake, "gold", "t")
    bad = spark.createDataFrame([(1, "x")], "id int, v string").select("id", F.raise_error(F.lit("boom")).cast("string").alias("v"))
    with pytest.raises(Exception):
        write_table(bad, lake, "gold", "t")
    assert [tuple(r) for r in read_table(spark, lake, "gold", "t").collect()] == [(1, "a")]
    # a frame derived from the table itself can replace it
    cur = read_table(spark, lake, "gold", "t")
    write_table(cur.withColumn("id", F.col("id") + 1), lake, "gold", "t")
    assert [tuple(r) for r in read_table(spark, lake, "gold", "t").collect()] == [(2, "a")]
    assert os.listdir(os.path.join(scratch_dir, "gold")) == ["t"]  # no staging or retired folders left


def test_append_checks_types(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    write_table(spark.createDataFrame([(1, "a")], "id int, v string"), lake, "bronze", "t")
    write_table(spark.createDataFrame([(2, "b")], "id int, v string"), lake, "bronze", "t", mode="append")
    assert read_table(spark, lake, "bronze", "t").count() == 2
    with pytest.raises(SchemaConflictError):
        write_table(spark.createDataFrame([("x", "c")], "id string, v string"), lake, "bronze", "t", mode="append")
