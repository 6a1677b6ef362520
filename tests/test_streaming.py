"""Incremental silver: two bronze deliveries, two refreshes, each file cleaned once."""

from __future__ import annotations

from kpi_lake.plans.pipelines import silver_sales
from kpi_lake.sources.layers import Lake, read_table, write_table
from kpi_lake.streaming import refresh_silver_incrementally


def test_incremental_refresh_matches_batch(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    schema = "sales_key string, msme_key string, sales_reporting_date string, domestic_sale long, international_sale string"
    first = spark.createDataFrame([("s1", "m1", "1/5/2024", 10, None), ("s2", "m2", "bad", None, "3")], schema)
    second = spark.createDataFrame([("s3", "m1", "2/29/2024", 7, "1")], schema)
    ckpt = f"{scratch_dir}/ckpt"
    write_table(first, lake, "bronze", "success_sales")
    refresh_silver_incrementally(spark, lake, "sales_updated", checkpoint=ckpt)
    assert read_table(spark, lake, "silver", "sales_updated").count() == 2
    write_table(second, lake, "bronze", "success_sales", mode="append")
    refresh_silver_incrementally(spark, lake, "sales_updated", checkpoint=ckpt)
    got = sorted(map(tuple, read_table(spark, lake, "silver", "sales_updated").collect()))
    want = sorted(map(tuple, silver_sales(first.unionByName(second)).collect()))
    assert got == want


def test_command_line_refresh_and_page(spark, scratch_dir):
    from kpi_lake.__main__ import main

    assert main(["refresh", "--sf-dir", "/root/testdata/sf0.001", "--lake", scratch_dir, "--parallelism", "2"]) == 0
    assert main(["page", "performance", "--lake", scratch_dir]) == 0
    assert main(["page", "registration", "--lake", scratch_dir, "--year", "1996"]) == 0


def test_command_line_layer_by_layer(spark, scratch_dir):
    from kpi_lake.__main__ import main
    from kpi_lake.sources.layers import Lake
    from kpi_lake.sources.standins import bronze_from_sources

    lake = Lake(root=scratch_dir)
    bronze = bronze_from_sources(spark, "/root/testdata/sf0.001")
    for name in bronze:
        write_table(bronze[name], lake, "bronze", name)
    assert main(["silver", "--lake", scratch_dir, "--parallelism", "2"]) == 0
    assert main(["gold", "--lake", scratch_dir, "--parallelism", "2"]) == 0
    assert read_table(spark, lake, "gold", "sales_fact").count() == read_table(spark, lake, "bronze", "success_sales").count()
    assert main(["page", "activity", "--lake", scratch_dir]) == 0
