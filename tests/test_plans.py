"""Plan shape: no Python UDFs, no cartesian product of data, filters reach the parquet scan of
gold tables, calendar dimensions broadcast."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from kpi_lake.operators import context as C
from kpi_lake.operators.measures import evaluate
from kpi_lake.plans import dashboard as Dsh
from kpi_lake.plans.catalog import saved_performance_context
from kpi_lake.plans.semantic import CATALOG, MODEL_TABLES, build_model
from kpi_lake.sources.layers import Lake, read_table

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["sales_by_industry", "page_performance", "trend_entities", "bridge_count", "surrogate_key"])
def test_no_python_udf_and_no_cartesian(spark, name):
    plan = plan_text(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan


@pytest.fixture(scope="module")
def gold_lake(spark, tmp_path_factory):
    from kpi_lake.plans.pipelines import run_all

    lake = Lake(root=str(tmp_path_factory.mktemp("gold")))
    run_all(spark, SF, lake)
    return lake


def test_slicer_range_is_pushed_to_gold_scan(spark, gold_lake):
    model = build_model({t: read_table(spark, gold_lake, "gold", t) for t in MODEL_TABLES})
    df = evaluate(model, saved_performance_context(), ["total_sales"], CATALOG)
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(date_sales_id), GreaterThanOrEqual(date_sales_id,1996-03-30)" in plan
    # the calendar side of the semi join is broadcast; the fact scan reads two columns only
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "ReadSchema: struct<date_sales_id:date,domestic_sale:bigint>" in plan


def test_page_over_gold_equals_page_over_sources(spark, gold_lake):
    gold_model = build_model({t: read_table(spark, gold_lake, "gold", t) for t in MODEL_TABLES})
    a = Dsh.page(gold_model, saved_performance_context(), "performance").collect()
    b = E.queries()["page_performance"](spark, SF).collect()
    assert a == b


def test_one_agg_per_fact_for_a_page(spark):
    # four measures of one page over two facts: two aggregate groups, not four
    from kpi_lake.operators.measures import _as_items

    base, derived, _ = _as_items(CATALOG, ["total_attendance", "training_days", "total_loan", "loan_approved"])
    assert len(base) == 4 and len(derived) == 1
    df = evaluate(E._catalog.model(spark, SF), C.EMPTY, ["total_attendance", "training_days"], CATALOG)
    final = plan_text(df).split("== Initial Plan ==")[0]
    # both measures come from one scan and one aggregate
    assert final.count("FileScan parquet") == 1
    assert final.count("HashAggregate(keys=[], functions=[sum(") == 1


def test_date_partitioned_facts_prune_and_agree(spark, tmp_path_factory, gold_lake):
    from kpi_lake.plans.pipelines import run_all

    lake = Lake(root=str(tmp_path_factory.mktemp("gold_partitioned")))
    run_all(spark, SF, lake, partition_facts=True)
    part_model = build_model({t: read_table(spark, lake, "gold", t) for t in MODEL_TABLES})
    flat_model = build_model({t: read_table(spark, gold_lake, "gold", t) for t in MODEL_TABLES})
    a = Dsh.page(part_model, saved_performance_context(), "performance")
    assert a.collect() == Dsh.page(flat_model, saved_performance_context(), "performance").collect()
    plan = plan_text(evaluate(part_model, saved_performance_context(), ["total_sales"], CATALOG))
    import re

    part_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert re.search(r"date_sales_id#\d+ >= 1996-03-30", part_filters), part_filters
