"""Filter propagation, direction rules, grouping with a blank member, measures and overrides."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpi_lake.operators import context as C
from kpi_lake.operators.measures import Measure, evaluate, evaluate_by
from kpi_lake.plans.semantic import CATALOG
from tests.star_fixture import star_model


@pytest.fixture(scope="module")
def model(spark):
    return star_model(spark)


def value(model, ctx, name):
    return evaluate(model, ctx, [name], CATALOG).first()[name]


def test_unfiltered_totals(model):
    assert value(model, C.EMPTY, "total_sales") == 630
    assert value(model, C.EMPTY, "total_jobs") == 10
    assert value(model, C.EMPTY, "total_attendance") == 150
    assert value(model, C.EMPTY, "total_msmes") == 4
    assert value(model, C.EMPTY, "training_days") == 52 / 8


def REG_2022():
    return C.EMPTY.where("date_success", C.in_list("year_success", [2022]), "year_success")


def MICRO():
    return C.EMPTY.where("success_profile", C.in_list("msme_category", ["Micro"]), "msme_category")


def SALES_FEB():
    return C.EMPTY.where("date_sales", C.between("date_sales_id", "2024-02-01", "2024-03-01"), "date_sales_id")


@pytest.mark.parametrize(
    "ctx, measure, expected",
    [
        # registration year reaches profile (two-way 1:1), then sales and jobs; not activities
        (REG_2022, "total_msmes", 2),
        (REG_2022, "total_sales", 20 + 80 + 320),
        (REG_2022, "total_jobs", 5),
        (REG_2022, "total_attendance", 150),
        # category reaches sales and jobs, never attendance (bridge is one-way)
        (MICRO, "total_sales", 10 + 40 + 80),
        (MICRO, "total_jobs", 7),
        (MICRO, "total_attendance", 150),
        # a sales period does not reach jobs or businesses
        (SALES_FEB, "total_sales", 60),
        (SALES_FEB, "total_jobs", 10),
        (SALES_FEB, "total_msmes", 4),
    ],
)
def test_reach_table(model, ctx, measure, expected):
    assert value(model, ctx(), measure) == expected


def test_hiring_filter_reaches_jobs_once(model):
    """A job with three matching hires is counted once (semi join, no fan-out)."""
    ctx = C.EMPTY.where("hiring", F.col("age") < 35, "age")
    assert value(model, ctx, "total_jobs") == 5


def test_fact_filter_reaches_profile_through_two_way_relationship(model):
    ctx = C.EMPTY.where("success_fact", F.col("annual_income") >= 30000, "annual_income")
    assert value(model, ctx, "total_msmes") == 2


def test_profile_filter_does_not_reach_activity_through_bridge(model):
    assert not model.is_filtered("activity_fact", MICRO())
    # the profile filters the bridge rows (one -> many), which do not pass it on to activities
    assert model.is_filtered("participant_updated", MICRO())
    assert model.path("success_profile", "activity_fact") is None
    assert model.path("support_activity", "participant_updated") is not None


def test_count_where_case_insensitive_and_override(model):
    assert value(model, C.EMPTY, "loan_approved") == 2
    ctx = C.EMPTY.where("success_profile", C.equals("financial_institution", "no"), "financial_institution")
    # the measure's own filter replaces the context filter on that column
    assert value(model, ctx, "loan_approved") == 2
    assert value(model, ctx, "total_msmes") == 1
    none = C.EMPTY.where("success_profile", C.in_list("msme_category", ["Medium"]), "msme_category")
    assert value(model, none, "loan_approved") is None


def test_targets(model):
    row = evaluate(model, C.EMPTY, ["total_sales", "sales_target", "msme_target", "jobs_target"], CATALOG).first()
    from decimal import Decimal

    assert row["sales_target"] == Decimal("661.50")
    assert row["msme_target"] == Decimal("4.40")
    assert row["jobs_target"] == Decimal("11.00")


def test_group_blank_member_and_its_disappearance(model):
    rows = {r["support_name"]: r["total_attendance"] for r in evaluate_by(model, C.EMPTY, "support_activity", ["support_name"], ["total_attendance"], CATALOG).collect()}
    # sup09 has no dimension row and the null support id matches nothing: both in the blank group
    assert rows == {"Training": 10, "Coaching": 20, None: 120}
    assert sum(rows.values()) == value(model, C.EMPTY, "total_attendance")
    filtered = C.EMPTY.where("support_activity", F.col("support_name") != "Training", "support_name")
    rows = {r["support_name"]: r["total_attendance"] for r in evaluate_by(model, filtered, "support_activity", ["support_name"], ["total_attendance"], CATALOG).collect()}
    assert rows == {"Coaching": 20}


def test_group_across_two_hops(model):
    rows = {r["registration_date_id"]: r["total_msmes"] for r in evaluate_by(model, C.EMPTY, "date_success", ["registration_date_id"], ["total_msmes"], CATALOG).collect()}
    assert rows == {dt.date(2021, 1, 10): 1, dt.date(2022, 5, 1): 1, dt.date(2022, 7, 9): 1, None: 1}


def test_group_sums_equal_grand_total(model):
    rows = evaluate_by(model, C.EMPTY, "success_profile", ["industry"], ["total_sales"], CATALOG).collect()
    assert sum(r["total_sales"] for r in rows) == 630
    assert {r["industry"] for r in rows} == {"Services", "Commerce", "Agribusiness", None}


def test_bridge_count(model):
    businesses = Measure("businesses", "participant_updated", "count_distinct", column="msme_key", result_type="bigint")
    rows = {r["support_name"]: r["businesses"] for r in evaluate_by(model, C.EMPTY, "support_activity", ["support_name"], [businesses]).collect()}
    assert rows == {"Training": 2, "Coaching": 1, None: 2}


def test_interaction_exception(model):
    from kpi_lake.plans import dashboard as Dsh

    ctx = Dsh.activity_context(activity_period=[(2024, 1)], registration_period=[(2022,)])
    assert Dsh.for_visual(ctx, "loan_by_category").filters[0].name == Dsh.SL_REG_PERIOD
    rows = {r["industry"]: float(r["total_loan"]) for r in Dsh.loan_by_category(model, ctx).collect()}
    assert rows == {"Commerce": 200.5}


def test_hierarchy_slicer(model):
    ctx = C.EMPTY.where("date_success", C.hierarchy(["year_success", "quarter_success"], [(2021,), (2022, 3)]), ("year_success", "quarter_success"))
    assert value(model, ctx, "total_msmes") == 2


def test_grouped_measures_from_two_facts_are_joined_per_group(model):
    both = {r["industry"]: (r["total_sales"], r["total_jobs"]) for r in evaluate_by(model, C.EMPTY, "success_profile", ["industry"], ["total_sales", "total_jobs", "total_msmes"], CATALOG).collect()}
    sales = {r["industry"]: r["total_sales"] for r in evaluate_by(model, C.EMPTY, "success_profile", ["industry"], ["total_sales"], CATALOG).collect()}
    jobs = {r["industry"]: r["total_jobs"] for r in evaluate_by(model, C.EMPTY, "success_profile", ["industry"], ["total_jobs"], CATALOG).collect()}
    assert set(both) == set(sales) | set(jobs)
    for k, (s, j) in both.items():
        assert s == sales.get(k) and j == jobs.get(k)


# (slicer table, filtered column, table of a measure, reached?) — the reach table of the pages.
REACH = [
    ("success_profile", "departement", "success_profile", True),
    ("success_profile", "departement", "success_fact", True),
    ("success_profile", "departement", "date_success", False),
    ("date_success", "year_success", "success_fact", True),
    ("date_success", "year_success", "success_profile", True),
    ("date_success", "year_success", "sales_fact", True),
    ("date_success", "year_success", "job_fact", True),
    ("date_success", "year_success", "activity_fact", False),
    ("date_activity", "year_activity", "activity_fact", True),
    ("date_activity", "year_activity", "participant_updated", True),
    ("date_activity", "year_activity", "success_fact", False),
    ("date_activity", "year_activity", "success_profile", False),
    ("date_sales", "date_sales_id", "sales_fact", True),
    ("date_sales", "date_sales_id", "job_fact", False),
    ("date_sales", "date_sales_id", "success_profile", False),
    ("date_job", "date_job_id", "job_fact", True),
    ("date_job", "date_job_id", "sales_fact", False),
    ("success_profile", "msme_category", "sales_fact", True),
    ("success_profile", "msme_category", "job_fact", True),
    ("success_profile", "msme_category", "activity_fact", False),
    ("hiring", "age", "job_fact", True),
    ("firing", "age", "job_fact", True),
    ("job_fact", "msme_key", "hiring", False),
]


@pytest.mark.parametrize("slicer_table, column, target, reached", REACH)
def test_reach_of_every_slicer(model, slicer_table, column, target, reached):
    ctx = C.EMPTY.where(slicer_table, F.col(column).isNotNull(), column)
    assert model.is_filtered(target, ctx) is reached


def test_grouped_measures_of_one_fact_share_a_scan(model, spark):
    from kpi_lake.operators.measures import Measure

    fired = Measure("fired", "job_fact", "sum", column="total_fired_employee", result_type="bigint")
    reports = Measure("reports", "job_fact", "count_rows", result_type="bigint")
    df = evaluate_by(model, C.EMPTY, "success_profile", ["industry"], ["total_jobs", fired, reports], CATALOG)
    rows = {r["industry"]: (r["total_jobs"], r["fired"], r["reports"]) for r in df.collect()}
    assert rows == {"Services": (5, 1, 1), "Commerce": (3, 0, 1), "Agribusiness": (2, 2, 1)}
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 1  # one join to the mapping
