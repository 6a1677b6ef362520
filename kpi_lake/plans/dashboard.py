"""The report's pages as DataFrame queries: cards, gauges, charts, slicers and whole pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_lake.operators import context as C
from kpi_lake.operators.context import FilterContext
from kpi_lake.operators.measures import evaluate, evaluate_by, share_of_total
from kpi_lake.operators.model import StarModel
from kpi_lake.operators.visuals import Visual, evaluate_visuals
from kpi_lake.plans.semantic import CATALOG

# Slicer settings saved in the report. The year list restricts the items the
# registration-year slicer offers (a filter on the slicer itself, not a selection); the sales
# range and the job end date are saved selections that filter their page.
REPORT_REGISTRATION_YEARS = (2021, 2022, 2023, 2024, 2025)
REPORT_SALES_RANGE = ("2022-03-30", "2024-10-10")  # shown end 2024-10-09, end exclusive
REPORT_JOBS_UNTIL = "2024-10-01"  # exclusive

# Slicer names (used by interaction exceptions).
SL_REG_YEAR = "registration_year"
SL_REG_PERIOD = "registration_period"
SL_ACTIVITY_PERIOD = "activity_period"
SL_CATEGORY = "msme_category"
SL_DEPARTEMENT = "departement"
SL_PARTNER = "business_partner"
SL_SALES_RANGE = "sales_period"
SL_JOBS_UNTIL = "jobs_period"


# --- contexts of the pages ------------------------------------------------------------------------


def _profile_slicers(ctx: FilterContext, categories=None, departements=None, partners=None) -> FilterContext:
    if categories:
        ctx = ctx.where("success_profile", C.in_list("msme_category", categories), "msme_category", SL_CATEGORY)
    if departements:
        ctx = ctx.where("success_profile", C.in_list("departement", departements), "departement", SL_DEPARTEMENT)
    if partners:
        ctx = ctx.where("success_profile", C.in_list("business_partner", partners), "business_partner", SL_PARTNER)
    return ctx


def registration_context(
    years: Sequence[int] | None = None,
    period: Sequence[Sequence[int]] = (),
    categories: Sequence[str] = (),
    departements: Sequence[str] = (),
    partners: Sequence[str] = (),
) -> FilterContext:
    """Registration page: year selection, year/quarter hierarchy, profile slicers.

    The saved page has no selection, so the default context is empty.
    """
    ctx = C.EMPTY
    if years:
        ctx = ctx.where_periods("date_success", "registration_date_id", ["year_success"], [(y,) for y in years], SL_REG_YEAR)
    if period:
        ctx = ctx.where_periods("date_success", "registration_date_id", ["year_success", "quarter_success"], period, SL_REG_PERIOD)
    return _profile_slicers(ctx, categories, departements, partners)


def activity_context(
    activity_period: Sequence[Sequence[int]] = (),
    registration_period: Sequence[Sequence[int]] = (),
    categories: Sequence[str] = (),
    departements: Sequence[str] = (),
    partners: Sequence[str] = (),
) -> FilterContext:
    """Activity page: activity year/quarter, registration year/quarter, profile slicers."""
    ctx = C.EMPTY
    if activity_period:
        levels = ["year_activity", "quarter_activity"]
        ctx = ctx.where_periods("date_activity", "activity_date_id", levels, activity_period, SL_ACTIVITY_PERIOD)
    if registration_period:
        levels = ["year_success", "quarter_success"]
        ctx = ctx.where_periods("date_success", "registration_date_id", levels, registration_period, SL_REG_PERIOD)
    return _profile_slicers(ctx, categories, departements, partners)


def performance_context(
    sales_range: tuple[str | None, str | None] | None = None,
    jobs_until: str | None = None,
    categories: Sequence[str] = (),
    departements: Sequence[str] = (),
    partners: Sequence[str] = (),
) -> FilterContext:
    """Performance page: sales date range, job date upper bound, profile slicers.

    A slicer that isn't given doesn't filter; ``REPORT_SALES_RANGE`` and ``REPORT_JOBS_UNTIL`` are
    the selections saved in the report.
    """
    ctx = C.EMPTY
    if sales_range:
        ctx = ctx.where_range("date_sales", "date_sales_id", sales_range[0], sales_range[1], SL_SALES_RANGE)
    if jobs_until:
        ctx = ctx.where_range("date_job", "date_job_id", None, jobs_until, SL_JOBS_UNTIL)
    return _profile_slicers(ctx, categories, departements, partners)


def cross_filter(ctx: FilterContext, table: str, column: str, value: object) -> FilterContext:
    """Selecting one category in a chart filters the page's other visuals by that value."""
    return ctx.where(table, C.equals(column, value), column, f"selection:{table}.{column}")


# Visual -> slicers that do not filter it (interaction exceptions of the pages).
INTERACTION_EXCEPTIONS = {"loan_by_category": (SL_ACTIVITY_PERIOD,)}


def for_visual(ctx: FilterContext, visual: str) -> FilterContext:
    return ctx.without(*INTERACTION_EXCEPTIONS.get(visual, ()))


# --- visuals ----------------------------------------------------------------------------------------


def card(model: StarModel, ctx: FilterContext, measure: str) -> DataFrame:
    return evaluate(model, ctx, [measure], CATALOG)


def gauge(model: StarModel, ctx: FilterContext, value: str, target: str) -> DataFrame:
    return evaluate(model, ctx, [value, target], CATALOG)


def trend_entities(model: StarModel, ctx: FilterContext) -> DataFrame:
    """Line chart: businesses by registration date, date ascending."""
    return evaluate_by(model, ctx, "date_success", ["registration_date_id"], ["total_msmes"], CATALOG).orderBy("registration_date_id")


def share_by_category(model: StarModel, ctx: FilterContext, category: str = "industry") -> DataFrame:
    """Donut: businesses by industry with each slice's share, largest first."""
    grouped = evaluate_by(model, ctx, "success_profile", [category], ["total_msmes"], CATALOG)
    return share_of_total(grouped, "total_msmes").orderBy(F.desc("total_msmes"), category)


def loan_by_category(model: StarModel, ctx: FilterContext, category: str = "industry") -> DataFrame:
    """Columns: total loan by industry, largest first (not filtered by the activity period)."""
    ctx = for_visual(ctx, "loan_by_category")
    return evaluate_by(model, ctx, "success_profile", [category], ["total_loan"], CATALOG).orderBy(F.desc("total_loan"), category)


def attendance_by_support(model: StarModel, ctx: FilterContext) -> DataFrame:
    """Columns: attendance by support type, largest first."""
    return evaluate_by(model, ctx, "support_activity", ["support_name"], ["total_attendance"], CATALOG).orderBy(
        F.desc("total_attendance"), "support_name"
    )


def slicer_values(model: StarModel, table: str, column: str) -> DataFrame:
    """Members a list slicer offers: distinct non-blank values, sorted."""
    return model.tables[table].select(column).filter(C.values_not_blank(column)).distinct().orderBy(column)


def slicer_hierarchy(model: StarModel, table: str, levels: Sequence[str]) -> DataFrame:
    """Members of a hierarchy slicer (e.g. year -> quarter)."""
    cols = list(levels)
    return model.tables[table].select(*cols).filter(F.col(cols[0]).isNotNull()).distinct().orderBy(*cols)


# --- pages (every card of a page under one context, one row) --------------------------------------

PAGE_MEASURES = {
    "registration": ["total_msmes", "msme_target"],
    "activity": ["total_attendance", "training_days", "total_loan", "loan_approved"],
    "performance": [
        "total_sales",
        "current_month_sales",
        "last_month_sales",
        "sales_target",
        "total_jobs",
        "current_month_jobs",
        "last_month_jobs",
        "jobs_target",
    ],
}


def page(model: StarModel, ctx: FilterContext, name: str) -> DataFrame:
    return evaluate(model, ctx, PAGE_MEASURES[name], CATALOG)


PAGE_VISUALS = {
    "registration": [
        Visual("cards", ("total_msmes", "msme_target")),
        Visual("trend", ("total_msmes",), "date_success", ("registration_date_id",)),
        Visual("share", ("total_msmes",), "success_profile", ("industry",)),
    ],
    "activity": [
        Visual("cards", ("total_attendance", "training_days", "total_loan", "loan_approved")),
        Visual("loan", ("total_loan",), "success_profile", ("industry",), INTERACTION_EXCEPTIONS["loan_by_category"]),
        Visual("attendance", ("total_attendance",), "support_activity", ("support_name",)),
    ],
}


def page_visuals(model: StarModel, ctx: FilterContext, name: str) -> DataFrame:
    """A page's cards and charts in one pass over each fact: a row per card set and chart member."""
    return evaluate_visuals(model, ctx, PAGE_VISUALS[name], CATALOG)


def page_text(model: StarModel, ctx: FilterContext, name: str) -> DataFrame:
    """The page's cards as displayed: each value in its measure's format (blank stays null)."""
    from kpi_lake.functions.formatting import format_kpi
    from kpi_lake.plans.semantic import MEASURE_FORMATS

    row = page(model, ctx, name)
    return row.select(*[format_kpi(c, MEASURE_FORMATS.get(c, "integer")).alias(c) for c in row.columns])


__all__ = [
    "INTERACTION_EXCEPTIONS",
    "PAGE_MEASURES",
    "activity_context",
    "attendance_by_support",
    "card",
    "cross_filter",
    "for_visual",
    "gauge",
    "loan_by_category",
    "page",
    "page_text",
    "page_visuals",
    "performance_context",
    "registration_context",
    "share_by_category",
    "slicer_hierarchy",
    "slicer_values",
    "trend_entities",
]
