"""The programme's KPI model over the gold star schema: tables, relationships, measures."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_lake.functions.clean import numeric_text
from kpi_lake.operators.measures import Catalog, Derived, Measure
from kpi_lake.operators.model import Relationship, StarModel
from kpi_lake.operators.timeintel import month_to_date, shift_months

# The model's relationships (many side -> one side). Several people belong to one
# job, and registrations aren't de-duplicated, so those keys are not declared unique.
RELATIONSHIPS = [
    Relationship("success_fact", "registration_date_id", "date_success", "registration_date_id"),
    Relationship("success_fact", "msme_key", "success_profile", "msme_key", both_directions=True, one_unique=False),
    Relationship("job_fact", "job_key", "hiring", "job_key", one_unique=False),
    Relationship("job_fact", "date_job_id", "date_job", "date_job_id"),
    Relationship("job_fact", "job_key", "firing", "job_key", one_unique=False),
    Relationship("job_fact", "msme_key", "success_profile", "msme_key", one_unique=False),
    Relationship("sales_fact", "date_sales_id", "date_sales", "date_sales_id"),
    Relationship("sales_fact", "msme_key", "success_profile", "msme_key", one_unique=False),
    Relationship("activity_fact", "activity_date_id", "date_activity", "activity_date_id"),
    Relationship("activity_fact", "support_id", "support_activity", "support_id"),
    Relationship("participant_updated", "activity_id", "activity_fact", "activity_id"),
    Relationship("participant_updated", "msme_key", "success_profile", "msme_key", one_unique=False),
]

CALENDAR_TABLES = ("date_success", "date_job", "date_sales", "date_activity")

MODEL_TABLES = (
    "success_fact",
    "success_profile",
    "date_success",
    "activity_fact",
    "date_activity",
    "support_activity",
    "sales_fact",
    "date_sales",
    "job_fact",
    "date_job",
    "hiring",
    "firing",
    "participant_updated",
)

# Columns the model declares not nullable, per gold table.
NOT_NULL_COLUMNS = {
    "success_fact": ["msme_key"],
    "success_profile": ["msme_key"],
    "activity_fact": ["activity_id"],
    "support_activity": ["support_id"],
    "date_success": ["registration_date_id"],
    "date_activity": ["activity_date_id"],
    "date_sales": ["date_sales_id"],
    "date_job": ["date_job_id"],
    "hiring": ["job_key"],
    "firing": ["job_key"],
}

# Default summarisation of numeric columns (``sum``); other columns group (``none``).
SUMMARIZE_BY = {
    "activity_fact": {"partner_id": "sum", "area_id": "sum", "activity_duration": "sum", "attendance_number": "sum"},
    "job_fact": {"total_hired_employee": "sum", "total_fired_employee": "sum"},
    "sales_fact": {"domestic_sale": "sum"},
    "success_fact": {"annual_income": "sum", "employee_number": "sum", "loan_amount": "sum"},
    "success_profile": {"business_owner_age": "sum"},
}

# Display format of each measure (model format strings: "0" -> integer,
# "$#,0" -> currency0, "$#,0.###..." -> currency).
MEASURE_FORMATS = {
    "total_msmes": "integer",
    "total_jobs": "integer",
    "total_sales": "currency",
    "total_loan": "currency0",
    "msme_target": "integer",
    "total_attendance": "integer",
    "training_days": "integer",
    "loan_approved": "integer",
    "current_month_sales": "currency",
    "last_month_sales": "currency",
    "sales_target": "currency",
    "jobs_target": "integer",
    "current_month_jobs": "integer",
    "last_month_jobs": "integer",
}

# Target multipliers.
ENTITY_TARGET_FACTOR = Decimal("1.1")
SALES_TARGET_FACTOR = Decimal("1.05")
JOBS_TARGET_FACTOR = Decimal("1.1")
TARGET_TYPE = "decimal(38,2)"
HOURS_PER_TRAINING_DAY = 8


def build_model(gold: Mapping[str, DataFrame]) -> StarModel:
    missing = [t for t in MODEL_TABLES if t not in gold]
    if missing:
        raise KeyError(f"gold tables missing: {missing}")
    return StarModel(gold, RELATIONSHIPS, calendar_tables=CALENDAR_TABLES)


def _times(factor: Decimal, exact: str = "decimal(30,6)"):
    """Exact decimal product: a target never depends on floating-point rounding. ``exact`` holds
    the input, fractions included."""
    return lambda v: v.cast(exact) * F.lit(factor)


# Measures whose bodies the model keeps in an external model are defined here from their
# names and result types; each is an ordinary Measure and can be swapped.
TOTAL_MSMES = Measure("total_msmes", "success_profile", "count_distinct", column="msme_key", result_type="bigint")
TOTAL_JOBS = Measure("total_jobs", "job_fact", "sum", column="total_hired_employee", result_type="bigint")
TOTAL_SALES = Measure("total_sales", "sales_fact", "sum", column="domestic_sale", result_type="bigint")
TOTAL_LOAN = Measure("total_loan", "success_fact", "sum", column="loan_amount", cast="decimal(38,6)", result_type="double")
TOTAL_ATTENDANCE = Measure("total_attendance", "activity_fact", "sum", column="attendance_number", result_type="bigint")
TRAINING_HOURS = Measure("training_hours", "activity_fact", "sum", column="activity_duration", result_type="bigint")
LOAN_APPROVED = Measure(
    "loan_approved",
    "success_profile",
    "count_where",
    condition=lambda: F.lower(F.col("financial_institution")) == F.lit("yes"),
    result_type="bigint",
    # The filter argument replaces any filter on that column.
    context=lambda ctx: ctx.removing_columns("success_profile", ["financial_institution"]),
)
CURRENT_MONTH_SALES = month_to_date(TOTAL_SALES, "date_sales", "date_sales_id", "current_month_sales")
LAST_MONTH_SALES = shift_months(TOTAL_SALES, "date_sales", "date_sales_id", "last_month_sales", -1)
CURRENT_MONTH_JOBS = month_to_date(TOTAL_JOBS, "date_job", "date_job_id", "current_month_jobs")
LAST_MONTH_JOBS = shift_months(TOTAL_JOBS, "date_job", "date_job_id", "last_month_jobs", -1)

# Parameters of the inferred bodies: the international sales column is text (it summarises as
# nothing in the model), so it enters through the exact decimal of numeric text; jobs may be counted
# net of dismissals.
SALES_TEXT_TYPE = "decimal(38,10)"
TOTAL_INTERNATIONAL_SALES = Measure(
    "total_international_sales",
    "sales_fact",
    "sum",
    value=lambda: numeric_text("international_sale", SALES_TEXT_TYPE),
    result_type=SALES_TEXT_TYPE,
)
TOTAL_FIRED = Measure("total_fired", "job_fact", "sum", column="total_fired_employee", result_type="bigint")
SALES_ALL_CHANNELS = Derived(
    "total_sales_all_channels",
    ("total_sales", "total_international_sales"),
    lambda d, i: F.when(d.isNull() & i.isNull(), F.lit(None)).otherwise(F.coalesce(d, F.lit(0)) + F.coalesce(i, F.lit(0))),
    SALES_TEXT_TYPE,
)
NET_JOBS = Derived(
    "net_jobs",
    ("total_jobs", "total_fired"),
    lambda h, f: F.when(h.isNull() & f.isNull(), F.lit(None)).otherwise(F.coalesce(h, F.lit(0)) - F.coalesce(f, F.lit(0))),
    "bigint",
)

MSME_TARGET = Derived("msme_target", ("total_msmes",), _times(ENTITY_TARGET_FACTOR), TARGET_TYPE)
SALES_TARGET = Derived("sales_target", ("total_sales",), _times(SALES_TARGET_FACTOR), TARGET_TYPE)
JOBS_TARGET = Derived("jobs_target", ("total_jobs",), _times(JOBS_TARGET_FACTOR), TARGET_TYPE)
TRAINING_DAYS = Derived(
    "training_days", ("training_hours",), lambda h: h.cast("double") / F.lit(float(HOURS_PER_TRAINING_DAY)), "double"
)

CATALOG = Catalog().add(
    TOTAL_INTERNATIONAL_SALES,
    TOTAL_FIRED,
    SALES_ALL_CHANNELS,
    NET_JOBS,
    TOTAL_MSMES,
    TOTAL_JOBS,
    TOTAL_SALES,
    TOTAL_LOAN,
    TOTAL_ATTENDANCE,
    TRAINING_HOURS,
    LOAN_APPROVED,
    CURRENT_MONTH_SALES,
    LAST_MONTH_SALES,
    CURRENT_MONTH_JOBS,
    LAST_MONTH_JOBS,
    MSME_TARGET,
    SALES_TARGET,
    JOBS_TARGET,
    TRAINING_DAYS,
)

__all__ = [
    "CALENDAR_TABLES",
    "CATALOG",
    "MODEL_TABLES",
    "NOT_NULL_COLUMNS",
    "RELATIONSHIPS",
    "SUMMARIZE_BY",
    "build_model",
]
