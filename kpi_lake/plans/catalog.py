"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator or report query.

Every query starts from the shared parquet tables of ``sf_dir``: the stand-in bronze tables are
derived from them, cleaned to silver, shaped to gold and queried through the model, all as one
lazy plan per query (Catalyst prunes columns and pushes filters down to the parquet scans).
The ``sink_*`` and ``copy_table`` queries write tables into the lake folder (inside the shared
checkpoint folder) and return what they read back.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.functions import clean
from kpi_lake.functions.calendar import add_calendar, parse_date
from kpi_lake.functions.formatting import format_kpi
from kpi_lake.operators import context as C
from kpi_lake.operators import star
from kpi_lake.operators.keymap import KeyMap
from kpi_lake.operators.lookup import table_lookup
from kpi_lake.operators.measures import evaluate, evaluate_by, highlight_by, implicit_aggregates, one_row
from kpi_lake.operators.quality import QualityCounters
from kpi_lake.operators.rollup import distinct_count, distinct_rollup
from kpi_lake.plans import dashboard as D
from kpi_lake.plans import pipelines as P
from kpi_lake.plans.semantic import CATALOG, NOT_NULL_COLUMNS, SUMMARIZE_BY, build_model
from kpi_lake.session import lake_root, session_key
from kpi_lake.sources.layers import Lake, read_table, source_lake, write_many, write_table
from kpi_lake.sources.standins import bronze_from_sources, folder_state, forget_stopped

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# --- the report's saved slicers, on the stand-in tables

# The stand-in registration, sales and job dates (from the shared order tables) lie 26 years
# before the programme's; activity dates (from the event table) are in the programme's years.
STANDIN_YEAR_SHIFT = -26


def shift_years(day: str, years: int) -> str:
    d = dt.date.fromisoformat(day)
    try:
        return d.replace(year=d.year + years).isoformat()
    except ValueError:  # 29 February into a common year
        return d.replace(year=d.year + years, day=28).isoformat()


def standin_years() -> list[int]:
    return [y + STANDIN_YEAR_SHIFT for y in D.REPORT_REGISTRATION_YEARS]


def standin_sales_range() -> tuple[str, str]:
    start, end = D.REPORT_SALES_RANGE
    return shift_years(start, STANDIN_YEAR_SHIFT), shift_years(end, STANDIN_YEAR_SHIFT)


def standin_jobs_until() -> str:
    return shift_years(D.REPORT_JOBS_UNTIL, STANDIN_YEAR_SHIFT)


def saved_performance_context(**slicers) -> C.FilterContext:
    """The performance page with the report's saved selections, moved to the stand-ins' years."""
    return D.performance_context(**{"sales_range": standin_sales_range(), "jobs_until": standin_jobs_until(), **slicers})


# --- layers as lazy frames -------------------------------------------------------------------------


# Layer frames are immutable lazy plans: queries of one session over one folder share them, so
# each table is analysed once, not once per query, until the folder changes.
_LAYERS: dict[tuple, tuple] = {}


def _memo(spark: SparkSession, sf_dir: str, layer: str, build):
    session, state = session_key(spark), folder_state(spark, sf_dir)
    key = (session, sf_dir, layer)
    if key not in _LAYERS or _LAYERS[key][0] != state:
        forget_stopped(_LAYERS, session)
        _LAYERS[key] = (state, build())
    return _LAYERS[key][1]


def bronze(spark: SparkSession, sf_dir: str):
    return _memo(spark, sf_dir, "bronze", lambda: bronze_from_sources(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str):
    return _memo(spark, sf_dir, "silver", lambda: P.silver_from_bronze(bronze(spark, sf_dir)))


def gold(spark: SparkSession, sf_dir: str):
    return _memo(spark, sf_dir, "gold", lambda: P.gold_from_silver(silver(spark, sf_dir)))


def model(spark: SparkSession, sf_dir: str):
    return _memo(spark, sf_dir, "model", lambda: build_model(gold(spark, sf_dir)))


def gold_model(spark: SparkSession, lake: Lake):
    """The model over gold tables already written to a lake (the serving path of a dashboard)."""
    from kpi_lake.plans.semantic import MODEL_TABLES
    from kpi_lake.sources.lazy import LazyFrames

    return build_model(LazyFrames({t: (lambda t=t: read_table(spark, lake, "gold", t)) for t in MODEL_TABLES}))


@lru_cache(maxsize=None)
def _tag(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:10]


def scratch_lake(spark: SparkSession, sf_dir: str, name: str) -> Lake:
    """A lake folder per (source folder, query) inside the shared lake root."""
    return Lake(root=f"{lake_root(spark)}/{_tag(sf_dir)}/{name}", fmt="parquet")


# --- 2.A scans and sinks ---------------------------------------------------------------------------


@query("scan_layer_table")
def scan_layer_table(spark, sf_dir):
    """Layer scan with a projection: only five columns are read from the file."""
    return read_table(spark, source_lake(sf_dir), "", "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )


@query("sink_roundtrip")
def sink_roundtrip(spark, sf_dir):
    lake = scratch_lake(spark, sf_dir, "sink_roundtrip")
    write_table(silver(spark, sf_dir)["sales_updated"], lake, "silver", "sales_updated")
    return read_table(spark, lake, "silver", "sales_updated")


@query("sink_replace_schema")
def sink_replace_schema(spark, sf_dir):
    """An older success_fact (income as text, an extra column) is replaced with the new schema."""
    lake = scratch_lake(spark, sf_dir, "sink_replace_schema")
    fact = gold(spark, sf_dir)["success_fact"]
    old = fact.withColumn("annual_income", F.col("annual_income").cast("string")).withColumn("legacy", F.lit(1))
    write_table(old, lake, "gold", "success_fact", schema_mode="replace")
    write_table(fact, lake, "gold", "success_fact", schema_mode="replace")
    return read_table(spark, lake, "gold", "success_fact")


@query("sink_merge_schema")
def sink_merge_schema(spark, sf_dir):
    """activity_fact written over an older version that had ``area_id``: the column survives."""
    lake = scratch_lake(spark, sf_dir, "sink_merge_schema")
    fact = gold(spark, sf_dir)["activity_fact"]
    old = fact.withColumn("area_id", F.col("partner_id"))
    write_table(old, lake, "gold", "activity_fact", schema_mode="replace")
    write_table(fact, lake, "gold", "activity_fact", schema_mode="merge")
    return read_table(spark, lake, "gold", "activity_fact")


@query("sink_two_layers")
def sink_two_layers(spark, sf_dir):
    lake = scratch_lake(spark, sf_dir, "sink_two_layers")
    support = gold(spark, sf_dir)["support_activity"]
    write_many(support, [(lake, "silver", "support_activity"), (lake, "gold", "support_activity")])
    return read_table(spark, lake, "silver", "support_activity").withColumn("layer", F.lit("silver")).unionByName(
        read_table(spark, lake, "gold", "support_activity").withColumn("layer", F.lit("gold"))
    )


@query("sink_versioned")
def sink_versioned(spark, sf_dir):
    """A versioned table after two full refreshes: readers see the second."""
    lake = Lake(root=scratch_lake(spark, sf_dir, f"versioned-{uuid.uuid4().hex[:8]}").root, versioned=True)
    orders = read_table(spark, source_lake(sf_dir), "", "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_table(orders.where("o_orderkey % 2 = 0"), lake, "gold", "orders")
    write_table(orders, lake, "gold", "orders")
    return read_table(spark, lake, "gold", "orders")


@query("sink_merge_nested")
def sink_merge_nested(spark, sf_dir):
    """A refresh whose struct, and structs in an array, lost a field and gained one: the lost ones
    survive as null."""
    lake = scratch_lake(spark, sf_dir, f"nested-{uuid.uuid4().hex[:8]}")
    orders = read_table(spark, source_lake(sf_dir), "", "orders")
    old = F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"))
    new = F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"))
    for info in (old, new):
        df = orders.select("o_orderkey", info.alias("info"), F.array(info, F.lit(None)).alias("history"))
        write_table(df, lake, "gold", "orders", schema_mode="merge")
    found = read_table(spark, lake, "gold", "orders")
    first = F.col("history")[0]
    return found.select(
        "o_orderkey", "info.customer", "info.status", "info.priority", first["status"].alias("first_status"), first["priority"].alias("first_priority"), F.size("history").alias("n")
    )


@query("copy_table")
def copy_table_query(spark, sf_dir):
    from kpi_lake.sources.layers import copy_table

    lake = scratch_lake(spark, sf_dir, "copy_table")
    write_table(silver(spark, sf_dir)["participant_updated"], lake, "silver", "participant_updated")
    copy_table(spark, lake, "silver", "participant_updated", lake, "gold")
    return read_table(spark, lake, "gold", "participant_updated")


# --- 2.B / 2.C rules on real columns ----------------------------------------------------------------


@query("filter_not_null")
def filter_not_null(spark, sf_dir):
    act = bronze(spark, sf_dir)["success_activity_monitoring"]
    return clean.require_not_null(act, "attendance_number").select("activity_key", "attendance_number")


@query("clamp_range")
def clamp_range(spark, sf_dir):
    sp = bronze(spark, sf_dir)["success_spark"]
    return sp.select(
        "msme_key",
        F.col("age").alias("age_raw"),
        clean.clamp_open_range("age", 1, P.OWNER_AGE_MIN, P.OWNER_AGE_MIN, null_to=P.OWNER_AGE_MIN).alias("business_owner_age"),
    )


@query("normalize_in_set")
def normalize_in_set(spark, sf_dir):
    sp = silver(spark, sf_dir)["success_updated"]
    return sp.select(
        "msme_key",
        F.col("departement").alias("departement_raw"),
        clean.normalize("departement", P.DEPARTEMENT_RULES).alias("departement"),
    )


@query("normalize_case")
def normalize_case(spark, sf_dir):
    sp = silver(spark, sf_dir)["success_updated"]
    return sp.select(
        "msme_key",
        clean.normalize("msme_productive", P.PRODUCTIVE_RULES).alias("msme_productive"),
        clean.normalize("industry", P.AGRIBUSINESS_RULES).alias("industry"),
        clean.normalize("business_owner_sex", P.SEX_RULES).alias("business_owner_sex"),
    )


@query("decimal_gate")
def decimal_gate(spark, sf_dir):
    sp = silver(spark, sf_dir)["success_updated"]
    return sp.select(
        "msme_key",
        F.col("annual_income").alias("annual_income_text"),
        clean.decimal_gate(sp, "annual_income", 10, 2).alias("annual_income"),
    )


@query("recode_values")
def recode_values(spark, sf_dir):
    sp = bronze(spark, sf_dir)["success_spark"].select("msme_key", F.col("partenaire").alias("partner_raw"), "partenaire")
    return clean.recode(sp, P.PARTNER_RECODE, "partenaire").withColumnRenamed("partenaire", "business_partner")


@query("recode_many")
def recode_many(spark, sf_dir):
    h = bronze(spark, sf_dir)["success_hired_employee"].select("employee_key", *P.HIRING_YES_NO_COLUMNS)
    return clean.recode(h, P.YES_NO_RECODE_ANY_CASE, P.HIRING_YES_NO_COLUMNS)


@query("fill_null_numeric")
def fill_null_numeric(spark, sf_dir):
    s = bronze(spark, sf_dir)["success_sales"].select("sales_key", "domestic_sale", "international_sale")
    return clean.fill_null(s, {"domestic_sale": 0, "international_sale": 0})


@query("fill_null_category")
def fill_null_category(spark, sf_dir):
    sp = silver(spark, sf_dir)["success_updated"].select("msme_key", "msme_category")
    return sp.withColumn("msme_category", F.coalesce(F.col("msme_category"), F.lit(P.DEFAULT_CATEGORY)))


@query("floor_below_threshold")
def floor_below_threshold(spark, sf_dir):
    sp = bronze(spark, sf_dir)["success_spark"].select("msme_key", F.col("revenu_annuel").alias("income_raw"), "revenu_annuel")
    return clean.floor_below(sp, "revenu_annuel", P.INCOME_FLOOR, 0).withColumnRenamed("revenu_annuel", "annual_income")


@query("repair_values")
def repair_values(spark, sf_dir):
    f = bronze(spark, sf_dir)["success_fired_employee"]
    return f.select("lic_key", F.col("age").alias("age_raw"), clean.repair("age", P.FIRED_AGE_REPAIRS).alias("age"))


@query("truncate_to_int")
def truncate_to_int(spark, sf_dir):
    h = bronze(spark, sf_dir)["success_hired_employee"]
    return h.select("employee_key", F.col("duree_contrat"), clean.to_int_trunc("duree_contrat").alias("contract_duration"))


@query("parse_date")
def parse_date_query(spark, sf_dir):
    s = bronze(spark, sf_dir)["success_sales"]
    return s.select("sales_key", "sales_reporting_date", parse_date("sales_reporting_date").alias("sales_date"))


@query("calendar_parts")
def calendar_parts(spark, sf_dir):
    s = bronze(spark, sf_dir)["success_sales"].select("sales_key", parse_date("sales_reporting_date").alias("sales_date"))
    return add_calendar(s, "sales_date", suffix="_sales_reporting")


@query("rename_columns")
def rename_columns(spark, sf_dir):
    return clean.rename(
        bronze(spark, sf_dir)["success_job"],
        {"nbre_employe_embauche": "total_hired_employee", "nombre_employe_licencie": "total_fired_employee", "date_collecte": "collecting_date"},
    )


@query("project_columns")
def project_columns(spark, sf_dir):
    return clean.project(
        silver(spark, sf_dir)["sales_updated"], ["sales_key", "msme_key", "sales_reporting_date"], {"sales_reporting_date": "date_sales_id"}
    )


@query("anonymize")
def anonymize(spark, sf_dir):
    return gold(spark, sf_dir)["hiring"]


@query("drop_column")
def drop_column(spark, sf_dir):
    return P.activity_with_partner(silver(spark, sf_dir)["activity_updated"])


@query("map_lookup")
def map_lookup(spark, sf_dir):
    a = silver(spark, sf_dir)["activity_updated"]
    return a.select("activity_id", "partner_key", clean.map_lookup("partner_key", P.PARTNER_IDS).alias("partner_id"))


@query("code_to_label")
def code_to_label(spark, sf_dir):
    a = silver(spark, sf_dir)["activity_updated"]
    return a.select("activity_id", "support_type", clean.label("support_type", P.SUPPORT_LABELS, P.SUPPORT_DEFAULT_LABEL).alias("support_name"))


# --- 2.D dimensions, facts, keys --------------------------------------------------------------------


@query("date_dimension")
def date_dimension(spark, sf_dir):
    return gold(spark, sf_dir)["date_sales"]


@query("attribute_dimension")
def attribute_dimension(spark, sf_dir):
    return gold(spark, sf_dir)["support_activity"]


@query("profile_dimension")
def profile_dimension(spark, sf_dir):
    return gold(spark, sf_dir)["success_profile"]


@query("fact_table")
def fact_table(spark, sf_dir):
    return gold(spark, sf_dir)["success_fact"]


@query("surrogate_key")
def surrogate_key(spark, sf_dir):
    """Dense key over sales in (date, sales key) order; null dates first."""
    sales = gold(spark, sf_dir)["sales_fact"].select("sales_key", "date_sales_id")
    return star.sequence_key(sales, [F.col("date_sales_id").asc_nulls_first(), F.col("sales_key")], "sales_sk")


@query("surrogate_hash_key")
def surrogate_hash_key(spark, sf_dir):
    """Hash key over a natural key with nulls: partner and support of each activity."""
    a = gold(spark, sf_dir)["activity_fact"].select("activity_id", "partner_id", "support_id")
    return star.surrogate_key(a, ["partner_id", "support_id", "activity_id"], "activity_sk")


@query("orphan_keys")
def orphan_keys(spark, sf_dir):
    """Participants whose activity is not in the activity fact (it was dropped for missing attendance)."""
    g = gold(spark, sf_dir)
    return star.orphan_keys(g["participant_updated"], "activity_id", g["activity_fact"], "activity_id")


@query("duplicate_keys")
def duplicate_keys(spark, sf_dir):
    """The model puts hiring on the one side of job_fact, keyed by job_key: every job with more
    than one hire breaks that key (a fan-out trap for anyone joining the two)."""
    return star.duplicate_keys(gold(spark, sf_dir)["hiring"], ["job_key"])


# --- 2.E table pipelines ------------------------------------------------------------------------------

for _name, _silver_table in [
    ("silver_profile", "success_updated"),
    ("silver_jobs", "job_updated"),
    ("silver_sales", "sales_updated"),
    ("silver_participants", "participant_updated"),
    ("silver_hiring", "hiring_updated"),
    ("silver_firing", "firing_updated"),
    ("silver_activity", "activity_updated"),
]:
    QUERIES[_name] = (lambda t: lambda spark, sf_dir: silver(spark, sf_dir)[t])(_silver_table)

for _name, _gold_table in [
    ("gold_success", "date_success"),
    ("gold_activity", "activity_fact"),
    ("gold_date_activity", "date_activity"),
    ("gold_sales", "sales_fact"),
    ("gold_jobs", "job_fact"),
    ("gold_date_job", "date_job"),
    ("gold_people", "firing"),
    ("gold_participants", "participant_updated"),
]:
    QUERIES[_name] = (lambda t: lambda spark, sf_dir: gold(spark, sf_dir)[t])(_gold_table)


# --- 2.F joins through the model ----------------------------------------------------------------------


@query("filter_propagation")
def filter_propagation(spark, sf_dir):
    """A category filter on the profile reaches the sales fact (one hop)."""
    ctx = C.EMPTY.where("success_profile", C.in_list("msme_category", ["Micro"]), "msme_category")
    return evaluate(model(spark, sf_dir), ctx, ["total_sales"], CATALOG)


@query("filter_transitive")
def filter_transitive(spark, sf_dir):
    """Registration year -> registrations -> profile (both ways) -> sales and jobs."""
    ctx = C.EMPTY.where("date_success", C.in_list("year_success", [1996]), "year_success")
    return evaluate(model(spark, sf_dir), ctx, ["total_sales", "total_jobs"], CATALOG)


@query("filter_bidirectional")
def filter_bidirectional(spark, sf_dir):
    """A filter on the registration fact reaches the profile over the two-way 1:1 relationship."""
    ctx = C.EMPTY.where("success_fact", F.col("annual_income") >= F.lit(50000), "annual_income")
    return evaluate(model(spark, sf_dir), ctx, ["total_msmes"], CATALOG)


@query("filter_blocked")
def filter_blocked(spark, sf_dir):
    """A category filter does not reach attendance: the bridge's relationships are one-way."""
    ctx = C.EMPTY.where("success_profile", C.in_list("msme_category", ["Micro"]), "msme_category")
    return evaluate(model(spark, sf_dir), ctx, ["total_attendance"], CATALOG)


@query("filter_from_people")
def filter_from_people(spark, sf_dir):
    """Hires and dismissals filter the jobs they belong to (one side -> many side): a job with
    several matching hires is counted once."""
    m = model(spark, sf_dir)
    full_time = C.EMPTY.where("hiring", C.equals("is_full_time", "yes"), "is_full_time")
    young = C.EMPTY.where("firing", F.col("age") < F.lit(25), "age")
    a = evaluate(m, full_time, ["total_jobs"], CATALOG).withColumnRenamed("total_jobs", "jobs_with_full_time_hires")
    b = evaluate(m, young, ["total_jobs"], CATALOG).withColumnRenamed("total_jobs", "jobs_with_young_dismissals")
    return one_row(a, b)


@query("participants_by_category")
def participants_by_category(spark, sf_dir):
    """Businesses that attended activities, per business category (profile -> bridge)."""
    from kpi_lake.operators.measures import Measure

    businesses = Measure("businesses", "participant_updated", "count_distinct", column="msme_key", result_type="bigint")
    return evaluate_by(model(spark, sf_dir), C.EMPTY, "success_profile", ["msme_category"], [businesses])


@query("group_by_dimension")
def group_by_dimension(spark, sf_dir):
    return D.attendance_by_support(model(spark, sf_dir), D.activity_context(activity_period=[(2024, 1)]))


@query("bridge_count")
def bridge_count(spark, sf_dir):
    """Businesses reached per support type, through the participant bridge."""
    from kpi_lake.operators.measures import Measure

    businesses = Measure("businesses", "participant_updated", "count_distinct", column="msme_key", result_type="bigint")
    return evaluate_by(model(spark, sf_dir), C.EMPTY, "support_activity", ["support_name"], [businesses])


# --- 2.G measures ---------------------------------------------------------------------------------------

_MEASURE_QUERIES = {
    "total_entities": (["total_msmes"], D.registration_context),
    "target_entities": (["msme_target"], D.registration_context),
    "total_jobs": (["total_jobs"], saved_performance_context),
    "total_sales": (["total_sales"], saved_performance_context),
    "total_loan": (["total_loan"], D.activity_context),
    "total_attendance": (["total_attendance"], D.activity_context),
    "training_days": (["training_days"], D.activity_context),
    "count_where": (["loan_approved"], D.activity_context),
    "mtd_sales": (["current_month_sales"], saved_performance_context),
    "prev_month_sales": (["last_month_sales"], saved_performance_context),
    "target_sales": (["sales_target"], saved_performance_context),
    "target_jobs": (["jobs_target"], saved_performance_context),
    "mtd_jobs": (["current_month_jobs"], saved_performance_context),
    "prev_month_jobs": (["last_month_jobs"], saved_performance_context),
    "gauge_entities": (["total_msmes", "msme_target"], D.registration_context),
    "gauge_sales": (["total_sales", "sales_target"], saved_performance_context),
    "gauge_jobs": (["total_jobs", "jobs_target"], saved_performance_context),
}

for _name, (_measures, _ctx) in _MEASURE_QUERIES.items():
    QUERIES[_name] = (lambda ms, cf: lambda spark, sf_dir: evaluate(model(spark, sf_dir), cf(), ms, CATALOG))(_measures, _ctx)


@query("sales_channels")
def sales_channels(spark, sf_dir):
    """Domestic, international (numeric text, fractions kept) and both, on the performance page."""
    return evaluate(
        model(spark, sf_dir), saved_performance_context(), ["total_sales", "total_international_sales", "total_sales_all_channels"], CATALOG
    )


@query("jobs_net")
def jobs_net(spark, sf_dir):
    """Jobs created, dismissals and the net, on the performance page."""
    return evaluate(model(spark, sf_dir), saved_performance_context(), ["total_jobs", "total_fired", "net_jobs"], CATALOG)


@query("default_aggregates")
def default_aggregates(spark, sf_dir):
    act = gold(spark, sf_dir)["activity_fact"]
    return implicit_aggregates(act, SUMMARIZE_BY["activity_fact"], ["support_id", "activity_duration", "attendance_number"])


@query("calculate_override")
def calculate_override(spark, sf_dir):
    """A filter financial_institution = 'no' is replaced inside the loan-approved count only."""
    ctx = C.EMPTY.where("success_profile", C.equals("financial_institution", "no"), "financial_institution").where(
        "success_profile", C.in_list("msme_category", ["Micro", "Small"]), "msme_category"
    )
    return evaluate(model(spark, sf_dir), ctx, ["loan_approved", "total_msmes"], CATALOG)


@query("format_kpi")
def format_kpi_query(spark, sf_dir):
    """Sales per year in thousands of dollars, negative amounts in parentheses."""
    per_year = evaluate_by(model(spark, sf_dir), C.EMPTY, "date_sales", ["year_sales_reporting"], ["total_sales"], CATALOG)
    return per_year.select(
        "year_sales_reporting",
        "total_sales",
        format_kpi("total_sales", "currency0", 1000).alias("total_sales_text"),
        format_kpi("total_sales", "integer").alias("total_sales_int"),
    )


# --- 2.H report queries --------------------------------------------------------------------------------


@query("trend_entities")
def trend_entities(spark, sf_dir):
    return D.trend_entities(model(spark, sf_dir), D.registration_context())


@query("share_by_category")
def share_by_category(spark, sf_dir):
    return D.share_by_category(model(spark, sf_dir), D.registration_context())


@query("loan_by_category")
def loan_by_category(spark, sf_dir):
    return D.loan_by_category(model(spark, sf_dir), D.activity_context())


@query("page_registration")
def page_registration(spark, sf_dir):
    return D.page(model(spark, sf_dir), D.registration_context(), "registration")


@query("page_activity")
def page_activity(spark, sf_dir):
    return D.page(model(spark, sf_dir), D.activity_context(), "activity")


@query("page_performance_micro")
def page_performance_micro(spark, sf_dir):
    """The performance page with the category slicer on Micro: the month sets replace only the
    calendar filters, the category still filters every card."""
    return D.page(model(spark, sf_dir), saved_performance_context(categories=["Micro"]), "performance")


@query("page_performance_text")
def page_performance_text(spark, sf_dir):
    """The performance page's cards as text in their display formats."""
    return D.page_text(model(spark, sf_dir), saved_performance_context(), "performance")


@query("page_activity_text")
def page_activity_text(spark, sf_dir):
    return D.page_text(model(spark, sf_dir), D.activity_context(), "activity")


@query("page_registration_cross_filter")
def page_registration_cross_filter(spark, sf_dir):
    """The registration page after picking the Agribusiness slice of the industry donut."""
    ctx = D.cross_filter(D.registration_context(), "success_profile", "industry", "Agribusiness")
    return D.page(model(spark, sf_dir), ctx, "registration")


@query("page_activity_q1")
def page_activity_q1(spark, sf_dir):
    """The activity page with the first quarter of 2024 picked in the activity-period slicer."""
    return D.page(model(spark, sf_dir), D.activity_context(activity_period=[(2024, 1)]), "activity")


@query("page_registration_by_year")
def page_registration_by_year(spark, sf_dir):
    """The registration page with every year the year slicer offers selected."""
    return D.page(model(spark, sf_dir), D.registration_context(years=standin_years()), "registration")


@query("trend_entities_by_year")
def trend_entities_by_year(spark, sf_dir):
    return D.trend_entities(model(spark, sf_dir), D.registration_context(years=standin_years()))


@query("page_performance")
def page_performance(spark, sf_dir):
    return D.page(model(spark, sf_dir), saved_performance_context(), "performance")


# --- 2.I slicers and filter context --------------------------------------------------------------------


@query("slicer_values")
def slicer_values(spark, sf_dir):
    return D.slicer_values(model(spark, sf_dir), "success_profile", "msme_category")


@query("slicer_values_departement")
def slicer_values_departement(spark, sf_dir):
    return D.slicer_values(model(spark, sf_dir), "success_profile", "departement")


@query("slicer_in_list")
def slicer_in_list(spark, sf_dir):
    m = model(spark, sf_dir)
    years = standin_years()
    return m.tables["date_success"].filter(C.in_list("year_success", years)).select("year_success").distinct().orderBy("year_success")


@query("slicer_hierarchy")
def slicer_hierarchy(spark, sf_dir):
    return D.slicer_hierarchy(model(spark, sf_dir), "date_success", ["year_success", "quarter_success"])


@query("slicer_between")
def slicer_between(spark, sf_dir):
    m = model(spark, sf_dir)
    lo, hi = standin_sales_range()
    days = m.tables["date_sales"].filter(C.between("date_sales_id", lo, hi)).agg(F.count(F.lit(1)).alias("days"))
    return one_row(days, evaluate(m, D.performance_context(standin_sales_range()), ["total_sales"], CATALOG))


@query("slicer_until")
def slicer_until(spark, sf_dir):
    m = model(spark, sf_dir)
    days = m.tables["date_job"].filter(C.until("date_job_id", standin_jobs_until())).agg(F.count(F.lit(1)).alias("days"))
    return one_row(days, evaluate(m, D.performance_context(jobs_until=standin_jobs_until()), ["total_jobs"], CATALOG))


@query("filter_context")
def filter_context(spark, sf_dir):
    """Sales range, job range and a category picked in a chart, all at once."""
    ctx = saved_performance_context(categories=["Micro"])
    return evaluate(model(spark, sf_dir), ctx, ["total_sales", "total_jobs"], CATALOG)


@query("filter_exception")
def filter_exception(spark, sf_dir):
    """Loan by industry ignores the activity period but keeps the registration period."""
    ctx = D.activity_context(activity_period=[(2024, 1)], registration_period=[(1996,), (1997, 2)])
    return D.loan_by_category(model(spark, sf_dir), ctx)



@query("jobs_by_hiring_sex")
def jobs_by_hiring_sex(spark, sf_dir):
    """Jobs by the sex of the hired: each group is the total under a filter on that sex."""
    return evaluate_by(model(spark, sf_dir), C.EMPTY, "hiring", ["sex"], ["total_jobs"], CATALOG)


@query("sales_by_industry_repeated_profile")
def sales_by_industry_repeated_profile(spark, sf_dir):
    """Sales by industry where registrations repeat: every profile row twice, every third one a
    third time under another industry."""
    tables = dict(gold(spark, sf_dir).items())
    profile = tables["success_profile"]
    moved = profile.filter(F.pmod(F.col("msme_key").cast("bigint"), F.lit(3)) == 0).withColumn("industry", F.lit("Moved"))
    tables["success_profile"] = profile.unionByName(profile).unionByName(moved)
    return evaluate_by(build_model(tables), C.EMPTY, "success_profile", ["industry"], ["total_sales"], CATALOG)


@query("attendance_by_category")
def attendance_by_category(spark, sf_dir):
    """Attendance by business category: no filter flows from the profile to the activities, so
    every category shows the total."""
    return evaluate_by(model(spark, sf_dir), C.EMPTY, "success_profile", ["msme_category"], ["total_attendance"], CATALOG)


@query("sales_by_industry")
def sales_by_industry(spark, sf_dir):
    """Flagship: total sales by industry inside the sales date range (largest first)."""
    m = model(spark, sf_dir)
    return evaluate_by(m, saved_performance_context(), "success_profile", ["industry"], ["total_sales"], CATALOG).orderBy(
        F.desc("total_sales"), "industry"
    )


@query("not_null_check")
def not_null_check(spark, sf_dir):
    """Null counts of the declared not-nullable columns (nothing enforces the declaration)."""

    g = gold(spark, sf_dir)
    frames = [
        star.null_keys(g[t], cols).select(*[F.col(f"{c}_nulls").alias(f"{t}__{c}") for c in cols])
        for t, cols in NOT_NULL_COLUMNS.items()
    ]
    return one_row(*frames)


@query("format_dates")
def format_dates(spark, sf_dir):
    """Job dates as the model shows them (m/d/yyyy)."""
    return gold(spark, sf_dir)["date_job"].select("date_job_id", format_kpi("date_job_id", "date").alias("date_job_text"))


@query("silver_sales_incremental")
def silver_sales_incremental(spark, sf_dir):
    """Silver sales built by the incremental stream from the bronze files: same rows as the batch."""
    from kpi_lake.streaming import refresh_silver_incrementally

    lake = scratch_lake(spark, sf_dir, f"stream-{uuid.uuid4().hex[:8]}")
    write_table(bronze(spark, sf_dir)["success_sales"], lake, "bronze", "success_sales")
    refresh_silver_incrementally(spark, lake, "sales_updated")
    return read_table(spark, lake, "silver", "sales_updated")


# --- durable keys, roll-ups, pages with charts, counters of a write ----------------------------------


def _entity_keys(spark, sf_dir, *sources) -> DataFrame:
    """A new map of business keys, refreshed once per source."""
    lake = scratch_lake(spark, sf_dir, f"keys-{uuid.uuid4().hex[:8]}")
    keys, known = KeyMap(lake, "gold", "msme_keys", ("msme_key",), "msme_sk"), None
    for s in sources:
        known = keys.refresh(s)
    return known


@query("durable_key")
def durable_key(spark, sf_dir):
    """Business keys after three refreshes: businesses with sales, participants, all registered ones.
    Keys of earlier refreshes stay, new ones are numbered after them, in order of the natural key."""
    g = gold(spark, sf_dir)
    known = _entity_keys(spark, sf_dir, g["sales_fact"], g["participant_updated"], g["success_profile"])
    return known.select("msme_key", "msme_sk", "load")


@query("distinct_rollup")
def distinct_rollup_query(spark, sf_dir):
    """Businesses in total, by industry, by category and by registration year, all from one stored
    roll-up of key bitmaps by date, industry and category."""
    g = gold(spark, sf_dir)
    groups = ["registration_date_id", "industry", "msme_category"]
    known = _entity_keys(spark, sf_dir, g["success_profile"])
    dates = g["success_fact"].select(F.col("msme_key").alias("__msme"), "registration_date_id")
    rows = g["success_profile"].join(dates, F.col("msme_key") == F.col("__msme"), "left").select("msme_key", *groups)
    keyed = rows.join(known.select(F.col("msme_key").alias("__key"), "msme_sk"), F.col("msme_key") == F.col("__key"), "left")
    lake = scratch_lake(spark, sf_dir, f"rollup-{uuid.uuid4().hex[:8]}")
    write_table(distinct_rollup(keyed, groups, "msme_sk"), lake, "gold", "businesses_by_day")
    rollup = read_table(spark, lake, "gold", "businesses_by_day").withColumn("registration_year", F.year("registration_date_id"))
    answers = [distinct_count(rollup, [], "total_msmes").select(F.lit("total").alias("axis"), F.lit(None).cast("string").alias("member"), "total_msmes")]
    for axis in ("industry", "msme_category", "registration_year"):
        counted = distinct_count(rollup, [axis], "total_msmes")
        answers.append(counted.select(F.lit(axis).alias("axis"), F.col(axis).cast("string").alias("member"), "total_msmes"))
    return reduce(lambda a, b: a.unionByName(b), answers)


@query("page_registration_visuals")
def page_registration_visuals(spark, sf_dir):
    """The registration page, cards and charts, in one pass over each table."""
    return D.page_visuals(model(spark, sf_dir), D.registration_context(), "registration")


@query("page_registration_visuals_by_year")
def page_registration_visuals_by_year(spark, sf_dir):
    """The same with the slicer's years selected; the years reach the fact's scan as date ranges."""
    return D.page_visuals(model(spark, sf_dir), D.registration_context(years=standin_years()), "registration")


@query("page_activity_visuals")
def page_activity_visuals(spark, sf_dir):
    """The activity page, cards and charts, with the first quarter of 2024 picked."""
    return D.page_visuals(model(spark, sf_dir), D.activity_context(activity_period=[(2024, 1)]), "activity")


@query("sales_months_by_industry")
def sales_months_by_industry(spark, sf_dir):
    """Sales, month to date and last month by industry, in one scan of the sales."""
    names = ["total_sales", "current_month_sales", "last_month_sales"]
    return evaluate_by(model(spark, sf_dir), saved_performance_context(), "success_profile", ["industry"], names, CATALOG)


@query("sales_months_by_category_unfiltered")
def sales_months_by_category_unfiltered(spark, sf_dir):
    """The same by category without a selected period: total sales keep rows without a date."""
    names = ["total_sales", "current_month_sales", "last_month_sales"]
    return evaluate_by(model(spark, sf_dir), C.EMPTY, "success_profile", ["msme_category"], names, CATALOG)


@query("highlight_loans")
def highlight_loans(spark, sf_dir):
    """The loan chart by industry and the businesses, with the category Micro picked elsewhere: each
    industry's whole and its chosen part."""
    picked = C.EMPTY.where("success_profile", C.equals("msme_category", "Micro"), "msme_category")
    chosen = [CATALOG["total_loan"], CATALOG["total_msmes"]]
    return highlight_by(model(spark, sf_dir), C.EMPTY, picked, "success_profile", ["industry"], chosen)


@query("table_lookup")
def table_lookup_query(spark, sf_dir):
    """Look-ups in tables: each customer's nation by its key, and of the nation's suppliers the first
    by balance, where several rows have one key."""
    source = source_lake(sf_dir)
    customers, nations, suppliers = (read_table(spark, source, "", t) for t in ("customer", "nation", "supplier"))
    named = table_lookup(customers.select("c_custkey", "c_nationkey"), ["c_nationkey"], nations, ["n_nationkey"], ["n_name"], defaults={"n_name": "unknown"})
    order = [-F.col("s_acctbal"), F.col("s_suppkey")]
    return table_lookup(named, ["c_nationkey"], suppliers, ["s_nationkey"], ["s_suppkey", "s_name"], "first", order)


@query("write_quality")
def write_quality(spark, sf_dir):
    """Counters of the silver writes, taken by the writes themselves: rows read, written and dropped,
    and values that a rule turned to null."""
    lake = scratch_lake(spark, sf_dir, f"quality-{uuid.uuid4().hex[:8]}")
    counters = QualityCounters()
    source = bronze(spark, sf_dir)
    for name, (src, step) in P.SILVER_STEPS.items():
        write_table(counters.step(name, source[src], step), lake, "silver", name)
    rows = []
    for name, found in counters.report().items():
        nulled = sum(v for k, v in found.items() if k.startswith("nulled_"))
        rows.append((name, found["rows_in"], found["rows_out"], found["rows_dropped"], nulled))
    return spark.createDataFrame(rows, "table_name string, rows_in bigint, rows_out bigint, rows_dropped bigint, values_nulled bigint")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


__all__ = ["QUERIES", "bronze", "gold", "model", "queries", "silver"]
