"""Bronze -> silver -> gold, table by table.

Each ``silver_*`` / ``gold_*`` function is a pure DataFrame -> DataFrame(s) transformation; the
``run_*`` functions read a layer, apply them and write the next layer. Silver steps are all
row-local (no shuffle); gold adds ``distinct`` for the dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.functions.calendar import add_calendar, parse_date
from kpi_lake.functions.clean import (
    Rule,
    anonymize,
    clamp_open_range,
    decimal_gate,
    fill_null,
    floor_below,
    map_lookup,
    normalize,
    recode,
    rename,
    repair,
    require_not_null,
    to_int_trunc,
)
from kpi_lake.operators.keymap import KeyMap
from kpi_lake.operators.quality import QualityCounters
from kpi_lake.operators.star import attribute_dimension, date_dimension, fact_table, profile_dimension
from kpi_lake.plans.semantic import NOT_NULL_COLUMNS
from kpi_lake.sources.layers import Lake, copy_table, read_table, write_many, write_table
from kpi_lake.sources.lazy import LazyFrames

# ---------------------------------------------------------------------------------------------
# Recoding maps, thresholds, repairs and labels of the programme's data rules.
# ---------------------------------------------------------------------------------------------
PARTNER_RECODE = {
    "ACME 2": "ACME",
    "ACME 3": "ACME",
    "AIDE 2": "AIDE",
    "CAPOSUD 2": "CAPOSUD",
    "CAPUC 2": "CAPUC",
    "CEDEL 2": "CEDEL",
}
YES_NO_RECODE = {"Oui": "yes", "Non": "no"}
YES_NO_RECODE_ANY_CASE = {"Oui": "yes", "Non": "no", "oui": "yes", "non": "no"}
SAVINGS_GROUP_RECODE = {
    "Aucun": "No group",
    "Association": "Association",
    "AVEC": "AVEC group",
    "BD&SME": "BD&SME",
    "MUSO": "MUSO",
    "Solidarite": "Solidarity group",
}
INCOME_FLOOR = 25000  # incomes below this (and missing incomes) are recorded as 0
DEFAULT_EMPLOYEES = 1
OWNER_AGE_MIN = 18  # missing ages and ages in (1, 18) become 18; 0 and 1 are kept
DEFAULT_INDUSTRY = "Services"
DEFAULT_CATEGORY = "Micro"
FIRED_AGE_REPAIRS = {1518: 17, 1935: 27, 3665: 51}
SUPPORT_LABELS = {"sup01": "Training", "sup02": "Coaching"}
SUPPORT_DEFAULT_LABEL = "Business legalization"
PARTNER_IDS = {
    "ccf1": 5,
    "fp1": 13,
    "gec1": 14,
    "ced1": 6,
    "cf1": 8,
    "gc1": 15,
    "mc1": 17,
    "sik1": 20,
    "aid1": 2,
    "kn1": 16,
}
HIRING_YES_NO_COLUMNS = ["contrat_temps_plein", "est_assure", "grace_support_meda", "est_decent_work"]
HIRING_COLUMNS = [
    "employee_key",
    "job_key",
    "age",
    "sex",
    "contract_duration",
    "is_full_time",
    "have_insurance",
    "thanks_to_project_support",
    "is_decent_work",
]
FIRING_COLUMNS = ["lic_key", "job_key", "sex", "age"]
CONFIDENTIAL_COLUMNS = ["nom_employe", "msme_name", "nom_msme"]

PROFILE_RENAMES = {
    "partenaire": "business_partner",
    "institution_financiere": "financial_institution",
    "date_enregistrement": "registration_date",
    "nom_msme": "msme_name",
    "revenu_annuel": "annual_income",
    "type_msme": "msme_category",
    "secteur_activite": "industry",
    "nombre_employe": "employee_number",
    "group_epargne": "savings_group",
    "montant_pret": "loan_amount",
    "age": "business_owner_age",
    "sex": "business_owner_sex",
}
PROFILE_COLUMNS = [
    "msme_key",
    "business_partner",
    "departement",
    "financial_institution",
    "business_owner_sex",
    "business_owner_age",
    "msme_productive",
    "msme_category",
    "industry",
    "savings_group",
]

JOB_RENAMES = {
    "nbre_employe_embauche": "total_hired_employee",
    "nombre_employe_licencie": "total_fired_employee",
    "date_collecte": "collecting_date",
}
HIRING_RENAMES = {
    "sexe": "sex",
    "contrat_temps_plein": "is_full_time",
    "est_assure": "have_insurance",
    "grace_support_meda": "thanks_to_project_support",
    "est_decent_work": "is_decent_work",
    "duree_contrat": "contract_duration",
}
SUCCESS_FACT_COLUMNS = ["msme_key", "registration_date", "annual_income", "employee_number", "loan_amount"]
DATE_PARTS = ["day", "month", "quarter", "year"]
DATE_SUCCESS_PARTS = {"day": "day_success", "month": "month_success", "quarter": "quarter_success", "year": "year_success"}
ACTIVITY_FACT_COLUMNS = [
    "activity_id",
    "activity_date",
    "support_type",
    "partner_id",
    "activity_theme",
    "activity_duration",
    "attendance_number",
]
DATE_ACTIVITY_PARTS = ["day_activity", "month_activity", "quarter_activity", "year_activity"]
SALES_FACT_COLUMNS = ["sales_key", "msme_key", "sales_reporting_date", "domestic_sale", "international_sale"]
DATE_SALES_PARTS = ["day_sales_reporting", "month_sales_reporting", "quarter_sales_reporting", "year_sales_reporting"]
JOB_FACT_COLUMNS = ["job_key", "msme_key", "collecting_date", "total_hired_employee", "total_fired_employee"]

INDUSTRY_RULES = [Rule("eq", "Service", DEFAULT_INDUSTRY), Rule("null", None, DEFAULT_INDUSTRY)]
PRODUCTIVE_RULES = [Rule("null", None, "no"), Rule("ieq", "oui", "yes"), Rule("ieq", "non", "no")]
AGRIBUSINESS_RULES = [Rule("ieq", "agribusiness", "Agribusiness")]
DEPARTEMENT_RULES = [
    Rule("eq", "NIPPES", "Nippes"),
    Rule("eq", "Sud-EST", "Sud-Est"),
    Rule("in", ("ARTIBONITE", "artibonite"), "Artibonite"),
]
FINANCIAL_RULES = [Rule("eq", "NON", "no")]
SEX_RULES = [Rule("eq", "f", "F"), Rule("eq", "m", "M")]


# --- bronze -> silver (row-local) ------------------------------------------------------------


def silver_profile(success_spark: DataFrame) -> DataFrame:
    """Business registrations: recodes, income floor, defaults, age rule, dates, English names."""
    df = recode(success_spark, PARTNER_RECODE, "partenaire")
    df = recode(df, YES_NO_RECODE, "institution_financiere")
    df = recode(df, YES_NO_RECODE, "msme_productive")
    df = recode(df, SAVINGS_GROUP_RECODE, "group_epargne")
    df = floor_below(df, "revenu_annuel", INCOME_FLOOR, 0)
    df = fill_null(df, {"nombre_employe": DEFAULT_EMPLOYEES})
    df = df.withColumns(
        {
            "nombre_employe": to_int_trunc("nombre_employe"),
            "age": clamp_open_range("age", 1, OWNER_AGE_MIN, OWNER_AGE_MIN, null_to=OWNER_AGE_MIN),
            "secteur_activite": normalize("secteur_activite", INDUSTRY_RULES),
            "date_enregistrement": parse_date("date_enregistrement"),
        }
    )
    df = add_calendar(df, "date_enregistrement")
    return rename(df, PROFILE_RENAMES)


def silver_jobs(success_job: DataFrame) -> DataFrame:
    """Job reports: rows without a report date dropped (before parsing), counts default to 0."""
    df = require_not_null(success_job, "date_collecte")
    df = fill_null(df, {"nbre_employe_embauche": 0, "nombre_employe_licencie": 0})
    df = add_calendar(df.withColumn("date_collecte", parse_date("date_collecte")), "date_collecte")
    return rename(df, JOB_RENAMES)


def silver_sales(success_sales: DataFrame) -> DataFrame:
    """Sales reports: missing sales are 0 (the text column keeps its text type)."""
    df = fill_null(success_sales, {"domestic_sale": 0, "international_sale": 0})
    df = df.withColumn("sales_reporting_date", parse_date("sales_reporting_date"))
    return add_calendar(df, "sales_reporting_date", suffix="_sales_reporting")


def silver_participants(participants: DataFrame) -> DataFrame:
    return rename(participants, {"activity_key": "activity_id"})


def silver_hiring(hired: DataFrame) -> DataFrame:
    df = recode(hired, YES_NO_RECODE_ANY_CASE, HIRING_YES_NO_COLUMNS)
    df = df.withColumn("duree_contrat", to_int_trunc("duree_contrat"))
    return rename(df, HIRING_RENAMES)


def silver_firing(fired: DataFrame) -> DataFrame:
    return rename(fired.withColumn("age", repair("age", FIRED_AGE_REPAIRS)), {"sexe": "sex"})


def silver_activity(activity: DataFrame) -> DataFrame:
    """Activities: rows without attendance dropped (an activity has at least one participant)."""
    df = require_not_null(activity, "attendance_number")
    df = df.withColumns(
        {"activity_duration": to_int_trunc("activity_duration"), "activity_date": parse_date("activity_date")}
    )
    df = add_calendar(df, "activity_date", suffix="_activity")
    return rename(df, {"activity_key": "activity_id"})


SILVER_STEPS = {
    "success_updated": ("success_spark", silver_profile),
    "job_updated": ("success_job", silver_jobs),
    "sales_updated": ("success_sales", silver_sales),
    "participant_updated": ("success_participant_list", silver_participants),
    "hiring_updated": ("success_hired_employee", silver_hiring),
    "firing_updated": ("success_fired_employee", silver_firing),
    "activity_updated": ("success_activity_monitoring", silver_activity),
}


def silver_from_bronze(bronze: Mapping[str, DataFrame]) -> LazyFrames:
    """Silver tables, each built on first use."""
    return LazyFrames({name: (lambda src=src, step=step: step(bronze[src])) for name, (src, step) in SILVER_STEPS.items()})


# --- silver -> gold ------------------------------------------------------------------------------


def gold_success_silver(success_updated: DataFrame) -> DataFrame:
    """Second pass of rules on registrations: types, defaults and spelling variants."""
    return success_updated.withColumns(
        {
            "business_owner_age": to_int_trunc("business_owner_age"),
            "msme_category": F.coalesce(F.col("msme_category"), F.lit(DEFAULT_CATEGORY)),
            "msme_productive": normalize("msme_productive", PRODUCTIVE_RULES),
            "industry": normalize("industry", AGRIBUSINESS_RULES),
            "departement": normalize("departement", DEPARTEMENT_RULES),
            "financial_institution": normalize("financial_institution", FINANCIAL_RULES),
            "business_owner_sex": normalize("business_owner_sex", SEX_RULES),
            "annual_income": decimal_gate(success_updated, "annual_income", 10, 2),
        }
    )


def gold_success(success_updated: DataFrame) -> dict[str, DataFrame]:
    s = gold_success_silver(success_updated)
    return {
        "success_fact": fact_table(
            s,
            SUCCESS_FACT_COLUMNS,
            {"registration_date": "registration_date_id"},
        ),
        "success_profile": profile_dimension(s, PROFILE_COLUMNS),
        "date_success": date_dimension(
            s,
            "registration_date",
            DATE_PARTS,
            id_name="registration_date_id",
            part_names=DATE_SUCCESS_PARTS,
        ),
    }


def activity_with_partner(activity_updated: DataFrame) -> DataFrame:
    """Partner code -> partner id through the literal map; unknown codes give null."""
    return activity_updated.withColumn("partner_id", map_lookup("partner_key", PARTNER_IDS)).drop("partner_key")


def gold_activity(activity_updated: DataFrame) -> dict[str, DataFrame]:
    a = activity_with_partner(activity_updated)
    return {
        "activity_fact": fact_table(
            a,
            ACTIVITY_FACT_COLUMNS,
            {"support_type": "support_id", "activity_date": "activity_date_id"},
        ),
        "date_activity": date_dimension(
            activity_updated,
            "activity_date",
            DATE_ACTIVITY_PARTS,
            id_name="activity_date_id",
        ),
        "support_activity": attribute_dimension(
            activity_updated, "support_type", "support_id", "support_name", SUPPORT_LABELS, SUPPORT_DEFAULT_LABEL
        ),
    }


def gold_sales(sales_updated: DataFrame) -> dict[str, DataFrame]:
    return {
        "sales_fact": fact_table(
            sales_updated,
            SALES_FACT_COLUMNS,
            {"sales_reporting_date": "date_sales_id"},
        ),
        "date_sales": date_dimension(
            sales_updated,
            "sales_reporting_date",
            DATE_SALES_PARTS,
            id_name="date_sales_id",
        ),
    }


def gold_jobs(job_updated: DataFrame) -> dict[str, DataFrame]:
    return {
        "job_fact": fact_table(
            job_updated,
            JOB_FACT_COLUMNS,
            {"collecting_date": "date_job_id"},
        ),
        "date_job": date_dimension(job_updated, "collecting_date", DATE_PARTS, id_name="date_job_id"),
    }


def gold_people(hiring_updated: DataFrame, firing_updated: DataFrame) -> dict[str, DataFrame]:
    """Hires and dismissals without their confidential columns (allow-list)."""
    return {
        "hiring": anonymize(hiring_updated, HIRING_COLUMNS, CONFIDENTIAL_COLUMNS),
        "firing": anonymize(firing_updated, FIRING_COLUMNS, CONFIDENTIAL_COLUMNS),
    }


def gold_participants(participant_updated: DataFrame, confidential: Sequence[str] = ()) -> DataFrame:
    """The bridge table passes through whole, but for columns named as confidential."""
    return participant_updated.drop(*confidential)


def gold_from_silver(silver: Mapping[str, DataFrame]) -> LazyFrames:
    """Gold tables, each built on first use (tables of one silver source are built together)."""
    groups: dict[str, Callable[[], dict[str, DataFrame]]] = {
        "success": lambda: gold_success(silver["success_updated"]),
        "activity": lambda: gold_activity(silver["activity_updated"]),
        "sales": lambda: gold_sales(silver["sales_updated"]),
        "jobs": lambda: gold_jobs(silver["job_updated"]),
        "hiring": lambda: {"hiring": anonymize(silver["hiring_updated"], HIRING_COLUMNS, CONFIDENTIAL_COLUMNS)},
        "firing": lambda: {"firing": anonymize(silver["firing_updated"], FIRING_COLUMNS, CONFIDENTIAL_COLUMNS)},
        "participants": lambda: {"participant_updated": gold_participants(silver["participant_updated"])},
    }
    members = {
        "success": ["success_fact", "success_profile", "date_success"],
        "activity": ["activity_fact", "date_activity", "support_activity"],
        "sales": ["sales_fact", "date_sales"],
        "jobs": ["job_fact", "date_job"],
        "hiring": ["hiring"],
        "firing": ["firing"],
        "participants": ["participant_updated"],
    }
    built: dict[str, dict[str, DataFrame]] = {}

    def table(group: str, name: str) -> DataFrame:
        if group not in built:
            built[group] = groups[group]()
        return built[group][name]

    return LazyFrames({name: (lambda g=g, name=name: table(g, name)) for g, names in members.items() for name in names})


# --- batch runs ----------------------------------------------------------------------------------

# Facts are written sorted by their date key within each task, so date slicers prune row groups.
FACT_DATE_COLUMNS = {"sales_fact": ["date_sales_id"], "job_fact": ["date_job_id"]}
FACT_KEYS = {"sales_fact": "sales_key", "job_fact": "job_key"}


def _for_date_partitions(df: DataFrame, date_key: Sequence[str], fact_key: str) -> DataFrame:
    """Range-partition by (date, fact key) before a write partitioned by date: each task holds
    a contiguous slice, so a day yields few files, and a day holding a third of all rows is
    still split over many tasks by the fact key (hash-partitioning by the date alone would put
    it in one task)."""
    return df.repartitionByRange(*[F.col(c) for c in date_key], F.col(fact_key))


@dataclass
class RunReport:
    """Paths written, and per table (``layer.name``) the counters that its write observed."""

    written: list[str]
    quality: dict[str, dict[str, int]] = field(default_factory=dict)


WriteTask = Callable[[], "str | list[str]"]


def run_writes(tasks: Sequence[WriteTask], parallelism: int = 4) -> list[str]:
    """Run independent table writes, several at a time.

    Each write is its own Spark job; submitting independent ones from a few driver threads keeps
    the executors busy while a small job (a dimension, a copy) finishes, instead of idling
    between jobs. Large writes still use the whole cluster each. Order of results is the order
    of ``tasks``; the first failure is raised.
    """
    if parallelism <= 1 or len(tasks) <= 1:
        results = [t() for t in tasks]
    else:
        with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="kpi-lake-write") as pool:
            results = list(pool.map(lambda t: t(), tasks))
    out: list[str] = []
    for r in results:
        out.extend(r if isinstance(r, list) else [r])
    return out


def bronze_to_silver_tasks(spark: SparkSession, lake: Lake, counters: QualityCounters) -> list[WriteTask]:
    """Seven independent row-local jobs: read bronze, clean, overwrite silver."""

    def write(name: str, src: str, step: Callable[[DataFrame], DataFrame]) -> str:
        df = counters.step(f"silver.{name}", read_table(spark, lake, "bronze", src), step)
        return write_table(df, lake, "silver", name)

    return [(lambda name=name, src=src, step=step: write(name, src, step)) for name, (src, step) in SILVER_STEPS.items()]


#: Gold tables that get the durable key of their business where ``durable_keys`` is asked for.
KEYED_TABLES = ("success_fact", "success_profile", "sales_fact", "job_fact")


def entity_keys(lake: Lake) -> KeyMap:
    """The stored map of business keys, beside the gold tables."""
    return KeyMap(lake, "gold", "msme_keys", ("msme_key",), "msme_sk")


def silver_to_gold_tasks(
    spark: SparkSession, lake: Lake, partition_facts: bool = False, counters: QualityCounters | None = None, durable_keys: bool = False
) -> list[WriteTask]:
    """Gold tables from silver. Each output reads silver again with only its own columns
    (column pruning beats caching the wide silver frame); the support dimension is written once
    and copied to the second layer from the written files.

    ``partition_facts`` writes the sales and job facts partitioned by their date key (one folder
    per day): a date slicer's literal range then prunes folders at planning time and the
    broadcast calendar semi join prunes them at run time (dynamic partition pruning). Meant for
    cluster-size facts; on small data it only makes many small files.

    With ``durable_keys`` the map of business keys is refreshed first (a key that no table uses yet
    does no harm if a later write fails), and ``KEYED_TABLES`` are written with ``msme_sk``."""
    counters = counters or QualityCounters()
    known, keys = None, entity_keys(lake)
    if durable_keys:
        known = keys.refresh(*[read_table(spark, lake, "silver", t) for t in ("success_updated", "sales_updated", "job_updated")])

    def ready(name: str, df: DataFrame) -> DataFrame:
        if known is not None and name in KEYED_TABLES:
            df = keys.apply(df, known)
        return counters.output(f"gold.{name}", df, [c for c in NOT_NULL_COLUMNS.get(name, []) if c in df.columns])

    def silver(name: str) -> DataFrame:
        return read_table(spark, lake, "silver", name)

    success = gold_success(silver("success_updated"))
    activity = gold_activity(silver("activity_updated"))
    people = gold_people(silver("hiring_updated"), silver("firing_updated"))
    tasks: list[WriteTask] = [
        lambda: write_table(
            ready("success_fact", success["success_fact"]), lake, "gold", "success_fact", schema_mode="replace", sort_within=["registration_date_id"]
        ),
        lambda: write_table(ready("success_profile", success["success_profile"]), lake, "gold", "success_profile"),
        lambda: write_table(ready("date_success", success["date_success"]), lake, "gold", "date_success"),
        lambda: write_many(
            ready("support_activity", activity["support_activity"]), [(lake, "silver", "support_activity"), (lake, "gold", "support_activity")]
        ),
        lambda: write_table(
            ready("activity_fact", activity["activity_fact"]), lake, "gold", "activity_fact", schema_mode="merge", sort_within=["activity_date_id"]
        ),
        lambda: write_table(ready("date_activity", activity["date_activity"]), lake, "gold", "date_activity"),
    ]
    for tables in (gold_sales(silver("sales_updated")), gold_jobs(silver("job_updated"))):
        for name, df in tables.items():
            date_key = FACT_DATE_COLUMNS.get(name, [])
            tasks.append(
                lambda name=name, df=df, date_key=date_key: write_table(
                    _for_date_partitions(ready(name, df), date_key, FACT_KEYS[name]) if (partition_facts and date_key) else ready(name, df),
                    lake,
                    "gold",
                    name,
                    sort_within=() if partition_facts else date_key,
                    partition_by=date_key if partition_facts else (),
                )
            )
    for name, df in people.items():
        tasks.append(lambda name=name, df=df: write_table(ready(name, df), lake, "gold", name))
    tasks.append(lambda: copy_table(spark, lake, "silver", "participant_updated", lake, "gold"))
    return tasks


def run_bronze_to_silver(spark: SparkSession, lake: Lake, parallelism: int = 4) -> RunReport:
    counters = QualityCounters()
    written = run_writes(bronze_to_silver_tasks(spark, lake, counters), parallelism)
    return RunReport(written, counters.report())


def run_silver_to_gold(
    spark: SparkSession, lake: Lake, parallelism: int = 4, partition_facts: bool = False, durable_keys: bool = False
) -> RunReport:
    counters = QualityCounters()
    written = run_writes(silver_to_gold_tasks(spark, lake, partition_facts, counters, durable_keys), parallelism)
    return RunReport(written, counters.report())


def run_all(
    spark: SparkSession, sf_dir: str, lake: Lake, parallelism: int = 4, partition_facts: bool = False, durable_keys: bool = False
) -> RunReport:
    """Stand-in bronze from the shared tables, then silver, then gold (layers in order; the
    tables of one layer side by side)."""
    from kpi_lake.sources.standins import bronze_from_sources

    bronze = bronze_from_sources(spark, sf_dir)
    bronze_tasks: list[WriteTask] = [
        (lambda name=name: write_table(bronze[name], lake, "bronze", name)) for name in bronze
    ]
    written = run_writes(bronze_tasks, parallelism)
    silver = run_bronze_to_silver(spark, lake, parallelism)
    gold = run_silver_to_gold(spark, lake, parallelism, partition_facts, durable_keys)
    return RunReport(written + silver.written + gold.written, silver.quality | gold.quality)


__all__ = [
    "SILVER_STEPS",
    "activity_with_partner",
    "gold_activity",
    "gold_from_silver",
    "gold_jobs",
    "gold_participants",
    "gold_people",
    "gold_sales",
    "gold_success",
    "gold_success_silver",
    "run_all",
    "run_writes",
    "run_bronze_to_silver",
    "run_silver_to_gold",
    "silver_activity",
    "silver_firing",
    "silver_from_bronze",
    "silver_hiring",
    "silver_jobs",
    "silver_participants",
    "silver_profile",
    "silver_sales",
]
