"""Bronze tables derived from the shared test tables.

The programme's raw tables (business registrations, job reports, sales reports, activity
monitoring, participants, hires, dismissals) are not public. Each one is derived here, with
Spark, from a table of the shared set, so every query reads real tables and its work grows with
them. The derivations also put in the defects the cleaning rules exist for: text numbers and
text dates, spelling and case variants, nulls, unparseable dates and known bad ages.

  success_spark                <- customer, nation, first order date per customer
  success_job                  <- lineitem per order (+ orders for the customer)
  success_sales                <- orders
  success_participant_list     <- events (event -> user)
  success_hired_employee       <- lineitem rows not returned
  success_fired_employee       <- lineitem rows returned
  success_activity_monitoring  <- events

Every derivation is a row-local projection except two pre-aggregations (first order date per
customer; quantities per order), which shuffle on the aggregation key after map-side combining.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.functions.calendar import date_text
from kpi_lake.sources.layers import Lake, read_table, source_lake
from kpi_lake.sources.lazy import LazyFrames

BRONZE_TABLES = (
    "success_spark",
    "success_job",
    "success_sales",
    "success_participant_list",
    "success_hired_employee",
    "success_fired_employee",
    "success_activity_monitoring",
)

# Fixed values used to derive the stand-in bronze tables (kept in step with kpi_oracle/sql.py).
PARTNER_NAMES = ["ACME", "ACME 2", "ACME 3", "AIDE 2", "CAPUC 2", "CEDEL"]
DEPARTEMENT_VARIANTS = ["NIPPES", "Sud-EST", "ARTIBONITE", "artibonite", "Nippes", None]
FINANCIAL_ANSWERS = ["Oui", "Non", "NON", "OUI", None, "yes"]
PRODUCTIVE_ANSWERS = ["Oui", "Non", "OUI", "nOn", None]
SAVINGS_GROUPS = ["Aucun", "Association", "AVEC", "BD&SME", "MUSO", "Solidarite", None]
SEXES = ["F", "M", "f", "m"]
INDUSTRY_BY_SEGMENT = {
    "AUTOMOBILE": "Service",
    "BUILDING": None,
    "FURNITURE": "AGRIBUSINESS",
    "MACHINERY": "agribusiness",
    "HOUSEHOLD": "Commerce",
}
PARTNER_KEYS = ["ccf1", "fp1", "gec1", "ced1", "cf1", "gc1", "mc1", "sik1", "aid1", "kn1", "CCF1", None]
SUPPORT_BY_EVENT = {"view": "sup01", "click": "sup02", "signup": "sup03", "purchase": "sup04"}
BAD_DATE_TEXT = "13/45/2024"


def pick(index: Column, values: Sequence[object], modulus: int | None = None, otherwise: Column | None = None) -> Column:
    """``values[index % modulus]`` for a non-negative integer column (modulus defaults to the
    number of values); positions past the list take ``otherwise``."""
    pos = index % F.lit(modulus or len(values))
    expr = None
    for i, v in enumerate(values):
        cond = pos == F.lit(i)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if otherwise is not None:
        expr = expr.otherwise(otherwise)  # type: ignore[union-attr]
    return expr  # type: ignore[return-value]


def _map_value(col: Column, mapping: dict[str, object]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr  # type: ignore[return-value]


def _key_text(*cols: str) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])


def success_spark(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """Business registrations: one row per customer."""
    first_order = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    income_text = (bal.cast("decimal(12,2)") * F.lit(10)).cast("decimal(12,2)").cast("string")
    reg_date = F.to_date(F.col("first_order"))
    return (
        # nation is a fixed 25-row table by definition of the schema: a proven broadcast bound.
        customer.join(F.broadcast(nation.select("n_nationkey", "n_name")), customer.c_nationkey == F.col("n_nationkey"), "left")
        .join(first_order, k == F.col("o_custkey"), "left")
        .select(
            k.cast("string").alias("msme_key"),
            F.col("c_name").alias("nom_msme"),
            pick(F.col("c_nationkey"), PARTNER_NAMES).alias("partenaire"),
            pick(F.col("c_nationkey"), DEPARTEMENT_VARIANTS, modulus=8, otherwise=F.col("n_name")).alias("departement"),
            pick(k, FINANCIAL_ANSWERS).alias("institution_financiere"),
            pick(k, PRODUCTIVE_ANSWERS).alias("msme_productive"),
            pick(k, SAVINGS_GROUPS).alias("group_epargne"),
            F.when(k % 13 == 0, F.lit(None).cast("string"))
            .when(k % 17 == 0, F.lit("n/a"))
            .when(k % 19 == 0, F.lit(" 30000"))
            .otherwise(income_text)
            .alias("revenu_annuel"),
            F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.abs(bal) / F.lit(100.0)).alias("nombre_employe"),
            F.when(k % 9 == 0, F.lit(None).cast("double"))
            .otherwise((k % 70).cast("double") + F.lit(0.5))
            .alias("age"),
            pick(k, SEXES).alias("sex"),
            F.when(bal < 0, F.lit(None).cast("string"))
            .when(bal < 3000, F.lit("Micro"))
            .when(bal < 7000, F.lit("Small"))
            .otherwise(F.lit("Medium"))
            .alias("type_msme"),
            _map_value(F.col("c_mktsegment"), INDUSTRY_BY_SEGMENT).alias("secteur_activite"),
            F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(F.abs(bal) * F.lit(10.0)).alias("montant_pret"),
            F.when(k % 29 == 0, F.lit(BAD_DATE_TEXT)).otherwise(date_text(reg_date)).alias("date_enregistrement"),
        )
    )


def success_job(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Job reports: one row per order that has lines; returned quantities count as dismissals."""
    qty = F.col("l_quantity").cast("bigint")
    returned = F.col("l_returnflag") == F.lit("R")
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(~returned, qty)).alias("hired"),
        F.sum(F.when(returned, qty)).alias("fired"),
        F.min("l_shipdate").alias("first_ship"),
    )
    k = F.col("l_orderkey")
    return per_order.join(orders.select("o_orderkey", "o_custkey"), k == F.col("o_orderkey")).select(
        k.cast("string").alias("job_key"),
        F.col("o_custkey").cast("string").alias("msme_key"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
        .when(k % 41 == 0, F.lit(BAD_DATE_TEXT))
        .otherwise(date_text(F.to_date("first_ship")))
        .alias("date_collecte"),
        F.col("hired").alias("nbre_employe_embauche"),
        F.col("fired").alias("nombre_employe_licencie"),
    )


def success_sales(orders: DataFrame) -> DataFrame:
    """Sales reports: one row per order."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return orders.select(
        k.cast("string").alias("sales_key"),
        F.col("o_custkey").cast("string").alias("msme_key"),
        F.when(k % 43 == 0, F.lit(BAD_DATE_TEXT)).otherwise(date_text(F.to_date("o_orderdate"))).alias("sales_reporting_date"),
        F.when(k % 31 == 0, F.lit(None).cast("bigint")).otherwise(price.cast("bigint")).alias("domestic_sale"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 0, price.cast("decimal(18,2)").cast("string"))
        .otherwise((price / F.lit(10.0)).cast("bigint").cast("string"))
        .alias("international_sale"),
    )


def success_participant_list(events: DataFrame) -> DataFrame:
    """Participants: the user behind each event attended that activity."""
    return events.select(
        F.col("event_id").cast("string").alias("activity_key"),
        F.col("user_id").cast("string").alias("msme_key"),
        F.col("event_type").alias("participation"),
    )


def _employee_columns() -> list[Column]:
    return [
        F.col("l_orderkey").cast("string").alias("job_key"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sexe"),
        F.concat(F.lit("employee "), _key_text("l_orderkey", "l_linenumber")).alias("nom_employe"),
    ]


def success_hired_employee(lineitem: DataFrame) -> DataFrame:
    """Hires: order lines that were not returned."""
    hired = lineitem.filter(F.col("l_returnflag") != F.lit("R"))
    return hired.select(
        _key_text("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("employee_key"),
        *_employee_columns(),
        (F.lit(18) + F.col("l_partkey") % 45).cast("bigint").alias("age"),
        (F.col("l_quantity").cast("decimal(12,2)") / F.lit(4)).cast("decimal(12,2)").cast("string").alias("duree_contrat"),
        F.when(F.col("l_linestatus") == "O", F.lit("Oui")).otherwise(F.lit("non")).alias("contrat_temps_plein"),
        pick(F.col("l_suppkey"), ["Oui", "Non", "oui", "non"]).alias("est_assure"),
        pick(F.col("l_partkey"), ["Oui", "non", None]).alias("grace_support_meda"),
        pick(F.col("l_orderkey"), ["oui", "Non", "OUI", "non", "Oui"]).alias("est_decent_work"),
    )


def success_fired_employee(lineitem: DataFrame) -> DataFrame:
    """Dismissals: returned order lines; some ages carry the known data-entry errors."""
    fired = lineitem.filter(F.col("l_returnflag") == F.lit("R"))
    p = F.col("l_partkey") % 50
    return fired.select(
        _key_text("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("lic_key"),
        *_employee_columns(),
        F.when(p == 0, F.lit(1518))
        .when(p == 1, F.lit(1935))
        .when(p == 2, F.lit(3665))
        .otherwise(F.lit(20) + F.col("l_suppkey") % 40)
        .cast("bigint")
        .alias("age"),
    )


def success_activity_monitoring(events: DataFrame) -> DataFrame:
    """Activities: one row per event; value is the duration in hours."""
    k = F.col("event_id")
    return events.select(
        k.cast("string").alias("activity_key"),
        pick(F.col("user_id"), PARTNER_KEYS).alias("partner_key"),
        _map_value(F.col("event_type"), SUPPORT_BY_EVENT).alias("support_type"),
        F.col("props").alias("activity_theme"),
        date_text(F.to_date("ts")).alias("activity_date"),
        F.col("value").alias("activity_duration"),
        F.when(k % 13 == 0, F.lit(None).cast("bigint")).otherwise(F.col("value").cast("bigint")).alias("attendance_number"),
    )


_SOURCE_SCANS: dict[tuple, tuple[object, DataFrame]] = {}


def folder_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of what lies in a folder: changes when a table is refreshed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)  # noqa: SLF001 - listing only
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))


def forget_stopped(memo: dict[tuple, object], session: tuple) -> None:
    """Drop what other sessions left in a memo whose keys begin with the session."""
    for key in [k for k in memo if k[0] != session]:
        del memo[key]


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one shared (read-only) table; the scan frame is reused across queries of the
    same session, so the file listing and footer read happen once, until the folder changes."""
    from kpi_lake.session import session_key

    session, state = session_key(spark), folder_state(spark, sf_dir)
    key = (session, sf_dir, name)
    if key not in _SOURCE_SCANS or _SOURCE_SCANS[key][0] != state:
        forget_stopped(_SOURCE_SCANS, session)
        _SOURCE_SCANS[key] = (state, read_table(spark, source_lake(sf_dir), "", name))
    return _SOURCE_SCANS[key][1]


def bronze_from_sources(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """All seven bronze tables as lazy frames over the shared parquet folder."""

    def t(name: str) -> DataFrame:
        return source_table(spark, sf_dir, name)

    return LazyFrames(
        {
            "success_spark": lambda: success_spark(t("customer"), t("nation"), t("orders")),
            "success_job": lambda: success_job(t("lineitem"), t("orders")),
            "success_sales": lambda: success_sales(t("orders")),
            "success_participant_list": lambda: success_participant_list(t("events")),
            "success_hired_employee": lambda: success_hired_employee(t("lineitem")),
            "success_fired_employee": lambda: success_fired_employee(t("lineitem")),
            "success_activity_monitoring": lambda: success_activity_monitoring(t("events")),
        }
    )


def load_bronze(spark: SparkSession, sf_dir: str, lake: Lake) -> list[str]:
    """Write the stand-in bronze tables into ``lake`` (full refresh)."""
    from kpi_lake.sources.layers import write_table

    return [write_table(df, lake, "bronze", name) for name, df in bronze_from_sources(spark, sf_dir).items()]


__all__ = ["BRONZE_TABLES", "bronze_from_sources", "load_bronze", "pick"]
