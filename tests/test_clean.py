"""Cleaning rules on small frames: nulls, case variants, garbage and boundaries."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from kpi_lake.functions import calendar as cal
from kpi_lake.functions import clean
from kpi_lake.plans import pipelines as P


def col_values(df, name):
    return [r[name] for r in df.collect()]


def one_col(spark, name, values, dtype=StringType()):
    schema = StructType([StructField("i", LongType()), StructField(name, dtype)])
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema).orderBy("i")


def test_income_floor_then_decimal_gate(spark):
    raw = [None, "24999.99", "25000", "30000.50", "abc", " 30000", "1e5", "123456789012"]
    df = one_col(spark, "annual_income", raw)
    floored = clean.floor_below(df, "annual_income", P.INCOME_FLOOR, 0)
    assert col_values(floored, "annual_income") == ["0", "0", "25000", "30000.50", "abc", " 30000", "1e5", "123456789012"]
    gated = floored.select("i", clean.decimal_gate(floored, "annual_income", 10, 2).alias("v")).orderBy("i")
    assert col_values(gated, "v") == [
        Decimal("0.00"),
        Decimal("0.00"),
        Decimal("25000.00"),
        Decimal("30000.50"),
        None,
        None,
        None,
        None,
    ]


def test_numeric_income_is_not_lost_to_exponent_text(spark):
    df = one_col(spark, "annual_income", [12345678.9], DoubleType())
    out = df.select(clean.decimal_gate(df, "annual_income", 10, 2).alias("v"))
    assert col_values(out, "v") == [Decimal("12345678.90")]


def test_employees_default_and_truncate(spark):
    df = one_col(spark, "n", [None, 7.6, 0.0, -7.6], DoubleType())
    out = clean.fill_null(df, {"n": P.DEFAULT_EMPLOYEES}).select("i", clean.to_int_trunc("n").alias("n")).orderBy("i")
    assert col_values(out, "n") == [1, 7, 0, -7]


def test_owner_age_rule(spark):
    df = one_col(spark, "age", [None, 0.0, 1.0, 1.5, 17.0, 18.0, 45.0], DoubleType())
    out = df.select("i", clean.clamp_open_range("age", 1, 18, 18, null_to=18).alias("a")).orderBy("i")
    assert col_values(out, "a") == [18.0, 0.0, 1.0, 18.0, 18.0, 18.0, 45.0]


def test_industry_rules(spark):
    df = one_col(spark, "industry", [None, "Service", "AGRIBUSINESS", "Commerce"])
    silver = df.select("i", clean.normalize("industry", P.INDUSTRY_RULES).alias("industry"))
    gold = silver.select("i", clean.normalize("industry", P.AGRIBUSINESS_RULES).alias("industry")).orderBy("i")
    assert col_values(gold, "industry") == ["Services", "Services", "Agribusiness", "Commerce"]


def test_departement_rules(spark):
    df = one_col(spark, "d", ["NIPPES", "Sud-EST", "ARTIBONITE", "artibonite", "Ouest", None])
    out = df.select("i", clean.normalize("d", P.DEPARTEMENT_RULES).alias("d")).orderBy("i")
    assert col_values(out, "d") == ["Nippes", "Sud-Est", "Artibonite", "Artibonite", "Ouest", None]


def test_yes_no_silver_and_gold(spark):
    df = one_col(spark, "v", ["Oui", "Non", "OUI", "nOn", None, "maybe"])
    silver = clean.recode(df, P.YES_NO_RECODE, "v")
    assert col_values(silver.orderBy("i"), "v") == ["yes", "no", "OUI", "nOn", None, "maybe"]
    productive = silver.select("i", clean.normalize("v", P.PRODUCTIVE_RULES).alias("v")).orderBy("i")
    assert col_values(productive, "v") == ["yes", "no", "yes", "no", "no", "maybe"]
    financial = silver.select("i", clean.normalize("v", P.FINANCIAL_RULES).alias("v")).orderBy("i")
    assert col_values(financial, "v") == ["yes", "no", "OUI", "nOn", None, "maybe"]


def test_hiring_recode_any_case(spark):
    df = one_col(spark, "v", ["Oui", "Non", "oui", "non", "OUI"])
    out = clean.recode(df, P.YES_NO_RECODE_ANY_CASE, ["v"]).orderBy("i")
    assert col_values(out, "v") == ["yes", "no", "yes", "no", "OUI"]


def test_partner_recode_and_idempotence(spark):
    df = one_col(spark, "p", ["ACME 2", "ACME 3", "ACME", "XYZ", None])
    once = clean.recode(df, P.PARTNER_RECODE, "p")
    twice = clean.recode(once, P.PARTNER_RECODE, "p")
    assert col_values(once.orderBy("i"), "p") == ["ACME", "ACME", "ACME", "XYZ", None]
    assert col_values(twice.orderBy("i"), "p") == col_values(once.orderBy("i"), "p")


def test_partner_lookup(spark):
    df = one_col(spark, "k", ["ccf1", "CCF1", None, "kn1"])
    out = df.select("i", clean.map_lookup("k", P.PARTNER_IDS).alias("id")).orderBy("i")
    assert col_values(out, "id") == [5, None, None, 16]
    assert dict(out.dtypes)["id"] == "bigint"


def test_support_label(spark):
    df = one_col(spark, "s", ["sup01", "sup02", "sup03", None])
    out = df.select("i", clean.label("s", P.SUPPORT_LABELS, P.SUPPORT_DEFAULT_LABEL).alias("l")).orderBy("i")
    assert col_values(out, "l") == ["Training", "Coaching", "Business legalization", "Business legalization"]


def test_fired_age_repairs(spark):
    df = one_col(spark, "age", [1518, 1935, 3665, 40, None], LongType())
    out = df.select("i", clean.repair("age", P.FIRED_AGE_REPAIRS).alias("age")).orderBy("i")
    assert col_values(out, "age") == [17, 27, 51, 40, None]


def test_date_parse_and_calendar(spark):
    df = one_col(spark, "d", ["1/5/2024", "12/31/2023", "13/45/2024", "2024-01-05", None])
    out = cal.parse_and_add_calendar(df, "d").orderBy("i")
    rows = out.collect()
    assert [r["d"] for r in rows] == [dt.date(2024, 1, 5), dt.date(2023, 12, 31), None, None, None]
    assert [r["quarter"] for r in rows] == [1, 4, None, None, None]
    assert [r["day"] for r in rows][:2] == [5, 31]


def test_row_filters_keep_bad_dates_and_zero_attendance(spark):
    jobs = spark.createDataFrame(
        [("j1", "m", None, 1, 0), ("j2", "m", "bad", 2, None), ("j3", "m", "2/1/2024", None, 1)],
        "job_key string, msme_key string, date_collecte string, nbre_employe_embauche long, nombre_employe_licencie long",
    )
    out = P.silver_jobs(jobs).orderBy("job_key").collect()
    assert [r["job_key"] for r in out] == ["j2", "j3"]
    assert out[0]["collecting_date"] is None
    assert [r["total_hired_employee"] for r in out] == [2, 0]
    acts = spark.createDataFrame(
        [("a1", None, 1.5, "1/2/2024"), ("a2", 0, 2.9, "1/2/2024")],
        "activity_key string, attendance_number long, activity_duration double, activity_date string",
    )
    kept = P.silver_activity(acts).collect()
    assert [(r["activity_id"], r["attendance_number"], r["activity_duration"]) for r in kept] == [("a2", 0, 2)]


def test_fill_null_keeps_text_type(spark):
    df = spark.createDataFrame([(None, None), (5, "7")], "domestic_sale long, international_sale string")
    out = clean.fill_null(df, {"domestic_sale": 0, "international_sale": 0})
    assert dict(out.dtypes) == {"domestic_sale": "bigint", "international_sale": "string"}
    assert sorted(out.collect(), key=lambda r: r[0]) == sorted([(0, "0"), (5, "7")])


def test_anonymize_refuses_confidential(spark):
    import pytest

    df = spark.createDataFrame([("k", "name")], "employee_key string, nom_employe string")
    with pytest.raises(clean.ConfidentialColumnError):
        clean.anonymize(df, ["employee_key", "nom_employe"], P.CONFIDENTIAL_COLUMNS)
    assert clean.anonymize(df, ["employee_key"], P.CONFIDENTIAL_COLUMNS).columns == ["employee_key"]


def test_format_kpi(spark):
    from kpi_lake.functions.formatting import format_kpi

    df = spark.createDataFrame([(1, 1234567), (2, -2500), (3, None), (4, 499)], "i int, v long")
    out = df.select(
        "i",
        format_kpi("v", "currency0", 1000).alias("k"),
        format_kpi("v", "currency0").alias("c"),
        format_kpi("v", "integer").alias("n"),
    ).orderBy("i")
    rows = [tuple(r)[1:] for r in out.collect()]
    assert rows == [
        ("$1,235K", "$1,234,567", "1234567"),
        ("($3K)", "($2,500)", "-2500"),
        (None, None, None),
        ("$0K", "$499", "499"),
    ]
    d = spark.createDataFrame([(dt.date(2024, 3, 5),)], "d date")
    assert d.select(format_kpi("d", "date").alias("t")).first()["t"] == "3/5/2024"


def test_no_python_udf_in_silver_plans(spark):
    from kpi_lake.plans.catalog import silver

    for name in ["success_updated", "job_updated", "sales_updated", "activity_updated", "hiring_updated"]:
        plan = silver(spark, "/root/testdata/sf0.001")[name]._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_text_compared_as_plain_number_only(spark):
    df = one_col(spark, "income", ["2e4", " 24999.5 ", "+100", "1,000", "24999.", "abc", "-5"])
    out = clean.floor_below(df, "income", P.INCOME_FLOOR, 0).orderBy("i")
    assert col_values(out, "income") == ["2e4", "0", "0", "1,000", "0", "abc", "0"]


def test_nan_is_not_null_unless_asked(spark):
    df = one_col(spark, "n", [float("nan"), None, 2.0], DoubleType())
    kept = clean.fill_null(df, {"n": 1}).orderBy("i")
    assert [v != v for v in col_values(kept, "n")] == [True, False, False]  # NaN survives a null test
    fixed = clean.fill_null(df, {"n": 1}, nan_as_null=True).orderBy("i")
    assert col_values(fixed, "n") == [1.0, 1.0, 2.0]


def test_currency_with_optional_decimals(spark):
    from kpi_lake.functions.formatting import format_kpi

    df = spark.createDataFrame([(1, 1230.0), (2, 10.5), (3, -142275580.65), (4, 100.0), (5, None)], "i int, v double")
    out = df.select("i", format_kpi("v", "currency").alias("t")).orderBy("i")
    assert col_values(out, "t") == ["$1,230", "$10.5", "($142,275,580.65)", "$100", None]
