"""A small gold star schema for model tests (every table of the model, a few rows each)."""

from __future__ import annotations

import datetime as dt

from kpi_lake.plans.semantic import build_model

D = dt.date


def star_tables(spark):
    t = {}
    t["success_profile"] = spark.createDataFrame(
        [
            ("m1", "ACME", "Nippes", "yes", "F", 30, "yes", "Micro", "Services", "MUSO"),
            ("m2", "AIDE", "Ouest", "Yes", "M", 40, "no", "Small", "Commerce", "MUSO"),
            ("m3", "ACME", "Nippes", "no", "F", 50, "no", "Micro", "Agribusiness", None),
            ("m4", "CEDEL", "Sud-Est", None, "M", 18, "no", "Medium", "Services", None),
        ],
        "msme_key string, business_partner string, departement string, financial_institution string, "
        "business_owner_sex string, business_owner_age long, msme_productive string, msme_category string, "
        "industry string, savings_group string",
    )
    t["success_fact"] = spark.createDataFrame(
        [
            ("m1", D(2021, 1, 10), 30000.0, 3, 100.0),
            ("m2", D(2022, 5, 1), 0.0, 1, 200.5),
            ("m3", D(2022, 7, 9), 50000.0, 7, None),
            ("m4", None, 0.0, 1, 50.25),
        ],
        "msme_key string, registration_date_id date, annual_income double, employee_number long, loan_amount double",
    )
    t["date_success"] = spark.createDataFrame(
        [(D(2021, 1, 10), 10, 1, 1, 2021), (D(2022, 5, 1), 1, 5, 2, 2022), (D(2022, 7, 9), 9, 7, 3, 2022), (None, None, None, None, None)],
        "registration_date_id date, day_success int, month_success int, quarter_success int, year_success int",
    )
    sales_dates = [D(2024, 1, 31), D(2024, 2, 15), D(2024, 2, 29), D(2024, 3, 1), D(2024, 3, 15), D(2024, 3, 31)]
    t["date_sales"] = spark.createDataFrame(
        [(d, d.day, d.month, (d.month - 1) // 3 + 1, d.year) for d in sales_dates],
        "date_sales_id date, day_sales_reporting int, month_sales_reporting int, quarter_sales_reporting int, year_sales_reporting int",
    )
    t["sales_fact"] = spark.createDataFrame(
        [
            ("s1", "m1", D(2024, 1, 31), 10, "1"),
            ("s2", "m2", D(2024, 2, 15), 20, "0"),
            ("s3", "m1", D(2024, 2, 29), 40, "0"),
            ("s4", "m3", D(2024, 3, 1), 80, "0"),
            ("s5", "m9", D(2024, 3, 15), 160, "0"),
            ("s6", "m2", D(2024, 3, 31), 320, "0"),
        ],
        "sales_key string, msme_key string, date_sales_id date, domestic_sale long, international_sale string",
    )
    job_dates = [D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 10)]
    t["date_job"] = spark.createDataFrame(
        [(d, d.day, d.month, (d.month - 1) // 3 + 1, d.year) for d in job_dates],
        "date_job_id date, day int, month int, quarter int, year int",
    )
    t["job_fact"] = spark.createDataFrame(
        [("j1", "m1", D(2024, 1, 31), 5, 1), ("j2", "m2", D(2024, 2, 29), 3, 0), ("j3", "m3", D(2024, 3, 10), 2, 2)],
        "job_key string, msme_key string, date_job_id date, total_hired_employee long, total_fired_employee long",
    )
    t["hiring"] = spark.createDataFrame(
        [("e1", "j1", 30, "F", 12, "yes", "yes", "yes", "yes"), ("e2", "j1", 31, "M", 6, "no", "yes", "no", "yes"),
         ("e3", "j1", 22, "F", 3, "yes", "no", "yes", "no"), ("e4", "j2", 40, "M", 1, "no", "no", "no", "no")],
        "employee_key string, job_key string, age long, sex string, contract_duration long, is_full_time string, "
        "have_insurance string, thanks_to_project_support string, is_decent_work string",
    )
    t["firing"] = spark.createDataFrame([("l1", "j3", "F", 20)], "lic_key string, job_key string, sex string, age long")
    t["date_activity"] = spark.createDataFrame(
        [(D(2024, 1, 5), 5, 1, 1, 2024), (D(2024, 4, 5), 5, 4, 2, 2024)],
        "activity_date_id date, day_activity int, month_activity int, quarter_activity int, year_activity int",
    )
    t["support_activity"] = spark.createDataFrame(
        [("sup01", "Training"), ("sup02", "Coaching"), (None, "Business legalization")], "support_id string, support_name string"
    )
    t["activity_fact"] = spark.createDataFrame(
        [
            ("a1", D(2024, 1, 5), "sup01", 5, "t", 16, 10),
            ("a2", D(2024, 4, 5), "sup02", 8, "t", 8, 20),
            ("a3", D(2024, 4, 5), "sup09", None, "t", 4, 40),
            ("a4", D(2024, 1, 5), None, None, "t", 24, 80),
        ],
        "activity_id string, activity_date_id date, support_id string, partner_id long, activity_theme string, "
        "activity_duration long, attendance_number long",
    )
    t["participant_updated"] = spark.createDataFrame(
        [("a1", "m1"), ("a1", "m2"), ("a2", "m1"), ("a3", "m3"), ("a9", "m4")], "activity_id string, msme_key string"
    )
    return t


def star_model(spark):
    return build_model(star_tables(spark))
