"""DuckDB SQL for every registered query (the correctness oracle).

The same stand-in bronze tables, cleaning rules, gold tables and model semantics as the Spark
code, written independently as SQL over the shared tables. Casts pin result types so both
engines produce identical schemas: DuckDB sums are HUGEINT, its calendar parts BIGINT, and a
plain cast of a double to an integer rounds where Spark truncates (so ``trunc`` first).
"""

from __future__ import annotations

# Fixed values shared with the Spark side: stand-in years, report slicer selections shifted.
REG_YEARS = "1995, 1996, 1997, 1998, 1999"
SALES_FROM, SALES_TO = "1996-03-30", "1998-10-10"
JOBS_UNTIL = "1998-10-01"


def _mdy(d: str) -> str:
    return f"concat_ws('/', month({d}), day({d}), year({d}))"


def _parse(s: str) -> str:
    return f"CAST(try_strptime({s}, '%m/%d/%Y') AS DATE)"


def _cal(d: str, suffix: str = "") -> str:
    return ", ".join(
        f"CAST({fn}({d}) AS INTEGER) AS {part}{suffix}"
        for fn, part in [("day", "day"), ("month", "month"), ("quarter", "quarter"), ("year", "year")]
    )


BASE = f"""
b_success_spark AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS msme_key,
         c.c_name AS nom_msme,
         CASE c.c_nationkey % 6 WHEN 0 THEN 'ACME' WHEN 1 THEN 'ACME 2' WHEN 2 THEN 'ACME 3'
              WHEN 3 THEN 'AIDE 2' WHEN 4 THEN 'CAPUC 2' WHEN 5 THEN 'CEDEL' END AS partenaire,
         CASE c.c_nationkey % 8 WHEN 0 THEN 'NIPPES' WHEN 1 THEN 'Sud-EST' WHEN 2 THEN 'ARTIBONITE'
              WHEN 3 THEN 'artibonite' WHEN 4 THEN 'Nippes' WHEN 5 THEN NULL ELSE n.n_name END AS departement,
         CASE c.c_custkey % 6 WHEN 0 THEN 'Oui' WHEN 1 THEN 'Non' WHEN 2 THEN 'NON' WHEN 3 THEN 'OUI'
              WHEN 4 THEN NULL WHEN 5 THEN 'yes' END AS institution_financiere,
         CASE c.c_custkey % 5 WHEN 0 THEN 'Oui' WHEN 1 THEN 'Non' WHEN 2 THEN 'OUI' WHEN 3 THEN 'nOn'
              ELSE NULL END AS msme_productive,
         CASE c.c_custkey % 7 WHEN 0 THEN 'Aucun' WHEN 1 THEN 'Association' WHEN 2 THEN 'AVEC'
              WHEN 3 THEN 'BD&SME' WHEN 4 THEN 'MUSO' WHEN 5 THEN 'Solidarite' ELSE NULL END AS group_epargne,
         CASE WHEN c.c_custkey % 13 = 0 THEN NULL
              WHEN c.c_custkey % 17 = 0 THEN 'n/a'
              WHEN c.c_custkey % 19 = 0 THEN ' 30000'
              ELSE CAST(CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) * 10 AS DECIMAL(12,2)) AS VARCHAR) END AS revenu_annuel,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE abs(c.c_acctbal) / CAST(100 AS DOUBLE) END AS nombre_employe,
         CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE CAST(c.c_custkey % 70 AS DOUBLE) + CAST(0.5 AS DOUBLE) END AS age,
         CASE c.c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'f' ELSE 'm' END AS sex,
         CASE WHEN c.c_acctbal < 0 THEN NULL WHEN c.c_acctbal < 3000 THEN 'Micro'
              WHEN c.c_acctbal < 7000 THEN 'Small' ELSE 'Medium' END AS type_msme,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Service' WHEN 'BUILDING' THEN NULL
              WHEN 'FURNITURE' THEN 'AGRIBUSINESS' WHEN 'MACHINERY' THEN 'agribusiness'
              WHEN 'HOUSEHOLD' THEN 'Commerce' END AS secteur_activite,
         CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE abs(c.c_acctbal) * CAST(10 AS DOUBLE) END AS montant_pret,
         CASE WHEN c.c_custkey % 29 = 0 THEN '13/45/2024'
              ELSE {_mdy('CAST(fo.first_order AS DATE)')} END AS date_enregistrement
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) fo
         ON c.c_custkey = fo.o_custkey
),
b_success_job AS (
  SELECT CAST(p.l_orderkey AS VARCHAR) AS job_key,
         CAST(o.o_custkey AS VARCHAR) AS msme_key,
         CASE WHEN p.l_orderkey % 37 = 0 THEN NULL
              WHEN p.l_orderkey % 41 = 0 THEN '13/45/2024'
              ELSE {_mdy('CAST(p.first_ship AS DATE)')} END AS date_collecte,
         p.hired AS nbre_employe_embauche,
         p.fired AS nombre_employe_licencie
  FROM (SELECT l_orderkey,
               CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(trunc(l_quantity) AS BIGINT) END) AS BIGINT) AS hired,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(trunc(l_quantity) AS BIGINT) END) AS BIGINT) AS fired,
               min(l_shipdate) AS first_ship
        FROM lineitem GROUP BY l_orderkey) p
  JOIN orders o ON p.l_orderkey = o.o_orderkey
),
b_success_sales AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sales_key,
         CAST(o_custkey AS VARCHAR) AS msme_key,
         CASE WHEN o_orderkey % 43 = 0 THEN '13/45/2024' ELSE {_mdy('CAST(o_orderdate AS DATE)')} END AS sales_reporting_date,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS domestic_sale,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL
              WHEN o_orderkey % 5 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              ELSE CAST(CAST(trunc(o_totalprice / CAST(10 AS DOUBLE)) AS BIGINT) AS VARCHAR) END AS international_sale
  FROM orders
),
b_participants AS (
  SELECT CAST(event_id AS VARCHAR) AS activity_key, CAST(user_id AS VARCHAR) AS msme_key, event_type AS participation FROM events
),
b_hired AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS employee_key,
         CAST(l_orderkey AS VARCHAR) AS job_key,
         CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'M' END AS sexe,
         'employee ' || concat_ws('-', l_orderkey, l_linenumber) AS nom_employe,
         CAST(18 + l_partkey % 45 AS BIGINT) AS age,
         CAST(CAST(CAST(l_quantity AS DECIMAL(12,2)) / 4 AS DECIMAL(12,2)) AS VARCHAR) AS duree_contrat,
         CASE WHEN l_linestatus = 'O' THEN 'Oui' ELSE 'non' END AS contrat_temps_plein,
         CASE l_suppkey % 4 WHEN 0 THEN 'Oui' WHEN 1 THEN 'Non' WHEN 2 THEN 'oui' ELSE 'non' END AS est_assure,
         CASE l_partkey % 3 WHEN 0 THEN 'Oui' WHEN 1 THEN 'non' ELSE NULL END AS grace_support_meda,
         CASE l_orderkey % 5 WHEN 0 THEN 'oui' WHEN 1 THEN 'Non' WHEN 2 THEN 'OUI' WHEN 3 THEN 'non' ELSE 'Oui' END AS est_decent_work
  FROM lineitem WHERE l_returnflag <> 'R'
),
b_fired AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS lic_key,
         CAST(l_orderkey AS VARCHAR) AS job_key,
         CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'M' END AS sexe,
         'employee ' || concat_ws('-', l_orderkey, l_linenumber) AS nom_employe,
         CAST(CASE l_partkey % 50 WHEN 0 THEN 1518 WHEN 1 THEN 1935 WHEN 2 THEN 3665
                   ELSE 20 + l_suppkey % 40 END AS BIGINT) AS age
  FROM lineitem WHERE l_returnflag = 'R'
),
b_activity AS (
  SELECT CAST(event_id AS VARCHAR) AS activity_key,
         CASE user_id % 12 WHEN 0 THEN 'ccf1' WHEN 1 THEN 'fp1' WHEN 2 THEN 'gec1' WHEN 3 THEN 'ced1'
              WHEN 4 THEN 'cf1' WHEN 5 THEN 'gc1' WHEN 6 THEN 'mc1' WHEN 7 THEN 'sik1' WHEN 8 THEN 'aid1'
              WHEN 9 THEN 'kn1' WHEN 10 THEN 'CCF1' ELSE NULL END AS partner_key,
         CASE event_type WHEN 'view' THEN 'sup01' WHEN 'click' THEN 'sup02' WHEN 'signup' THEN 'sup03'
              WHEN 'purchase' THEN 'sup04' END AS support_type,
         props AS activity_theme,
         {_mdy('CAST(ts AS DATE)')} AS activity_date,
         value AS activity_duration,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS attendance_number
  FROM events
),
s_success_pre AS (
  SELECT msme_key, nom_msme,
         CASE partenaire WHEN 'ACME 2' THEN 'ACME' WHEN 'ACME 3' THEN 'ACME' WHEN 'AIDE 2' THEN 'AIDE'
              WHEN 'CAPOSUD 2' THEN 'CAPOSUD' WHEN 'CAPUC 2' THEN 'CAPUC' WHEN 'CEDEL 2' THEN 'CEDEL'
              ELSE partenaire END AS partenaire,
         departement,
         CASE institution_financiere WHEN 'Oui' THEN 'yes' WHEN 'Non' THEN 'no' ELSE institution_financiere END AS institution_financiere,
         CASE msme_productive WHEN 'Oui' THEN 'yes' WHEN 'Non' THEN 'no' ELSE msme_productive END AS msme_productive,
         CASE group_epargne WHEN 'Aucun' THEN 'No group' WHEN 'Association' THEN 'Association'
              WHEN 'AVEC' THEN 'AVEC group' WHEN 'BD&SME' THEN 'BD&SME' WHEN 'MUSO' THEN 'MUSO'
              WHEN 'Solidarite' THEN 'Solidarity group' ELSE group_epargne END AS group_epargne,
         CASE WHEN regexp_matches(revenu_annuel, '^\\s*[+-]?\\d+(\\.\\d*)?\\s*$')
                   AND TRY_CAST(trim(revenu_annuel) AS DOUBLE) < 25000 THEN '0'
              WHEN revenu_annuel IS NULL THEN '0' ELSE revenu_annuel END AS revenu_annuel,
         CAST(trunc(coalesce(nombre_employe, CAST(1 AS DOUBLE))) AS BIGINT) AS nombre_employe,
         CASE WHEN age IS NULL THEN 18 WHEN age < 18 AND age > 1 THEN 18 ELSE age END AS age,
         sex,
         type_msme,
         CASE WHEN secteur_activite = 'Service' THEN 'Services' WHEN secteur_activite IS NULL THEN 'Services'
              ELSE secteur_activite END AS secteur_activite,
         montant_pret,
         {_parse('date_enregistrement')} AS date_enregistrement
  FROM b_success_spark
),
s_success AS (
  SELECT msme_key, nom_msme AS msme_name, partenaire AS business_partner, departement,
         institution_financiere AS financial_institution, msme_productive, group_epargne AS savings_group,
         revenu_annuel AS annual_income, nombre_employe AS employee_number, age AS business_owner_age,
         sex AS business_owner_sex, type_msme AS msme_category, secteur_activite AS industry,
         montant_pret AS loan_amount, date_enregistrement AS registration_date,
         {_cal('date_enregistrement')}
  FROM s_success_pre
),
s_jobs AS (
  SELECT job_key, msme_key, {_parse('date_collecte')} AS collecting_date,
         coalesce(nbre_employe_embauche, 0) AS total_hired_employee,
         coalesce(nombre_employe_licencie, 0) AS total_fired_employee,
         {_cal(_parse('date_collecte'))}
  FROM b_success_job WHERE date_collecte IS NOT NULL
),
s_sales AS (
  SELECT sales_key, msme_key, {_parse('sales_reporting_date')} AS sales_reporting_date,
         coalesce(domestic_sale, 0) AS domestic_sale,
         coalesce(international_sale, '0') AS international_sale,
         {_cal(_parse('sales_reporting_date'), '_sales_reporting')}
  FROM b_success_sales
),
s_participants AS (
  SELECT activity_key AS activity_id, msme_key, participation FROM b_participants
),
s_hiring AS (
  SELECT employee_key, job_key, sexe AS sex, nom_employe, age,
         CAST(trunc(CAST(duree_contrat AS DECIMAL(38,10))) AS BIGINT) AS contract_duration,
         CASE contrat_temps_plein WHEN 'Oui' THEN 'yes' WHEN 'Non' THEN 'no' WHEN 'oui' THEN 'yes' WHEN 'non' THEN 'no' ELSE contrat_temps_plein END AS is_full_time,
         CASE est_assure WHEN 'Oui' THEN 'yes' WHEN 'Non' THEN 'no' WHEN 'oui' THEN 'yes' WHEN 'non' THEN 'no' ELSE est_assure END AS have_insurance,
         CASE grace_support_meda WHEN 'Oui' THEN 'yes' WHEN 'Non' THEN 'no' WHEN 'oui' THEN 'yes' WHEN 'non' THEN 'no' ELSE grace_support_meda END AS thanks_to_project_support,
         CASE est_decent_work WHEN 'Oui' THEN 'yes' WHEN 'Non' THEN 'no' WHEN 'oui' THEN 'yes' WHEN 'non' THEN 'no' ELSE est_decent_work END AS is_decent_work
  FROM b_hired
),
s_firing AS (
  SELECT lic_key, job_key, sexe AS sex, nom_employe,
         CASE WHEN age = 1518 THEN 17 WHEN age = 1935 THEN 27 WHEN age = 3665 THEN 51 ELSE age END AS age
  FROM b_fired
),
s_activity AS (
  SELECT activity_key AS activity_id, partner_key, support_type, activity_theme,
         {_parse('activity_date')} AS activity_date,
         CAST(trunc(activity_duration) AS BIGINT) AS activity_duration,
         attendance_number,
         {_cal(_parse('activity_date'), '_activity')}
  FROM b_activity WHERE attendance_number IS NOT NULL
),
g_success AS (
  SELECT msme_key, business_partner,
         CASE WHEN departement = 'NIPPES' THEN 'Nippes' WHEN departement = 'Sud-EST' THEN 'Sud-Est'
              WHEN departement IN ('ARTIBONITE', 'artibonite') THEN 'Artibonite' ELSE departement END AS departement,
         CASE WHEN financial_institution = 'NON' THEN 'no' ELSE financial_institution END AS financial_institution,
         CASE WHEN business_owner_sex = 'f' THEN 'F' WHEN business_owner_sex = 'm' THEN 'M' ELSE business_owner_sex END AS business_owner_sex,
         CAST(trunc(business_owner_age) AS BIGINT) AS business_owner_age,
         CASE WHEN msme_productive IS NULL THEN 'no' WHEN lower(msme_productive) = 'oui' THEN 'yes'
              WHEN lower(msme_productive) = 'non' THEN 'no' ELSE msme_productive END AS msme_productive,
         coalesce(msme_category, 'Micro') AS msme_category,
         CASE WHEN lower(industry) = 'agribusiness' THEN 'Agribusiness' ELSE industry END AS industry,
         savings_group,
         CASE WHEN regexp_matches(annual_income, '^-?\\d+(\\.\\d+)?$') THEN TRY_CAST(annual_income AS DECIMAL(10,2)) END AS annual_income,
         employee_number, loan_amount, registration_date, day, month, quarter, year
  FROM s_success
),
success_fact_g AS (
  SELECT msme_key, registration_date AS registration_date_id, annual_income, employee_number, loan_amount FROM g_success
),
success_profile_g AS (
  SELECT msme_key, business_partner, departement, financial_institution, business_owner_sex, business_owner_age,
         msme_productive, msme_category, industry, savings_group
  FROM g_success
),
date_success_g AS (
  SELECT DISTINCT registration_date AS registration_date_id, day AS day_success, month AS month_success,
         quarter AS quarter_success, year AS year_success
  FROM g_success
),
activity_fact_g AS (
  SELECT activity_id, activity_date AS activity_date_id, support_type AS support_id,
         CAST(CASE partner_key WHEN 'ccf1' THEN 5 WHEN 'fp1' THEN 13 WHEN 'gec1' THEN 14 WHEN 'ced1' THEN 6
              WHEN 'cf1' THEN 8 WHEN 'gc1' THEN 15 WHEN 'mc1' THEN 17 WHEN 'sik1' THEN 20 WHEN 'aid1' THEN 2
              WHEN 'kn1' THEN 16 END AS BIGINT) AS partner_id,
         activity_theme, activity_duration, attendance_number
  FROM s_activity
),
date_activity_g AS (
  SELECT DISTINCT activity_date AS activity_date_id, day_activity, month_activity, quarter_activity, year_activity FROM s_activity
),
support_activity_g AS (
  SELECT support_id,
         CASE WHEN support_id = 'sup01' THEN 'Training' WHEN support_id = 'sup02' THEN 'Coaching'
              ELSE 'Business legalization' END AS support_name
  FROM (SELECT DISTINCT support_type AS support_id FROM s_activity) d
),
sales_fact_g AS (
  SELECT sales_key, msme_key, sales_reporting_date AS date_sales_id, domestic_sale, international_sale FROM s_sales
),
date_sales_g AS (
  SELECT DISTINCT sales_reporting_date AS date_sales_id, day_sales_reporting, month_sales_reporting,
         quarter_sales_reporting, year_sales_reporting
  FROM s_sales
),
job_fact_g AS (
  SELECT job_key, msme_key, collecting_date AS date_job_id, total_hired_employee, total_fired_employee FROM s_jobs
),
date_job_g AS (
  SELECT DISTINCT collecting_date AS date_job_id, day, month, quarter, year FROM s_jobs
),
hiring_g AS (
  SELECT employee_key, job_key, age, sex, contract_duration, is_full_time, have_insurance,
         thanks_to_project_support, is_decent_work
  FROM s_hiring
),
firing_g AS (SELECT lic_key, job_key, sex, age FROM s_firing),
participant_g AS (SELECT * FROM s_participants)
"""


def q(body: str, extra_ctes: str = "") -> str:
    ctes = BASE.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


# --- scoped rows under the pages' default contexts -------------------------------------------------

REG_CTX = f"""
reg_dates AS (SELECT registration_date_id FROM date_success_g WHERE year_success IN ({REG_YEARS})),
reg_fact AS (SELECT * FROM success_fact_g WHERE registration_date_id IN (SELECT registration_date_id FROM reg_dates)),
reg_profile AS (SELECT * FROM success_profile_g WHERE msme_key IN (SELECT msme_key FROM reg_fact))
"""

PERF_CTX = f"""
vis_sales AS (SELECT date_sales_id FROM date_sales_g
              WHERE date_sales_id >= DATE '{SALES_FROM}' AND date_sales_id < DATE '{SALES_TO}'),
vis_jobs AS (SELECT date_job_id FROM date_job_g WHERE date_job_id < DATE '{JOBS_UNTIL}'),
perf_sales AS (SELECT * FROM sales_fact_g WHERE date_sales_id IN (SELECT date_sales_id FROM vis_sales)),
perf_jobs AS (SELECT * FROM job_fact_g WHERE date_job_id IN (SELECT date_job_id FROM vis_jobs)),
mtd_sales_dates AS (
  SELECT date_sales_id FROM date_sales_g, (SELECT max(date_sales_id) AS hi FROM vis_sales) b
  WHERE date_sales_id >= date_trunc('month', b.hi) AND date_sales_id <= b.hi),
mtd_job_dates AS (
  SELECT date_job_id FROM date_job_g, (SELECT max(date_job_id) AS hi FROM vis_jobs) b
  WHERE date_job_id >= date_trunc('month', b.hi) AND date_job_id <= b.hi),
prev_sales_dates AS (
  SELECT date_sales_id FROM date_sales_g
  WHERE date_sales_id IN (SELECT CAST(date_sales_id - INTERVAL 1 MONTH AS DATE) FROM vis_sales)
  UNION
  SELECT date_sales_id FROM date_sales_g,
       (SELECT min(date_sales_id) AS lo, max(date_sales_id) AS hi FROM vis_sales) b
  WHERE b.lo = date_trunc('month', b.lo) AND b.hi = last_day(b.hi)
    AND date_sales_id > CAST(b.hi - INTERVAL 1 MONTH AS DATE)
    AND date_sales_id <= last_day(CAST(b.hi - INTERVAL 1 MONTH AS DATE))),
prev_job_dates AS (
  SELECT date_job_id FROM date_job_g
  WHERE date_job_id IN (SELECT CAST(date_job_id - INTERVAL 1 MONTH AS DATE) FROM vis_jobs)
  UNION
  SELECT date_job_id FROM date_job_g,
       (SELECT min(date_job_id) AS lo, max(date_job_id) AS hi FROM vis_jobs) b
  WHERE b.lo = date_trunc('month', b.lo) AND b.hi = last_day(b.hi)
    AND date_job_id > CAST(b.hi - INTERVAL 1 MONTH AS DATE)
    AND date_job_id <= last_day(CAST(b.hi - INTERVAL 1 MONTH AS DATE)))
"""

TOTAL_MSMES = "CAST(NULLIF(count(DISTINCT msme_key), 0) AS BIGINT)"
SUM_BIGINT = "CAST(sum({c}) AS BIGINT)"


def _sum(c: str) -> str:
    return SUM_BIGINT.format(c=c)


PERF_MEASURES = {
    "total_sales": f"(SELECT {_sum('domestic_sale')} FROM perf_sales)",
    "current_month_sales": f"(SELECT {_sum('domestic_sale')} FROM sales_fact_g WHERE date_sales_id IN (SELECT date_sales_id FROM mtd_sales_dates))",
    "last_month_sales": f"(SELECT {_sum('domestic_sale')} FROM sales_fact_g WHERE date_sales_id IN (SELECT date_sales_id FROM prev_sales_dates))",
    "sales_target": f"(SELECT CAST(CAST({_sum('domestic_sale')} AS DECIMAL(38,0)) * 1.05 AS DECIMAL(38,2)) FROM perf_sales)",
    "total_jobs": f"(SELECT {_sum('total_hired_employee')} FROM perf_jobs)",
    "current_month_jobs": f"(SELECT {_sum('total_hired_employee')} FROM job_fact_g WHERE date_job_id IN (SELECT date_job_id FROM mtd_job_dates))",
    "last_month_jobs": f"(SELECT {_sum('total_hired_employee')} FROM job_fact_g WHERE date_job_id IN (SELECT date_job_id FROM prev_job_dates))",
    "jobs_target": f"(SELECT CAST(CAST({_sum('total_hired_employee')} AS DECIMAL(38,0)) * 1.1 AS DECIMAL(38,2)) FROM perf_jobs)",
}

REG_MEASURES = {
    "total_msmes": f"(SELECT {TOTAL_MSMES} FROM reg_profile)",
    "msme_target": f"(SELECT CAST(CAST({TOTAL_MSMES} AS DECIMAL(38,0)) * 1.1 AS DECIMAL(38,2)) FROM reg_profile)",
}

ACT_MEASURES = {
    "total_attendance": f"(SELECT {_sum('attendance_number')} FROM activity_fact_g)",
    "training_days": f"(SELECT CAST({_sum('activity_duration')} AS DOUBLE) / CAST(8 AS DOUBLE) FROM activity_fact_g)",
    "total_loan": "(SELECT CAST(sum(CAST(loan_amount AS DECIMAL(38,6))) AS DOUBLE) FROM success_fact_g)",
    "loan_approved": "(SELECT CAST(NULLIF(count(CASE WHEN lower(financial_institution) = 'yes' THEN 1 END), 0) AS BIGINT) FROM success_profile_g)",
}

ACT_Q1_CTX = """
act_dates AS (SELECT activity_date_id FROM date_activity_g WHERE year_activity = 2024 AND quarter_activity = 1),
act_fact AS (SELECT * FROM activity_fact_g WHERE activity_date_id IN (SELECT activity_date_id FROM act_dates))
"""


def _select(measures: dict[str, str], names: list[str]) -> str:
    return "SELECT " + ", ".join(f"{measures[n]} AS {n}" for n in names)


SQL: dict[str, str] = {}

# --- 2.A ------------------------------------------------------------------------------------------
SQL["scan_layer_table"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem"
SQL["sink_roundtrip"] = q("SELECT * FROM s_sales")
SQL["sink_replace_schema"] = q("SELECT * FROM success_fact_g")
SQL["sink_merge_schema"] = q("SELECT *, CAST(NULL AS BIGINT) AS area_id FROM activity_fact_g")
SQL["sink_two_layers"] = q(
    "SELECT support_id, support_name, 'silver' AS layer FROM support_activity_g "
    "UNION ALL SELECT support_id, support_name, 'gold' AS layer FROM support_activity_g"
)
SQL["copy_table"] = q("SELECT * FROM s_participants")

# --- 2.B / 2.C ----------------------------------------------------------------------------------------
SQL["filter_not_null"] = q("SELECT activity_key, attendance_number FROM b_activity WHERE attendance_number IS NOT NULL")
SQL["clamp_range"] = q(
    "SELECT msme_key, age AS age_raw, CASE WHEN age IS NULL THEN 18 WHEN age < 18 AND age > 1 THEN 18 ELSE age END "
    "AS business_owner_age FROM b_success_spark"
)
SQL["normalize_in_set"] = q(
    "SELECT msme_key, departement AS departement_raw, CASE WHEN departement = 'NIPPES' THEN 'Nippes' "
    "WHEN departement = 'Sud-EST' THEN 'Sud-Est' WHEN departement IN ('ARTIBONITE', 'artibonite') THEN 'Artibonite' "
    "ELSE departement END AS departement FROM s_success"
)
SQL["normalize_case"] = q(
    "SELECT s.msme_key, g.msme_productive, g.industry, g.business_owner_sex "
    "FROM s_success s JOIN g_success g ON s.msme_key = g.msme_key"
)
SQL["decimal_gate"] = q(
    "SELECT s.msme_key, s.annual_income AS annual_income_text, g.annual_income "
    "FROM s_success s JOIN g_success g ON s.msme_key = g.msme_key"
)
SQL["recode_values"] = q(
    "SELECT b.msme_key, b.partenaire AS partner_raw, s.business_partner "
    "FROM b_success_spark b JOIN s_success s ON b.msme_key = s.msme_key"
)
SQL["recode_many"] = q(
    "SELECT employee_key, is_full_time AS contrat_temps_plein, have_insurance AS est_assure, "
    "thanks_to_project_support AS grace_support_meda, is_decent_work AS est_decent_work FROM s_hiring"
)
SQL["fill_null_numeric"] = q(
    "SELECT sales_key, coalesce(domestic_sale, 0) AS domestic_sale, coalesce(international_sale, '0') AS international_sale "
    "FROM b_success_sales"
)
SQL["fill_null_category"] = q("SELECT msme_key, coalesce(msme_category, 'Micro') AS msme_category FROM s_success")
SQL["floor_below_threshold"] = q(
    "SELECT b.msme_key, b.revenu_annuel AS income_raw, s.annual_income "
    "FROM b_success_spark b JOIN s_success s ON b.msme_key = s.msme_key"
)
SQL["repair_values"] = q(
    "SELECT f.lic_key, f.age AS age_raw, CASE WHEN f.age = 1518 THEN 17 WHEN f.age = 1935 THEN 27 "
    "WHEN f.age = 3665 THEN 51 ELSE f.age END AS age FROM b_fired f"
)
SQL["truncate_to_int"] = q("SELECT employee_key, duree_contrat, CAST(trunc(CAST(duree_contrat AS DECIMAL(38,10))) AS BIGINT) AS contract_duration FROM b_hired")
SQL["parse_date"] = q(f"SELECT sales_key, sales_reporting_date, {_parse('sales_reporting_date')} AS sales_date FROM b_success_sales")
SQL["calendar_parts"] = q(
    f"SELECT sales_key, {_parse('sales_reporting_date')} AS sales_date, "
    f"{_cal(_parse('sales_reporting_date'), '_sales_reporting')} FROM b_success_sales"
)
SQL["rename_columns"] = q(
    "SELECT job_key, msme_key, date_collecte AS collecting_date, nbre_employe_embauche AS total_hired_employee, "
    "nombre_employe_licencie AS total_fired_employee FROM b_success_job"
)
SQL["project_columns"] = q("SELECT sales_key, msme_key, sales_reporting_date AS date_sales_id FROM s_sales")
SQL["anonymize"] = q("SELECT * FROM hiring_g")
SQL["drop_column"] = q(
    "SELECT a.activity_id, a.support_type, a.activity_theme, a.activity_date, a.activity_duration, a.attendance_number, "
    "a.day_activity, a.month_activity, a.quarter_activity, a.year_activity, f.partner_id "
    "FROM s_activity a JOIN activity_fact_g f ON a.activity_id = f.activity_id"
)
SQL["map_lookup"] = q(
    "SELECT a.activity_id, a.partner_key, f.partner_id FROM s_activity a JOIN activity_fact_g f ON a.activity_id = f.activity_id"
)
SQL["code_to_label"] = q(
    "SELECT activity_id, support_type, CASE WHEN support_type = 'sup01' THEN 'Training' "
    "WHEN support_type = 'sup02' THEN 'Coaching' ELSE 'Business legalization' END AS support_name FROM s_activity"
)

# --- 2.D ------------------------------------------------------------------------------------------------
SQL["date_dimension"] = q("SELECT * FROM date_sales_g")
SQL["attribute_dimension"] = q("SELECT * FROM support_activity_g")
SQL["profile_dimension"] = q("SELECT * FROM success_profile_g")
SQL["fact_table"] = q("SELECT * FROM success_fact_g")
SQL["surrogate_key"] = q(
    "SELECT sales_key, date_sales_id, row_number() OVER (ORDER BY date_sales_id ASC NULLS FIRST, sales_key ASC) AS sales_sk "
    "FROM sales_fact_g"
)
def _hash_part(column: str) -> str:
    return f"coalesce(length(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


SQL["surrogate_hash_key"] = q(
    "SELECT activity_id, partner_id, support_id, "
    f"sha256({_hash_part('partner_id')} || {_hash_part('support_id')} || {_hash_part('activity_id')}) AS activity_sk FROM activity_fact_g"
)
SQL["jobs_by_hiring_sex"] = q(
    "SELECT s.sex, (SELECT CAST(sum(total_hired_employee) AS BIGINT) FROM job_fact_g j WHERE EXISTS "
    "(SELECT 1 FROM hiring_g h WHERE h.job_key = j.job_key AND h.sex = s.sex)) AS total_jobs "
    "FROM (SELECT DISTINCT sex FROM hiring_g) s "
    "UNION ALL SELECT NULL, CAST(sum(total_hired_employee) AS BIGINT) FROM job_fact_g j "
    "WHERE NOT EXISTS (SELECT 1 FROM hiring_g h WHERE h.job_key = j.job_key) HAVING sum(total_hired_employee) IS NOT NULL"
)
SQL["sales_by_industry_repeated_profile"] = q(
    "SELECT i.industry, (SELECT CAST(sum(domestic_sale) AS BIGINT) FROM sales_fact_g f WHERE EXISTS "
    "(SELECT 1 FROM twice p WHERE p.msme_key = f.msme_key AND p.industry IS NOT DISTINCT FROM i.industry)) AS total_sales "
    "FROM (SELECT DISTINCT industry FROM twice) i "
    "UNION ALL SELECT NULL, CAST(sum(domestic_sale) AS BIGINT) FROM sales_fact_g f "
    "WHERE NOT EXISTS (SELECT 1 FROM twice p WHERE p.msme_key = f.msme_key) HAVING sum(domestic_sale) IS NOT NULL",
    """
twice AS (SELECT msme_key, industry FROM success_profile_g UNION ALL SELECT msme_key, industry FROM success_profile_g
          UNION ALL SELECT msme_key, 'Moved' FROM success_profile_g WHERE CAST(msme_key AS BIGINT) % 3 = 0)
""",
)
SQL["attendance_by_category"] = q(
    "SELECT c.msme_category, (SELECT CAST(sum(attendance_number) AS BIGINT) FROM activity_fact_g) AS total_attendance "
    "FROM (SELECT DISTINCT msme_category FROM success_profile_g) c"
)
SQL["orphan_keys"] = q(
    "SELECT p.* FROM participant_g p WHERE p.activity_id IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM activity_fact_g a WHERE a.activity_id = p.activity_id)"
)
SQL["duplicate_keys"] = q("SELECT job_key, count(*) AS n_rows FROM hiring_g GROUP BY job_key HAVING count(*) > 1")

# --- 2.E ------------------------------------------------------------------------------------------------
SQL["silver_profile"] = q("SELECT * FROM s_success")
SQL["silver_jobs"] = q("SELECT * FROM s_jobs")
SQL["silver_sales"] = q("SELECT * FROM s_sales")
SQL["silver_sales_incremental"] = q("SELECT * FROM s_sales")
SQL["silver_participants"] = q("SELECT * FROM s_participants")
SQL["silver_hiring"] = q("SELECT * FROM s_hiring")
SQL["silver_firing"] = q("SELECT * FROM s_firing")
SQL["silver_activity"] = q("SELECT * FROM s_activity")
SQL["gold_success"] = q("SELECT * FROM date_success_g")
SQL["gold_activity"] = q("SELECT * FROM activity_fact_g")
SQL["gold_date_activity"] = q("SELECT * FROM date_activity_g")
SQL["gold_sales"] = q("SELECT * FROM sales_fact_g")
SQL["gold_jobs"] = q("SELECT * FROM job_fact_g")
SQL["gold_date_job"] = q("SELECT * FROM date_job_g")
SQL["gold_people"] = q("SELECT * FROM firing_g")
SQL["gold_participants"] = q("SELECT * FROM participant_g")

# --- 2.F ------------------------------------------------------------------------------------------------
SQL["filter_propagation"] = q(
    f"SELECT {_sum('domestic_sale')} AS total_sales FROM sales_fact_g "
    "WHERE msme_key IN (SELECT msme_key FROM success_profile_g WHERE msme_category IN ('Micro'))"
)
SQL["filter_transitive"] = q(
    f"SELECT (SELECT {_sum('domestic_sale')} FROM sales_fact_g WHERE msme_key IN (SELECT msme_key FROM p1)) AS total_sales, "
    f"(SELECT {_sum('total_hired_employee')} FROM job_fact_g WHERE msme_key IN (SELECT msme_key FROM p1)) AS total_jobs",
    """
y_dates AS (SELECT registration_date_id FROM date_success_g WHERE year_success IN (1996)),
f1 AS (SELECT msme_key FROM success_fact_g WHERE registration_date_id IN (SELECT registration_date_id FROM y_dates)),
p1 AS (SELECT msme_key FROM success_profile_g WHERE msme_key IN (SELECT msme_key FROM f1))
""",
)
SQL["filter_bidirectional"] = q(
    f"SELECT {TOTAL_MSMES} AS total_msmes FROM success_profile_g "
    "WHERE msme_key IN (SELECT msme_key FROM success_fact_g WHERE annual_income >= 50000)"
)
SQL["filter_blocked"] = q(f"SELECT {_sum('attendance_number')} AS total_attendance FROM activity_fact_g")
SQL["group_by_dimension"] = q(
    f"SELECT s.support_name, {_sum('p.att')} AS total_attendance "
    "FROM (SELECT support_id, sum(attendance_number) AS att FROM act_fact GROUP BY support_id) p "
    "LEFT JOIN support_activity_g s ON p.support_id = s.support_id "
    "GROUP BY s.support_name HAVING sum(p.att) IS NOT NULL",
    ACT_Q1_CTX,
)
SQL["filter_from_people"] = q(
    f"SELECT (SELECT {_sum('total_hired_employee')} FROM job_fact_g WHERE job_key IN "
    "(SELECT job_key FROM hiring_g WHERE is_full_time = 'yes')) AS jobs_with_full_time_hires, "
    f"(SELECT {_sum('total_hired_employee')} FROM job_fact_g WHERE job_key IN "
    "(SELECT job_key FROM firing_g WHERE age < 25)) AS jobs_with_young_dismissals"
)
SQL["participants_by_category"] = q(
    "SELECT m.msme_category, CAST(NULLIF(count(DISTINCT p.msme_key), 0) AS BIGINT) AS businesses "
    "FROM (SELECT DISTINCT msme_key FROM participant_g) p "
    "LEFT JOIN (SELECT msme_key, msme_category FROM success_profile_g) m ON p.msme_key = m.msme_key "
    "GROUP BY m.msme_category HAVING count(DISTINCT p.msme_key) > 0"
)
SQL["bridge_count"] = q(
    "SELECT m.support_name, CAST(NULLIF(count(DISTINCT p.msme_key), 0) AS BIGINT) AS businesses "
    "FROM participant_g p LEFT JOIN (SELECT a.activity_id, s.support_name FROM activity_fact_g a "
    "JOIN support_activity_g s ON a.support_id = s.support_id) m ON p.activity_id = m.activity_id "
    "GROUP BY m.support_name HAVING count(DISTINCT p.msme_key) > 0"
)

# --- 2.G ------------------------------------------------------------------------------------------------
for _key, _names in {
    "total_jobs": ["total_jobs"],
    "total_sales": ["total_sales"],
    "mtd_sales": ["current_month_sales"],
    "prev_month_sales": ["last_month_sales"],
    "target_sales": ["sales_target"],
    "target_jobs": ["jobs_target"],
    "mtd_jobs": ["current_month_jobs"],
    "prev_month_jobs": ["last_month_jobs"],
    "gauge_sales": ["total_sales", "sales_target"],
    "gauge_jobs": ["total_jobs", "jobs_target"],
    "page_performance": list(PERF_MEASURES),
}.items():
    SQL[_key] = q(_select(PERF_MEASURES, _names), PERF_CTX)

ALL_REG_MEASURES = {
    "total_msmes": f"(SELECT {TOTAL_MSMES} FROM success_profile_g)",
    "msme_target": f"(SELECT CAST(CAST({TOTAL_MSMES} AS DECIMAL(38,0)) * 1.1 AS DECIMAL(38,2)) FROM success_profile_g)",
}
for _key, _names in {
    "total_entities": ["total_msmes"],
    "target_entities": ["msme_target"],
    "gauge_entities": ["total_msmes", "msme_target"],
    "page_registration": ["total_msmes", "msme_target"],
}.items():
    SQL[_key] = q(_select(ALL_REG_MEASURES, _names))
SQL["page_registration_cross_filter"] = q(
    f"SELECT {TOTAL_MSMES} AS total_msmes, CAST(CAST({TOTAL_MSMES} AS DECIMAL(38,0)) * 1.1 AS DECIMAL(38,2)) AS msme_target "
    "FROM success_profile_g WHERE industry = 'Agribusiness'"
)
SQL["page_registration_by_year"] = q(_select(REG_MEASURES, ["total_msmes", "msme_target"]), REG_CTX)

for _key, _names in {
    "total_loan": ["total_loan"],
    "total_attendance": ["total_attendance"],
    "training_days": ["training_days"],
    "count_where": ["loan_approved"],
}.items():
    SQL[_key] = q(_select(ACT_MEASURES, _names))

SQL["page_activity"] = q(_select(ACT_MEASURES, ["total_attendance", "training_days", "total_loan", "loan_approved"]))
SQL["page_activity_q1"] = q(
    _select(
        {
            **ACT_MEASURES,
            "total_attendance": f"(SELECT {_sum('attendance_number')} FROM act_fact)",
            "training_days": f"(SELECT CAST({_sum('activity_duration')} AS DOUBLE) / CAST(8 AS DOUBLE) FROM act_fact)",
        },
        ["total_attendance", "training_days", "total_loan", "loan_approved"],
    ),
    ACT_Q1_CTX,
)
SQL["sales_channels"] = q(
    "SELECT d AS total_sales, i AS total_international_sales, "
    "CAST(CASE WHEN d IS NULL AND i IS NULL THEN NULL ELSE coalesce(d, 0) + coalesce(i, 0) END AS DECIMAL(38,10)) AS total_sales_all_channels "
    f"FROM (SELECT {_sum('domestic_sale')} AS d, sum(CAST(international_sale AS DECIMAL(38,10))) AS i FROM perf_sales) t",
    PERF_CTX,
)
SQL["jobs_net"] = q(
    "SELECT h AS total_jobs, f AS total_fired, "
    "CAST(CASE WHEN h IS NULL AND f IS NULL THEN NULL ELSE coalesce(h, 0) - coalesce(f, 0) END AS BIGINT) AS net_jobs "
    f"FROM (SELECT {_sum('total_hired_employee')} AS h, {_sum('total_fired_employee')} AS f FROM perf_jobs) t",
    PERF_CTX,
)
SQL["default_aggregates"] = q(
    f"SELECT support_id, {_sum('activity_duration')} AS sum_activity_duration, "
    f"{_sum('attendance_number')} AS sum_attendance_number FROM activity_fact_g GROUP BY support_id"
)
SQL["calculate_override"] = q(
    "SELECT (SELECT CAST(NULLIF(count(CASE WHEN lower(financial_institution) = 'yes' THEN 1 END), 0) AS BIGINT) "
    "FROM success_profile_g WHERE msme_category IN ('Micro', 'Small')) AS loan_approved, "
    f"(SELECT {TOTAL_MSMES} FROM success_profile_g WHERE financial_institution = 'no' "
    "AND msme_category IN ('Micro', 'Small')) AS total_msmes"
)


def _fmt_thousands(v: str) -> str:
    body = f"'$' || format('{{:,.0f}}', round(abs(CAST({v} AS DECIMAL(38,6)) / 1000), 0)) || 'K'"
    return (
        f"CASE WHEN {v} IS NULL THEN NULL "
        f"WHEN round(CAST({v} AS DECIMAL(38,6)) / 1000, 0) < 0 THEN '(' || {body} || ')' ELSE {body} END"
    )


SQL["format_kpi"] = q(
    "SELECT year_sales_reporting, total_sales, "
    f"{_fmt_thousands('total_sales')} AS total_sales_text, "
    "CAST(total_sales AS VARCHAR) AS total_sales_int FROM ("
    f"SELECT d.year_sales_reporting, {_sum('p.s')} AS total_sales "
    "FROM (SELECT date_sales_id, sum(domestic_sale) AS s FROM sales_fact_g GROUP BY date_sales_id) p "
    "LEFT JOIN date_sales_g d ON p.date_sales_id = d.date_sales_id "
    "GROUP BY d.year_sales_reporting HAVING sum(p.s) IS NOT NULL) t"
)

# --- 2.H ------------------------------------------------------------------------------------------------
_TREND = (
    f"SELECT m.registration_date_id, {TOTAL_MSMES.replace('msme_key', 'p.msme_key')} AS total_msmes "
    "FROM {profile} p LEFT JOIN (SELECT f.msme_key, d.registration_date_id FROM success_fact_g f "
    "JOIN {dates} d ON f.registration_date_id = d.registration_date_id) m ON p.msme_key = m.msme_key "
    "GROUP BY m.registration_date_id HAVING count(DISTINCT p.msme_key) > 0"
)
SQL["trend_entities"] = q(_TREND.format(profile="success_profile_g", dates="date_success_g"))
SQL["trend_entities_by_year"] = q(_TREND.format(profile="reg_profile", dates="reg_dates"), REG_CTX)
SQL["share_by_category"] = q(
    "SELECT industry, total_msmes, CAST(total_msmes AS DOUBLE) / CAST(sum(total_msmes) OVER () AS DOUBLE) AS share FROM ("
    f"SELECT industry, {TOTAL_MSMES} AS total_msmes FROM success_profile_g GROUP BY industry "
    "HAVING count(DISTINCT msme_key) > 0) t"
)
_LOAN_BY = (
    "SELECT m.industry, CAST(sum(p.s) AS DOUBLE) AS total_loan "
    "FROM (SELECT msme_key, sum(CAST(loan_amount AS DECIMAL(38,6))) AS s FROM {fact} GROUP BY msme_key) p "
    "LEFT JOIN (SELECT msme_key, industry FROM success_profile_g) m ON p.msme_key = m.msme_key "
    "GROUP BY m.industry HAVING sum(p.s) IS NOT NULL"
)
SQL["loan_by_category"] = q(_LOAN_BY.format(fact="success_fact_g"))
SQL["filter_exception"] = q(
    _LOAN_BY.format(fact="exc_fact"),
    """
exc_dates AS (SELECT registration_date_id FROM date_success_g
              WHERE (year_success = 1996) OR (year_success = 1997 AND quarter_success = 2)),
exc_fact AS (SELECT * FROM success_fact_g WHERE registration_date_id IN (SELECT registration_date_id FROM exc_dates))
""",
)

# --- 2.I ------------------------------------------------------------------------------------------------
SQL["slicer_values"] = q("SELECT DISTINCT msme_category FROM success_profile_g WHERE msme_category IS NOT NULL")
SQL["slicer_values_departement"] = q("SELECT DISTINCT departement FROM success_profile_g WHERE departement IS NOT NULL")
SQL["slicer_in_list"] = q(f"SELECT DISTINCT year_success FROM date_success_g WHERE year_success IN ({REG_YEARS})")
SQL["slicer_hierarchy"] = q(
    "SELECT DISTINCT year_success, quarter_success FROM date_success_g WHERE year_success IS NOT NULL"
)
SQL["slicer_between"] = q(
    "SELECT (SELECT count(*) FROM vis_sales) AS days, " + PERF_MEASURES["total_sales"] + " AS total_sales", PERF_CTX
)
SQL["slicer_until"] = q(
    "SELECT (SELECT count(*) FROM vis_jobs) AS days, " + PERF_MEASURES["total_jobs"] + " AS total_jobs", PERF_CTX
)
SQL["filter_context"] = q(
    "SELECT (SELECT CAST(sum(domestic_sale) AS BIGINT) FROM perf_sales WHERE msme_key IN (SELECT msme_key FROM micro)) AS total_sales, "
    "(SELECT CAST(sum(total_hired_employee) AS BIGINT) FROM perf_jobs WHERE msme_key IN (SELECT msme_key FROM micro)) AS total_jobs",
    PERF_CTX + ",\nmicro AS (SELECT msme_key FROM success_profile_g WHERE msme_category IN ('Micro'))",
)


_NN = {
    "success_fact_g": ("success_fact", ["msme_key"]),
    "success_profile_g": ("success_profile", ["msme_key"]),
    "activity_fact_g": ("activity_fact", ["activity_id"]),
    "support_activity_g": ("support_activity", ["support_id"]),
    "date_success_g": ("date_success", ["registration_date_id"]),
    "date_activity_g": ("date_activity", ["activity_date_id"]),
    "date_sales_g": ("date_sales", ["date_sales_id"]),
    "date_job_g": ("date_job", ["date_job_id"]),
    "hiring_g": ("hiring", ["job_key"]),
    "firing_g": ("firing", ["job_key"]),
}
SQL["not_null_check"] = q(
    "SELECT "
    + ", ".join(
        f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {cte}) AS {t}__{c}" for cte, (t, cols) in _NN.items() for c in cols
    )
)
SQL["format_dates"] = q("SELECT date_job_id, strftime(date_job_id, '%-m/%-d/%Y') AS date_job_text FROM date_job_g")


def _fmt(v: str, kind: str) -> str:
    """SQL twin of the display formats (integer, currency0, currency), built from exact integer
    and fraction parts (DuckDB's format() would pass a DECIMAL through a double)."""
    dec = f"CAST({v} AS DECIMAL(38,6))"
    if kind == "integer":
        body = f"CAST(CAST(round(abs({dec}), 0) AS BIGINT) AS VARCHAR)"
        return f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} < 0 THEN '-' || {body} ELSE {body} END"
    places = 0 if kind == "currency0" else 6
    r = f"round(abs({dec}), {places})"
    digits = f"format('{{:,}}', CAST(trunc({r}) AS BIGINT))"
    if kind == "currency":
        frac = f"CAST(({r} - trunc({r})) * 1000000 AS BIGINT)"
        digits = f"{digits} || CASE WHEN {frac} = 0 THEN '' ELSE '.' || rtrim(lpad(CAST({frac} AS VARCHAR), 6, '0'), '0') END"
    body = f"'$' || {digits}"
    return f"CASE WHEN {v} IS NULL THEN NULL WHEN round({dec}, {places}) < 0 THEN '(' || {body} || ')' ELSE {body} END"


_FORMATS = {
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


def _text_of(key: str) -> str:
    """Wrap a one-row page query so every card is shown in its display format."""
    sql = SQL[key]
    head, _, body = sql.rpartition("\nSELECT ")
    inner = "SELECT " + body
    cols = [c.strip().split(" AS ")[-1] for c in _split_top(body)]
    outer = ", ".join(f"{_fmt(c, _FORMATS[c])} AS {c}" for c in cols)
    return f"{head}\nSELECT {outer} FROM ({inner}) page_row"


def _split_top(select_list: str) -> list[str]:
    out, depth, cur = [], 0, []
    for ch in select_list:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    out.append("".join(cur))
    return out


_MICRO = "msme_key IN (SELECT msme_key FROM success_profile_g WHERE msme_category IN ('Micro'))"
_PERF_MICRO = {
    k: (v[:-1] + (" AND " if " WHERE " in v else " WHERE ") + _MICRO + ")") for k, v in PERF_MEASURES.items()
}
SQL["page_performance_micro"] = q(_select(_PERF_MICRO, list(PERF_MEASURES)), PERF_CTX)
SQL["page_performance_text"] = _text_of("page_performance")
SQL["page_activity_text"] = _text_of("page_activity")


# --- durable keys, roll-ups, pages with charts, counters of a write -----------------------------------
SQL["durable_key"] = q(
    "SELECT msme_key, CAST(row_number() OVER (ORDER BY load, msme_key NULLS FIRST) AS BIGINT) AS msme_sk, load FROM ("
    "SELECT msme_key, CAST(min(load) AS INTEGER) AS load FROM (SELECT msme_key, 1 AS load FROM sales_fact_g "
    "UNION ALL SELECT msme_key, 2 FROM participant_g UNION ALL SELECT msme_key, 3 FROM success_profile_g) a GROUP BY msme_key) b"
)
_ROLLED = "(SELECT p.msme_key, p.industry, p.msme_category, year(f.registration_date_id) AS y FROM success_profile_g p LEFT JOIN success_fact_g f ON p.msme_key = f.msme_key)"
SQL["distinct_rollup"] = q(
    f"SELECT 'total' AS axis, CAST(NULL AS VARCHAR) AS member, count(DISTINCT msme_key) AS total_msmes FROM {_ROLLED} r "
    + " ".join(
        f"UNION ALL SELECT '{axis}', CAST({column} AS VARCHAR), count(DISTINCT msme_key) FROM {_ROLLED} r GROUP BY {column}"
        for axis, column in [("industry", "industry"), ("msme_category", "msme_category"), ("registration_year", "y")]
    )
)
_TARGET = f"CAST(CAST({TOTAL_MSMES} AS DECIMAL(38,0)) * 1.1 AS DECIMAL(38,2))"


def _registration_visuals(profile: str, dates: str) -> str:
    return (
        f"SELECT 'cards' AS visual, CAST(NULL AS DATE) AS registration_date_id, CAST(NULL AS VARCHAR) AS industry, {TOTAL_MSMES} AS total_msmes, {_TARGET} AS msme_target "
        f"FROM {profile} UNION ALL SELECT 'trend', registration_date_id, NULL, total_msmes, NULL FROM ({_TREND.format(profile=profile, dates=dates)}) t "
        f"UNION ALL SELECT 'share', NULL, industry, {TOTAL_MSMES}, NULL FROM {profile} GROUP BY industry HAVING count(DISTINCT msme_key) > 0"
    )


SQL["page_registration_visuals"] = q(_registration_visuals("success_profile_g", "date_success_g"))
SQL["page_registration_visuals_by_year"] = q(_registration_visuals("reg_profile", "reg_dates"), REG_CTX)
SQL["page_activity_visuals"] = q(
    f"SELECT 'cards' AS visual, CAST(NULL AS VARCHAR) AS industry, CAST(NULL AS VARCHAR) AS support_name, (SELECT {_sum('attendance_number')} FROM act_fact) AS total_attendance, "
    f"(SELECT CAST({_sum('activity_duration')} AS DOUBLE) / CAST(8 AS DOUBLE) FROM act_fact) AS training_days, "
    f"{ACT_MEASURES['total_loan']} AS total_loan, {ACT_MEASURES['loan_approved']} AS loan_approved "
    f"UNION ALL SELECT 'loan', industry, NULL, NULL, NULL, total_loan, NULL FROM ({_LOAN_BY.format(fact='success_fact_g')}) l "
    f"UNION ALL SELECT 'attendance', NULL, s.support_name, {_sum('a.attendance_number')}, NULL, NULL, NULL FROM act_fact a "
    "LEFT JOIN support_activity_g s ON a.support_id = s.support_id GROUP BY s.support_name HAVING sum(a.attendance_number) IS NOT NULL",
    ACT_Q1_CTX,
)


def _months_by(column: str, total: str, dates: dict[str, str]) -> str:
    def by(name: str, where: str) -> str:
        return (
            f"SELECT m.{column}, '{name}' AS measure, {_sum('f.domestic_sale')} AS v FROM sales_fact_g f "
            f"LEFT JOIN success_profile_g m ON f.msme_key = m.msme_key WHERE {where} GROUP BY m.{column}"
        )

    parts = [by("total_sales", total)] + [by(name, f"f.date_sales_id IN (SELECT date_sales_id FROM {d})") for name, d in dates.items()]
    measures = ", ".join(f"max(CASE WHEN measure = '{n}' THEN v END) AS {n}" for n in ["total_sales", *dates])
    return f"SELECT {column}, {measures} FROM ({' UNION ALL '.join(parts)}) t GROUP BY {column} HAVING count(v) > 0"


_MONTHS = {"current_month_sales": "mtd_sales_dates", "last_month_sales": "prev_sales_dates"}
SQL["sales_months_by_industry"] = q(_months_by("industry", "f.date_sales_id IN (SELECT date_sales_id FROM vis_sales)", _MONTHS), PERF_CTX)
SQL["sales_months_by_category_unfiltered"] = q(
    _months_by("msme_category", "TRUE", _MONTHS),
    PERF_CTX.replace(f"WHERE date_sales_id >= DATE '{SALES_FROM}' AND date_sales_id < DATE '{SALES_TO}'", ""),
)
SQL["sink_versioned"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
SQL["sink_merge_nested"] = (
    "SELECT o_orderkey, o_custkey AS customer, CAST(NULL AS VARCHAR) AS status, o_orderpriority AS priority, "
    "CAST(NULL AS VARCHAR) AS first_status, o_orderpriority AS first_priority, 2 AS n FROM orders"
)
SQL["highlight_loans"] = q(
    "SELECT l.industry, total_loan, total_loan_highlighted, total_msmes, total_msmes_highlighted FROM ("
    "SELECT p.industry, CAST(sum(CAST(f.loan_amount AS DECIMAL(38,6))) AS DOUBLE) AS total_loan, "
    "CAST(sum(CASE WHEN p.msme_category = 'Micro' THEN CAST(f.loan_amount AS DECIMAL(38,6)) END) AS DOUBLE) AS total_loan_highlighted "
    "FROM success_fact_g f LEFT JOIN success_profile_g p ON f.msme_key = p.msme_key GROUP BY p.industry) l "
    f"JOIN (SELECT industry, {TOTAL_MSMES} AS total_msmes, "
    "CAST(NULLIF(count(DISTINCT CASE WHEN msme_category = 'Micro' THEN msme_key END), 0) AS BIGINT) AS total_msmes_highlighted "
    "FROM success_profile_g GROUP BY industry) b ON l.industry IS NOT DISTINCT FROM b.industry"
)
SQL["table_lookup"] = q(
    "SELECT c.c_custkey, c.c_nationkey, coalesce(n.n_name, 'unknown') AS n_name, s.s_suppkey, s.s_name FROM customer c "
    "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN (SELECT s_nationkey, s_suppkey, s_name, "
    "row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS r FROM supplier) s ON c.c_nationkey = s.s_nationkey AND s.r = 1"
)


def _quality(table: str, source: str, kept: str = "TRUE", text_date: str | None = None) -> str:
    nulled = f"count(CASE WHEN {kept} AND {text_date} IS NOT NULL AND {_parse(text_date)} IS NULL THEN 1 END)" if text_date else "0"
    return (
        f"SELECT '{table}' AS table_name, count(*) AS rows_in, count(CASE WHEN {kept} THEN 1 END) AS rows_out, "
        f"count(CASE WHEN NOT ({kept}) THEN 1 END) AS rows_dropped, CAST({nulled} AS BIGINT) AS values_nulled FROM {source}"
    )


SQL["write_quality"] = q(
    " UNION ALL ".join(
        [
            _quality("success_updated", "b_success_spark", "TRUE", "date_enregistrement"),
            _quality("job_updated", "b_success_job", "date_collecte IS NOT NULL", "date_collecte"),
            _quality("sales_updated", "b_success_sales", "TRUE", "sales_reporting_date"),
            _quality("participant_updated", "b_participants"),
            _quality("hiring_updated", "b_hired"),
            _quality("firing_updated", "b_fired"),
            _quality("activity_updated", "b_activity", "attendance_number IS NOT NULL", "activity_date"),
        ]
    )
)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


__all__ = ["SQL", "oracle_sql"]

SQL["sales_by_industry"] = q(
    "SELECT m.industry, CAST(sum(p.s) AS BIGINT) AS total_sales "
    "FROM (SELECT msme_key, sum(domestic_sale) AS s FROM perf_sales GROUP BY msme_key) p "
    "LEFT JOIN (SELECT msme_key, industry FROM success_profile_g) m ON p.msme_key = m.msme_key "
    "GROUP BY m.industry HAVING sum(p.s) IS NOT NULL",
    PERF_CTX,
)
