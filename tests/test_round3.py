"""Durable keys, period pruning, pages in one pass, bitmap roll-ups, observed counters."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from star_fixture import star_model

from kpi_lake.operators import context as C
from kpi_lake.operators.keymap import KeyMap
from kpi_lake.operators.measures import Measure, evaluate, evaluate_by
from kpi_lake.operators.quality import QualityCounters
from kpi_lake.operators.rollup import distinct_count, distinct_rollup, merge_rollups
from kpi_lake.operators.visuals import Visual, evaluate_visuals
from kpi_lake.plans import dashboard as Dsh
from kpi_lake.plans.catalog import gold_model, saved_performance_context, standin_years
from kpi_lake.plans.pipelines import entity_keys, run_all, run_silver_to_gold
from kpi_lake.plans.semantic import CATALOG
from kpi_lake.sources.layers import Lake, read_table, write_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    made = Lake(root=str(tmp_path_factory.mktemp("round3")))
    made_report = run_all(spark, SF, made, durable_keys=True)
    return made, made_report


# --- durable keys ---------------------------------------------------------------------------------------


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b long")


def test_keys_stay_over_refreshes(spark, tmp_path):
    keys = KeyMap(Lake(root=str(tmp_path)), "gold", "keys", ("a", "b"))
    first = {(r.a, r.b): r.sk for r in keys.refresh(frame(spark, [("x", 1), ("x", None), (None, None), ("", 1), ("x", 1)])).collect()}
    assert sorted(first.values()) == [1, 2, 3, 4]
    second = {(r.a, r.b): (r.sk, r.load) for r in keys.refresh(frame(spark, [("x", 1), ("w", 9), ("a", 2)])).collect()}
    assert {k: v for k, (v, load) in second.items() if load == 1} == first  # removed rows keep theirs
    assert sorted(v for v in second.values() if v[1] == 2) == [(5, 2), (6, 2)]
    third = {(r.a, r.b): r.sk for r in keys.refresh(frame(spark, [("x", None), ("", 1)]), frame(spark, [("a", 2)])).collect()}
    assert third == {k: v for k, (v, _) in second.items()}  # nothing new: nothing written
    empty = keys.refresh(frame(spark, []))
    assert empty.count() == 6
    got = {(r.p, r.q): r.sk for r in keys.apply(frame(spark, [("x", None), (None, None), ("new", 0)]).toDF("p", "q"), empty, ["p", "q"]).collect()}
    assert got == {("x", None): first["x", None], (None, None): first[None, None], ("new", 0): None}


def test_an_empty_first_refresh(spark, tmp_path):
    keys = KeyMap(Lake(root=str(tmp_path)), "gold", "keys", ("a", "b"))
    assert keys.refresh(frame(spark, [])).count() == 0
    assert [(r.sk, r.load) for r in keys.refresh(frame(spark, [("x", 1)])).collect()] == [(1, 1)]


def test_a_cut_off_commit_gives_no_key_twice(spark, tmp_path):
    """Some files of an append were committed: their keys stay, the rest is numbered after them."""
    made = Lake(root=str(tmp_path))
    keys = KeyMap(made, "gold", "keys", ("a", "b"))
    keys.refresh(frame(spark, [("x", i) for i in range(5)]))
    full = KeyMap(Lake(root=str(tmp_path / "other")), "gold", "keys", ("a", "b"))
    full.refresh(frame(spark, [("x", i) for i in range(5)]))
    later = full.refresh(frame(spark, [("x", i) for i in range(20)])).where("load = 2 and sk % 2 = 0")
    write_table(later, made, "gold", "keys", mode="append")
    got = keys.refresh(frame(spark, [("x", i) for i in range(20)])).collect()
    assert len({r.sk for r in got}) == len({r.b for r in got}) == len(got) == 20
    kept = {r.b: r.sk for r in later.collect()}
    assert {r.b: r.sk for r in got if r.b in kept} == kept


def test_stored_facts_keep_their_keys(spark, lake, tmp_path):
    made, _ = lake
    before = {r.sales_key: r.msme_sk for r in read_table(spark, made, "gold", "sales_fact").collect()}
    profile = {r.msme_key: r.msme_sk for r in read_table(spark, made, "gold", "success_profile").collect()}
    assert None not in before.values() and len(set(profile.values())) == len(profile)
    copy = Lake(root=str(tmp_path))
    for t in ("success_updated", "job_updated", "sales_updated", "participant_updated", "hiring_updated", "firing_updated", "activity_updated"):
        df = read_table(spark, made, "silver", t)
        if t == "sales_updated":  # every second sale goes, and a business comes that sorts before all others
            first = df.limit(1).select(*[F.lit("!new").alias(c) if c in ("sales_key", "msme_key") else F.col(c) for c in df.columns])
            df = df.where("cast(sales_key as int) % 2 = 0").unionByName(first)
        write_table(df, copy, "silver", t)
    write_table(read_table(spark, made, "gold", "msme_keys"), copy, "gold", "msme_keys", mode="append")
    run_silver_to_gold(spark, copy, durable_keys=True)
    after = {r.sales_key: (r.msme_key, r.msme_sk) for r in read_table(spark, copy, "gold", "sales_fact").collect()}
    assert after["!new"][1] > max(before.values())
    assert all(before[k] == sk for k, (_, sk) in after.items() if k in before) and len(after) < len(before)
    assert entity_keys(copy).read(spark).groupBy("msme_sk").count().where("count > 1").count() == 0


# --- periods as ranges ----------------------------------------------------------------------------------


def test_periods_become_merged_ranges():
    d = dt.date
    assert C.period_ranges([(2024, 2), (2024, 1), (2023,)]) == ((d(2023, 1, 1), d(2024, 7, 1)),)
    assert C.period_ranges([(2024, 4), (2024, 2), (2024, 2, 5)]) == ((d(2024, 4, 1), d(2024, 7, 1)), (d(2024, 10, 1), d(2025, 1, 1)))
    assert C.period_ranges([]) is None and C.period_ranges([(2024, 5)]) is None and C.period_ranges([(2024, 1, 4)]) is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.tuples(st.integers(2019, 2022)), st.tuples(st.integers(2019, 2022), st.integers(1, 4))), min_size=1, max_size=6), st.dates(dt.date(2018, 1, 1), dt.date(2023, 12, 31)))
def test_ranges_hold_just_the_selected_days(selection, day):
    ranges = C.period_ranges(selection)
    picked = any(m == (day.year, (day.month - 1) // 3 + 1)[: len(m)] for m in selection)
    assert picked == any(a <= day < b for a, b in ranges)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_key_ranges_are_intersected(spark):
    d = dt.date
    ctx = C.EMPTY.where_periods("t", "day", ["y", "q"], [(2024, 1), (2024, 3)]).where_range("t", "day", "2024-02-01", "2024-08-01")
    assert ctx.key_ranges("t", "day") == [(d(2024, 2, 1), d(2024, 4, 1)), (d(2024, 7, 1), d(2024, 8, 1))]
    assert ctx.key_bounds("t", "day") == (d(2024, 2, 1), d(2024, 8, 1))
    assert ctx.where_range("t", "day", "2025-01-01", None).key_ranges("t", "day") == []
    assert C.EMPTY.where_range("t", "day", None, "2024-01-01").key_ranges("t", "day") == [(None, d(2024, 1, 1))]
    assert C.EMPTY.key_ranges("t", "day") is None


def final_plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 2000)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # initial plans are what AQE started from; reused exchanges are listed once where they run
    return re.sub(r"\+- == Initial Plan ==.*?(?=\n\S|\Z)", "", text, flags=re.S)


def test_period_selections_reach_the_fact_scan(spark, lake):
    model = gold_model(spark, lake[0])
    ctx = Dsh.activity_context(activity_period=[(2024, 1), (2024, 3), (2024, 4)])
    plan = final_plan(evaluate(model, ctx, ["total_attendance"], CATALOG))
    assert "GreaterThanOrEqual(activity_date_id,2024-01-01),LessThan(activity_date_id,2024-04-01)" in plan
    assert "GreaterThanOrEqual(activity_date_id,2024-07-01),LessThan(activity_date_id,2025-01-01)" in plan
    assert "LeftSemi" in plan
    fact = read_table(spark, lake[0], "gold", "activity_fact")
    want = fact.where("year(activity_date_id) = 2024 and quarter(activity_date_id) in (1, 3, 4)").agg(F.sum("attendance_number")).first()[0]
    assert evaluate(model, ctx, ["total_attendance"], CATALOG).first()[0] == want
    years = final_plan(evaluate(model, Dsh.registration_context(years=standin_years()), ["total_msmes"], CATALOG))
    assert "GreaterThanOrEqual(registration_date_id,1995-01-01), LessThan(registration_date_id,2000-01-01)" in years


def test_nothing_left_is_blank(spark, lake):
    ctx = saved_performance_context().where_periods("date_sales", "date_sales_id", ["year_sales_reporting"], [(1990,)])
    row = evaluate(gold_model(spark, lake[0]), ctx, ["total_sales", "current_month_sales", "last_month_sales"], CATALOG).first()
    assert tuple(row) == (None, None, None)


# --- a page in one pass ---------------------------------------------------------------------------------

def contexts():
    return [
        C.EMPTY,
        Dsh.registration_context(years=[2022]),
        Dsh.registration_context(years=[1990]),
        Dsh.activity_context(activity_period=[(2024, 2)], categories=["Micro"]),
        C.EMPTY.where("support_activity", C.in_list("support_name", ["Training"]), "support_name"),
        Dsh.cross_filter(C.EMPTY, "success_profile", "industry", "Services"),
    ]


@pytest.mark.parametrize("number", range(6))
def test_visuals_equal_single_queries(spark, number):
    model, ctx = star_model(spark), contexts()[number]
    visuals = [
        *[Visual(f"reg {v.name}", v.measures, v.group_table, v.group_cols, v.exempt) for v in Dsh.PAGE_VISUALS["registration"]],
        *[Visual(f"act {v.name}", v.measures, v.group_table, v.group_cols, v.exempt) for v in Dsh.PAGE_VISUALS["activity"]],
        Visual("jobs and sales", ("total_jobs", "total_sales", "jobs_target"), "success_profile", ("industry", "msme_category")),
        Visual("jobs by hire", ("total_jobs",), "hiring", ("sex",)),
    ]
    got = evaluate_visuals(model, ctx, visuals, CATALOG).collect()
    names = {("hiring", "sex"): "sex"}
    for v in visuals:
        rows = [r for r in got if r.visual == v.name]
        own = ctx.without(*v.exempt)
        if v.group_table is None:
            assert [tuple(r[m] for m in v.measures) for r in rows] == [tuple(evaluate(model, own, list(v.measures), CATALOG).first())]
            continue
        cols = [names.get((v.group_table, c), c) for c in v.group_cols]
        want = evaluate_by(model, own, v.group_table, list(v.group_cols), list(v.measures), CATALOG).collect()
        assert sorted((tuple(r[c] for c in [*cols, *v.measures]) for r in rows), key=repr) == sorted((tuple(r) for r in want), key=repr)


def test_each_table_is_scanned_once(spark, lake):
    model = gold_model(spark, lake[0])
    plan = final_plan(Dsh.page_visuals(model, Dsh.registration_context(), "registration"))
    scans = re.findall(r"FileScan parquet .*?/gold/(\w+)\]", plan)
    assert scans.count("success_profile") == 1, plan
    plan = final_plan(Dsh.page_visuals(model, Dsh.activity_context(), "activity"))
    scans = re.findall(r"FileScan parquet .*?/gold/(\w+)\]", plan)
    assert scans.count("activity_fact") == 1 and scans.count("success_fact") == 1, plan


def test_a_hot_member_and_a_hot_key(spark):
    """A third of the rows has one key; sums and distinct counts are those of plain code."""
    rng = random.Random(4)
    rows = [(f"m{0 if rng.random() < 0.34 else rng.randrange(200)}", rng.randrange(50)) for _ in range(5000)]
    from kpi_lake.operators.measures import Catalog
    from kpi_lake.operators.model import Relationship, StarModel

    fact = spark.createDataFrame(rows, "k string, v long")
    dim = spark.createDataFrame([(f"m{i}", f"g{i % 7}") for i in range(150)], "k string, g string")
    model = StarModel({"f": fact, "d": dim}, [Relationship("f", "k", "d", "k")])
    catalog = Catalog().add(Measure("total", "f", "sum", column="v"), Measure("values", "f", "count_distinct", column="v"))
    got = evaluate_visuals(model, C.EMPTY, [Visual("all", ("total", "values")), Visual("by", ("total", "values"), "d", ("g",))], catalog).collect()
    group = {f"m{i}": f"g{i % 7}" for i in range(150)}
    want = {("all", None): [v for _, v in rows]}
    for k, v in rows:
        want.setdefault(("by", group.get(k)), []).append(v)
    assert {(r.visual, r.g): (r.total, r["values"]) for r in got} == {k: (sum(v), len(set(v))) for k, v in want.items()}


# --- bitmap roll-ups --------------------------------------------------------------------------------------


def test_rollups_equal_distinct_counts(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice([None, 1, 32768, 32769, *range(2, 90_000, 997)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, day int, k long").repartition(5)
    rollup = distinct_rollup(df, ["g", "day"], "k")
    for groups in ([], ["g"], ["day"], ["g", "day"]):
        want = df.groupBy(*groups).agg(F.count_distinct("k").alias("n")).where("n > 0")
        assert sorted(map(tuple, distinct_count(rollup, groups).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    early, late = distinct_rollup(df.where("day < 2"), ["g", "day"], "k"), distinct_rollup(df.where("day >= 1"), ["g", "day"], "k")
    merged = merge_rollups([early, late], ["g"])
    assert sorted(map(tuple, distinct_count(merged, ["g"]).collect()), key=repr) == sorted(map(tuple, distinct_count(rollup, ["g"]).collect()), key=repr)
    assert distinct_count(rollup.where("day = 3")).first()[0] == df.where("day = 3").agg(F.count_distinct("k")).first()[0]
    assert distinct_count(distinct_rollup(df.limit(0), ["g"], "k")).first()[0] == 0
    assert "Python" not in distinct_count(rollup, ["g"])._jdf.queryExecution().executedPlan().toString()


def test_keys_that_are_no_keys_are_refused(spark):
    with pytest.raises(Exception, match="positive integer"):
        distinct_count(distinct_rollup(spark.createDataFrame([(0,)], "k long"), [], "k")).collect()


# --- counters of a write ------------------------------------------------------------------------------------


def test_counters_equal_counts(spark, lake):
    made, report = lake
    assert set(report.quality) >= {"silver.success_updated", "silver.activity_updated", "gold.sales_fact", "gold.date_success"}
    for name, counters in report.quality.items():
        layer, table = name.split(".")
        assert counters["rows_out"] == read_table(spark, made, layer, table).count(), name
    activity = read_table(spark, made, "bronze", "success_activity_monitoring")
    found = report.quality["silver.activity_updated"]
    assert found["rows_in"] == activity.count() and found["rows_dropped"] == activity.where("attendance_number is null").count() > 0
    sales = report.quality["silver.sales_updated"]
    stored = read_table(spark, made, "silver", "sales_updated")
    assert sales["nulled_sales_reporting_date"] == stored.where("sales_reporting_date is null").count() > 0
    assert sales["nulled_domestic_sale"] == 0 and sales["rows_dropped"] == 0
    dates = read_table(spark, made, "gold", "date_success")
    assert report.quality["gold.date_success"]["null_registration_date_id"] == dates.where("registration_date_id is null").count()


def test_counters_cost_no_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k long, v string")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    counters = QualityCounters()
    out = counters.step("t", spark.read.parquet(path), lambda d: d.where("k is not null").withColumn("v", F.lit(None).cast("string")), ["v"])
    assert out.columns == ["k", "v"]
    plan = final_plan(out)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert counters.report() == {"t": {"rows_in": 3, "rows_out": 2, "nulled_k": 0, "nulled_v": 1, "null_v": 2, "rows_dropped": 1}}


def test_a_step_that_reorders_columns_is_counted_without_nulled(spark):
    counters = QualityCounters()
    out = counters.step("t", spark.createDataFrame([(1, "a")], "k long, v string"), lambda d: d.select("v", "k"))
    assert out.columns == ["v", "k"] and out.collect()
    assert counters.report() == {"t": {"rows_in": 1, "rows_out": 1, "rows_dropped": 0}}
