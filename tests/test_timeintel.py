"""Month to date and month shift over a calendar with gaps."""

from __future__ import annotations

import datetime as dt

import pytest

from kpi_lake.operators import context as C
from kpi_lake.operators.measures import evaluate
from kpi_lake.operators.timeintel import month_to_date_dates, shifted_dates
from kpi_lake.plans.semantic import CATALOG
from tests.star_fixture import star_model

D = dt.date


@pytest.fixture(scope="module")
def model(spark):
    return star_model(spark)


def sales_ctx(lo, hi_exclusive):
    return C.EMPTY.where("date_sales", C.between("date_sales_id", lo, hi_exclusive), "date_sales_id")


def dates(df, col="date_sales_id"):
    return sorted(r[col] for r in df.collect())


def value(model, ctx, name):
    return evaluate(model, ctx, [name], CATALOG).first()[name]


def test_mtd_dates_from_first_of_month_to_last_visible(model):
    ctx = sales_ctx("2024-02-01", "2024-03-16")
    assert dates(month_to_date_dates(model, ctx, "date_sales", "date_sales_id")) == [D(2024, 3, 1), D(2024, 3, 15)]
    assert value(model, ctx, "current_month_sales") == 80 + 160


def test_mtd_of_empty_selection_is_blank(model):
    ctx = sales_ctx("2030-01-01", "2030-02-01")
    assert value(model, ctx, "current_month_sales") is None


def test_mtd_not_above_total_for_non_negative_sales(model):
    row = evaluate(model, C.EMPTY, ["total_sales", "current_month_sales"], CATALOG).first()
    assert row["current_month_sales"] <= row["total_sales"]


def test_shift_clamps_month_end_and_drops_absent_days(model):
    ctx = sales_ctx("2024-03-31", "2024-04-01")
    assert dates(shifted_dates(model, ctx, "date_sales", "date_sales_id", -1)) == [D(2024, 2, 29)]
    ctx = sales_ctx("2024-03-15", "2024-03-16")  # 2024-02-15 is in the calendar
    assert dates(shifted_dates(model, ctx, "date_sales", "date_sales_id", -1)) == [D(2024, 2, 15)]
    ctx = sales_ctx("2024-03-01", "2024-03-02")  # 2024-02-01 is not
    assert dates(shifted_dates(model, ctx, "date_sales", "date_sales_id", -1)) == []


def test_whole_month_maps_to_whole_previous_month(model):
    ctx = sales_ctx("2024-02-01", "2024-03-01")  # visible: 02-15, 02-29; not starting on the 1st
    assert dates(shifted_dates(model, ctx, "date_sales", "date_sales_id", -1)) == []
    ctx = sales_ctx("2024-03-01", "2024-04-01")  # visible 03-01 .. 03-31: whole month
    with_ext = dates(shifted_dates(model, ctx, "date_sales", "date_sales_id", -1, extend_month_end=True))
    without = dates(shifted_dates(model, ctx, "date_sales", "date_sales_id", -1, extend_month_end=False))
    assert with_ext == [D(2024, 2, 15), D(2024, 2, 29)]
    assert without == [D(2024, 2, 15), D(2024, 2, 29)]
    ctx = sales_ctx("2024-02-01", "2024-02-02")
    assert value(model, ctx, "last_month_sales") is None


def test_extension_adds_days_after_shifted_end(spark):
    from kpi_lake.operators.model import Relationship, StarModel

    cal = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 28, 29, 30, 31)] + [(D(2024, 2, 1),), (D(2024, 2, 29),)], "d date")
    fact = spark.createDataFrame([(D(2024, 1, d), 1) for d in (1, 28, 29, 30, 31)], "d date, v long")
    m = StarModel({"cal": cal, "fact": fact}, [Relationship("fact", "d", "cal", "d")], calendar_tables=["cal"])
    ctx = C.EMPTY.where("cal", C.between("d", "2024-02-01", "2024-03-01"), "d")  # whole February
    got = dates(shifted_dates(m, ctx, "cal", "d", -1, extend_month_end=True), "d")
    assert got == [D(2024, 1, 1), D(2024, 1, 29), D(2024, 1, 30), D(2024, 1, 31)]
    plain = dates(shifted_dates(m, ctx, "cal", "d", -1, extend_month_end=False), "d")
    assert plain == [D(2024, 1, 1), D(2024, 1, 29)]


def test_shift_keeps_other_filters(model):
    ctx = sales_ctx("2024-03-01", "2024-04-01").where("success_profile", C.in_list("msme_category", ["Micro"]), "msme_category")
    # February days of m1 (Micro) only: 40
    assert value(model, ctx, "last_month_sales") == 40


def test_prev_month_jobs_and_mtd_jobs(model):
    ctx = C.EMPTY.where("date_job", C.until("date_job_id", "2024-03-31"), "date_job_id")
    row = evaluate(model, ctx, ["current_month_jobs", "last_month_jobs", "total_jobs"], CATALOG).first()
    assert row["current_month_jobs"] == 2
    # visible {01-31, 02-29, 03-10} shift to {12-31, 01-29, 02-10}: none of them is a job date
    assert row["last_month_jobs"] is None
    assert row["total_jobs"] == 10


@pytest.mark.parametrize(
    "lo, hi", [("2024-02-01", "2024-03-16"), ("2024-03-01", "2024-04-01"), ("2024-02-15", "2024-03-01"), (None, "2024-03-02")]
)
def test_literal_range_gives_same_results_as_opaque_predicate(model, lo, hi):
    """A range slicer carrying literal bounds (pushed to the fact scan) computes the same values."""
    names = ["total_sales", "current_month_sales", "last_month_sales"]
    ranged = C.EMPTY.where_range("date_sales", "date_sales_id", lo, hi)
    opaque = C.EMPTY.where("date_sales", C.until("date_sales_id", hi) if lo is None else C.between("date_sales_id", lo, hi), "date_sales_id")
    a = evaluate(model, ranged, names, CATALOG).first().asDict()
    b = evaluate(model, opaque, names, CATALOG).first().asDict()
    assert a == b
    for n in names:
        assert evaluate(model, ranged, [n], CATALOG).first()[n] == b[n]


def _month_end(d):
    nxt = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return nxt - dt.timedelta(days=1)


def _add_months(d, n):
    y, m = divmod(d.month - 1 + n, 12)
    first = D(d.year + y, m + 1, 1)
    return first.replace(day=min(d.day, _month_end(first).day))


@pytest.mark.parametrize("seed", [11, 12, 13, 14])
def test_date_sets_match_brute_force_on_random_calendars(spark, seed):
    import random

    from kpi_lake.operators.model import Relationship, StarModel

    rnd = random.Random(seed)
    start = D(2023, 11, 1)
    days = sorted({start + dt.timedelta(days=rnd.randint(0, 250)) for _ in range(90)})
    days += [D(2024, 2, 29), D(2024, 1, 31), D(2024, 3, 31), D(2024, 1, 29)]
    days = sorted(set(days))
    cal = spark.createDataFrame([(d,) for d in days], "d date")
    fact = spark.createDataFrame([(d, 1) for d in days], "d date, v long")
    m = StarModel({"cal": cal, "fact": fact}, [Relationship("fact", "d", "cal", "d")], calendar_tables=["cal"])
    for _ in range(3):
        lo = start + dt.timedelta(days=rnd.randint(0, 200))
        hi = lo + dt.timedelta(days=rnd.randint(1, 90))
        if rnd.random() < 0.3:  # whole months
            lo = lo.replace(day=1)
            hi = _month_end(hi) + dt.timedelta(days=1)
        ctx = C.EMPTY.where_range("cal", "d", lo, hi)
        vis = [d for d in days if lo <= d < hi]
        # month to date
        want_mtd = [d for d in days if vis and max(vis).replace(day=1) <= d <= max(vis)]
        assert dates(month_to_date_dates(m, ctx, "cal", "d"), "d") == want_mtd
        # shift by -1 month, with whole-month extension
        want = {_add_months(d, -1) for d in vis} & set(days)
        if vis and vis[0].day == 1 and vis[-1] == _month_end(vis[-1]):
            end = _add_months(vis[-1], -1)
            want |= {d for d in days if end < d <= _month_end(end)}
        assert dates(shifted_dates(m, ctx, "cal", "d", -1), "d") == sorted(want)
        # the folded single-scan evaluation agrees with the brute-force sets
        from kpi_lake.operators.measures import Measure
        from kpi_lake.operators.timeintel import month_to_date, shift_months

        base = Measure("n", "fact", "sum", column="v")
        row = evaluate(m, ctx, [base, month_to_date(base, "cal", "d", "mtd"), shift_months(base, "cal", "d", "prev")]).first()
        assert row["n"] == (len(vis) or None)
        assert row["mtd"] == (len(want_mtd) or None)
        assert row["prev"] == (len(want) or None)
