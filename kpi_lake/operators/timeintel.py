"""Time intelligence over a calendar dimension: month to date and month shifts.

The date argument is a calendar *column*, so the filter on that calendar table is replaced by
the computed date set while every other filter of the context stays. In ``evaluate`` all date sets
of a calendar are flags of one pass over it (``measures._date_flags``). Alone, a set's bounds come
from scalar subqueries over the visible calendar rows; the resulting date set is bounded by the
calendar as well, so it is broadcast into a semi join with the fact.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_lake.operators.context import FilterContext, range_predicate
from kpi_lake.operators.measures import GAP_TEXT, DateSet, Measure, date_set_bounds
from kpi_lake.operators.model import StarModel


def _fact_date_column(model: StarModel, date_table: str, fact: str) -> str:
    hops = model.path(date_table, fact)
    if not hops or len(hops) != 1:
        raise ValueError(f"{date_table} must be directly related to {fact}")
    return hops[0].dst_col


def _restrict(
    model: StarModel, ctx: FilterContext, fact: str, date_table: str, dates: DataFrame, date_col: str, months_before: int | None = 0
) -> DataFrame:
    rows = model.scoped(fact, ctx.removing_table(date_table))
    bounds = date_set_bounds(ctx, [DateSet(date_table, date_col, lambda m, c: dates, months_before)])
    pred = range_predicate(_fact_date_column(model, date_table, fact), bounds) if bounds else None
    if pred is not None:
        rows = rows.filter(pred)
    keys = model.bounded(date_table, date_col, dates.select(F.col(date_col).alias("__d")).distinct(), "__d")
    return rows.join(keys, F.col(_fact_date_column(model, date_table, fact)) == F.col("__d"), "left_semi")


def visible_bounds(model: StarModel, ctx: FilterContext, date_table: str, date_col: str):
    """(first, last) visible calendar date as one scalar subquery, shared by month-to-date and
    month shifts of the same context (Spark runs an identical subquery once)."""
    b = model.scoped(date_table, ctx).select(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))).scalar()
    return b.getField("lo"), b.getField("hi")


def month_to_date_dates(model: StarModel, ctx: FilterContext, date_table: str, date_col: str) -> DataFrame:
    """Calendar dates from the first of the month of the last visible date up to that date."""
    _, hi = visible_bounds(model, ctx, date_table, date_col)
    c = F.col(date_col)
    return model.tables[date_table].select(date_col).filter((c >= F.trunc(hi, "month")) & (c <= hi))


def shifted_dates(
    model: StarModel,
    ctx: FilterContext,
    date_table: str,
    date_col: str,
    months: int = -1,
    extend_month_end: bool = True,
    contiguous: bool = True,
) -> DataFrame:
    """Visible dates moved by ``months`` (month ends clamp), kept only where the calendar has them.

    With ``extend_month_end`` a selection of whole months (first visible date is a first of
    month, last visible date a last of month) maps to whole shifted months: the days after the
    shifted last date up to the end of its month are added. With ``contiguous`` the query fails
    where the visible dates leave out a date of the calendar between the first and the last.
    """
    c = F.col(date_col)
    visible = model.scoped(date_table, ctx).select(date_col)
    calendar = model.tables[date_table].select(date_col)
    moved = visible.select(F.add_months(c, months).alias("__d"))
    dates = calendar.join(moved, c == F.col("__d"), "left_semi")
    if extend_month_end:
        lo, hi = visible_bounds(model, ctx, date_table, date_col)
        whole_months = (lo == F.trunc(lo, "month")) & (hi == F.last_day(hi))
        moved_hi = F.add_months(hi, months)
        tail = calendar.filter(whole_months & (c > moved_hi) & (c <= F.last_day(moved_hi)))
        dates = dates.unionByName(tail)
    if contiguous:
        lo, hi = visible_bounds(model, ctx, date_table, date_col)
        left_out = calendar.filter((c > lo) & (c < hi)).join(visible.select(c.alias("__v")), c == F.col("__v"), "left_anti")
        gap = left_out.agg(F.count(F.lit(1)) > 0).scalar()
        dates = dates.filter(F.when(gap, F.raise_error(F.lit(GAP_TEXT)).cast("boolean")).otherwise(F.lit(True)))
    return dates


def month_to_date(base: Measure, date_table: str, date_col: str, name: str) -> Measure:
    """``base`` over the month-to-date dates of the calendar (replacing the calendar's filter)."""

    def dates(model: StarModel, ctx: FilterContext) -> DataFrame:
        return month_to_date_dates(model, ctx, date_table, date_col)

    def member(day: Column, visible: Column, lo: Column, hi: Column) -> Column:
        return (day >= F.trunc(hi, "month")) & (day <= hi)

    def scope(model: StarModel, ctx: FilterContext) -> DataFrame:
        return _restrict(model, ctx, base.table, date_table, dates(model, ctx), date_col, 0)

    return dataclasses.replace(base, name=name, scope=scope, date_set=DateSet(date_table, date_col, dates, 0, member))


def shift_months(
    base: Measure, date_table: str, date_col: str, name: str, months: int = -1, extend_month_end: bool = True, contiguous: bool = True
) -> Measure:
    """``base`` over the visible calendar dates moved by ``months`` (replacing the calendar's filter).
    A selection with gaps is refused when the query runs, unless ``contiguous`` is off: then each
    date is moved by itself."""

    def dates(model: StarModel, ctx: FilterContext) -> DataFrame:
        return shifted_dates(model, ctx, date_table, date_col, months, extend_month_end, contiguous)

    def member(day: Column, visible: Column, lo: Column, hi: Column) -> Column:
        """The tail of a whole-month selection; the moved dates themselves are ``moved``."""
        if not extend_month_end:
            return F.lit(False)
        whole_months = (lo == F.trunc(lo, "month")) & (hi == F.last_day(hi))
        return whole_months & (day > F.add_months(hi, months)) & (day <= F.last_day(F.add_months(hi, months)))

    # Backward shifts stay below the range end and start at most |months| months earlier.
    back = -months if months <= 0 else None

    def scope(model: StarModel, ctx: FilterContext) -> DataFrame:
        return _restrict(model, ctx, base.table, date_table, dates(model, ctx), date_col, back)

    return dataclasses.replace(base, name=name, scope=scope, date_set=DateSet(date_table, date_col, dates, back, member, months, contiguous))


__all__ = ["month_to_date", "month_to_date_dates", "shift_months", "shifted_dates", "visible_bounds"]
