"""Filter contexts: the slicer selections a query is evaluated under.

A context is an immutable list of filters. Each filter belongs to one table, names the columns
it constrains (so a measure can replace the filter on a column) and may carry a slicer name
(so a visual can be exempted from that slicer).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True, eq=False)
class Filter:
    """``bounds`` (start inclusive, end exclusive; either may be None) is set for a date range
    on a single column; it lets the model add the same range as a literal predicate on the
    fact's date column, which the parquet scan can use to skip data."""

    table: str
    columns: tuple[str, ...]
    predicate: Column
    name: str | None = None
    bounds: tuple[dt.date | None, dt.date | None] | None = None
    # For a selection of calendar periods: the date column and the same selection as date ranges.
    period_column: str | None = None
    periods: tuple[tuple[dt.date, dt.date], ...] = ()


Range = tuple[dt.date | None, dt.date | None]
_NO_DAY = dt.date(1900, 1, 1)  # both ends of an empty range


@dataclass(frozen=True, eq=False)
class FilterContext:
    filters: tuple[Filter, ...] = field(default_factory=tuple)

    # --- building ------------------------------------------------------------------------------
    def where(self, table: str, predicate: Column, columns: Sequence[str] | str, name: str | None = None) -> FilterContext:
        cols = (columns,) if isinstance(columns, str) else tuple(columns)
        return FilterContext(self.filters + (Filter(table, cols, predicate, name),))

    def where_range(
        self, table: str, column: str, start: dt.date | str | None, end_exclusive: dt.date | str | None, name: str | None = None
    ) -> FilterContext:
        """Half-open date range on one column (either end may be open)."""
        lo = _as_date(start)
        hi = _as_date(end_exclusive)
        c = F.col(column)
        terms = ([c >= F.lit(lo)] if lo else []) + ([c < F.lit(hi)] if hi else [])
        pred = reduce(lambda a, b: a & b, terms) if terms else F.lit(True)
        return FilterContext(self.filters + (Filter(table, (column,), pred, name, (lo, hi)),))

    def where_periods(
        self, table: str, date_column: str, levels: Sequence[str], selection: Sequence[Sequence[int]], name: str | None = None
    ) -> FilterContext:
        """Years, quarters or months picked on a calendar: ``levels`` are its year, quarter and month
        columns, as far as picked. The filter stays a test on those columns; the same selection as
        date ranges on ``date_column`` lets the model prune the fact's scan."""
        selection = [tuple(s) for s in selection]
        ranges = period_ranges(selection)
        found = Filter(table, tuple(levels), hierarchy(levels, selection), name, None, date_column if ranges else None, ranges or ())
        return FilterContext(self.filters + (found,))

    def key_ranges(self, table: str, column: str) -> list[Range] | None:
        """The dates of ``table.column`` that all literal ranges and period selections leave, as
        separate half-open ranges (None where there is neither; empty where nothing is left)."""
        found: list[Range] | None = None
        for f in self.filters:
            if f.table != table:
                continue
            if f.bounds is not None and f.columns == (column,):
                own: list[Range] = [f.bounds]
            elif f.period_column == column:
                own = list(f.periods)
            else:
                continue
            found = own if found is None else _intersect(found, own)
        return found

    def key_bounds(self, table: str, column: str) -> tuple[dt.date | None, dt.date | None] | None:
        """The first and last end of the ranges on ``table.column`` (None when there is none)."""
        ranges = self.key_ranges(table, column)
        if ranges is None:
            return None
        if not ranges:
            return (_NO_DAY, _NO_DAY)
        lows, highs = [r[0] for r in ranges], [r[1] for r in ranges]
        return (None if None in lows else min(lows), None if None in highs else max(highs))  # type: ignore[type-var]

    def merge(self, other: FilterContext) -> FilterContext:
        return FilterContext(self.filters + other.filters)

    # --- editing (a measure replacing filters) -------------------------------------------------------------
    def without(self, *names: str) -> FilterContext:
        """Drop the named slicers (a visual that a slicer does not interact with)."""
        return FilterContext(tuple(f for f in self.filters if f.name not in names))

    def removing_columns(self, table: str, columns: Iterable[str]) -> FilterContext:
        """Drop every filter of ``table`` that touches one of ``columns``."""
        cols = set(columns)
        return FilterContext(tuple(f for f in self.filters if not (f.table == table and cols & set(f.columns))))

    def removing_table(self, table: str) -> FilterContext:
        return FilterContext(tuple(f for f in self.filters if f.table != table))

    def replacing(self, table: str, column: str, predicate: Column) -> FilterContext:
        """Filter on ``table.column`` replaced by ``predicate`` (other filters stay)."""
        return self.removing_columns(table, [column]).where(table, predicate, column)

    # --- reading -------------------------------------------------------------------------------
    def tables(self) -> set[str]:
        return {f.table for f in self.filters}

    def predicate_for(self, table: str) -> Column | None:
        preds = [f.predicate for f in self.filters if f.table == table]
        if not preds:
            return None
        return reduce(lambda a, b: a & b, preds)

    def same_as(self, other: FilterContext) -> bool:
        return len(self.filters) == len(other.filters) and all(a is b for a, b in zip(self.filters, other.filters))


EMPTY = FilterContext()


# --- slicer predicates -------------------------------------------------------------------------


def _as_date(value: dt.date | str | None) -> dt.date | None:
    if value is None or value == "":
        return None
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _lit_date(value: dt.date | str) -> Column:
    return F.lit(_as_date(value))


def range_predicate(column: str, bounds: tuple[dt.date | None, dt.date | None]) -> Column | None:
    """``bounds[0] <= column < bounds[1]`` as literals (None when both ends are open)."""
    c = F.col(column)
    terms = ([c >= F.lit(bounds[0])] if bounds[0] else []) + ([c < F.lit(bounds[1])] if bounds[1] else [])
    return reduce(lambda a, b: a & b, terms) if terms else None


def period_ranges(selection: Sequence[Sequence[int]]) -> tuple[tuple[dt.date, dt.date], ...] | None:
    """Selected periods as merged half-open date ranges in order: ``(year,)``, ``(year, quarter)`` or
    ``(year, quarter, month)``. None if nothing is selected or a period isn't one of the calendar's
    (then the selection can't be told as ranges)."""
    found: list[tuple[int, int]] = []  # in months
    for member in selection:
        if not 1 <= len(member) <= 3 or not all(isinstance(x, int) for x in member) or not 1 <= member[0] <= 9998:
            return None
        start, stop = member[0] * 12, member[0] * 12 + 12
        if len(member) > 1:
            if not 1 <= member[1] <= 4:
                return None
            start, stop = start + 3 * (member[1] - 1), start + 3 * member[1]
        if len(member) > 2:
            if not 1 <= member[2] <= 12 or (member[2] - 1) // 3 + 1 != member[1]:
                return None
            start, stop = member[0] * 12 + member[2] - 1, member[0] * 12 + member[2]
        found.append((start, stop))
    merged: list[list[int]] = []
    for start, stop in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([start, stop])
    return tuple((dt.date(a // 12, a % 12 + 1, 1), dt.date(b // 12, b % 12 + 1, 1)) for a, b in merged) or None


def _intersect(a: Sequence[Range], b: Sequence[Range]) -> list[Range]:
    """What two lists of separate ranges have in common."""
    found = []
    for lo1, hi1 in a:
        for lo2, hi2 in b:
            lo = lo1 if lo2 is None else lo2 if lo1 is None else max(lo1, lo2)
            hi = hi1 if hi2 is None else hi2 if hi1 is None else min(hi1, hi2)
            if lo is None or hi is None or lo < hi:
                found.append((lo, hi))
    return found


def ranges_predicate(column: str, ranges: Sequence[Range]) -> Column | None:
    """``column`` lies in one of the ranges, as literals (None if one of them is open at both ends)."""
    terms = [range_predicate(column, r) for r in ranges]
    if any(t is None for t in terms):
        return None
    return reduce(lambda a, b: a | b, terms) if terms else F.lit(False)  # type: ignore[arg-type, return-value]


def values_not_blank(column: str) -> Column:
    """``NOT (c IN (null))``: every non-blank value."""
    return F.col(column).isNotNull()


def in_list(column: str, values: Sequence[object]) -> Column:
    return F.col(column).isin(list(values))


def between(column: str, start: dt.date | str, end_exclusive: dt.date | str) -> Column:
    """Half-open date range ``start <= c < end`` (the slicer's shown end + 1 day)."""
    c = F.col(column)
    return (c >= _lit_date(start)) & (c < _lit_date(end_exclusive))


def until(column: str, end_exclusive: dt.date | str) -> Column:
    return F.col(column) < _lit_date(end_exclusive)


def hierarchy(levels: Sequence[str], selection: Sequence[Sequence[object]]) -> Column:
    """Hierarchy slicer: each selected member is a prefix of level values (e.g. (2024,) or
    (2024, 1)); a row passes if it matches any member."""
    if not selection:
        return F.lit(True)
    terms = []
    for member in selection:
        if not member or len(member) > len(levels):
            raise ValueError(f"bad hierarchy member {member!r}")
        terms.append(reduce(lambda a, b: a & b, [F.col(lv) == F.lit(v) for lv, v in zip(levels, member)]))
    return reduce(lambda a, b: a | b, terms)


def equals(column: str, value: object) -> Column:
    """Cross-filter by selecting one category in a chart."""
    return F.col(column) == F.lit(value) if value is not None else F.col(column).isNull()


__all__ = [
    "EMPTY",
    "Filter",
    "FilterContext",
    "between",
    "range_predicate",
    "equals",
    "hierarchy",
    "period_ranges",
    "ranges_predicate",
    "in_list",
    "until",
    "values_not_blank",
]
