"""Measures: named aggregates evaluated under a filter context.

Evaluation plan (one-row results):
  * measures are grouped by the row set they aggregate (table + effective context, or a custom
    scope such as month-to-date); each group is ONE ``agg`` over its scoped table, so a page that
    asks five measures of one fact scans that fact once;
  * the one-row frames are stacked and folded into one row (no join);
  * derived measures (targets, ratios) are plain column arithmetic on that row.

Grouped results (charts) pre-aggregate the fact by its join key before joining the mapping to
the group attribute, so the shuffle carries one partial row per key and map task, whatever the
skew of the key.

Blank rules: a sum over no rows is null; counts over no rows are null as well (``blank_if_zero``).
Groups whose measures are all blank are not returned.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpi_lake.operators.context import FilterContext, range_predicate
from kpi_lake.operators.model import StarModel

Scope = Callable[[StarModel, FilterContext], DataFrame]


@dataclass(frozen=True, eq=False)
class DateSet:
    """The calendar dates a time-intelligence measure aggregates over (replacing the filter on
    that calendar table); ``dates`` returns a frame with the calendar's date column."""

    date_table: str
    date_col: str
    dates: Callable[[StarModel, FilterContext], DataFrame]
    # The set lies within [first of month of the range start - months_before months, range end)
    # of a literal date range on the calendar; None when no such bound holds.
    months_before: int | None = 0
    # Optional row-wise test of a calendar date: (date, is it visible, first, last visible date).
    member: Callable[[Column, Column, Column, Column], Column] | None = None
    # Besides, the visible dates moved by so many months are in the set.
    moved: int | None = None
    # Whether visible dates that leave out a date of the calendar between them are refused.
    contiguous: bool = False


GAP_TEXT = "the dates selected on the calendar have a gap; a month shift needs a contiguous selection"


def date_set_bounds(ctx: FilterContext, sets: Sequence[DateSet]) -> tuple | None:
    """A literal superset range of all ``sets`` from the context's date range, if there is one."""
    import datetime as dt

    if not sets or any(s.months_before is None for s in sets):
        return None
    b = ctx.key_bounds(sets[0].date_table, sets[0].date_col)
    if b is None:
        return None
    lo, hi = b
    if lo is not None:
        back = max(s.months_before for s in sets)  # type: ignore[type-var]
        y, m = divmod(lo.year * 12 + lo.month - 1 - back, 12)
        lo = dt.date(y, m + 1, 1) if y >= 1 else None
    return (lo, hi)


@dataclass(frozen=True, eq=False)
class Measure:
    """An aggregate over one table.

    kind: ``sum`` | ``count_rows`` | ``count_where`` | ``count_distinct``.
    ``cast`` is applied to the column before summing (e.g. a decimal for money held as double,
    so the total does not depend on the order of additions). ``context`` edits the filter
    context first (a measure replacing the filter on a column); ``scope`` replaces the row set altogether.
    """

    name: str
    table: str
    kind: str
    column: str | None = None
    condition: Callable[[], Column] | None = None
    cast: str | None = None
    result_type: str | None = None
    blank_if_zero: bool = True
    context: Callable[[FilterContext], FilterContext] | None = None
    scope: Scope | None = None
    date_set: DateSet | None = None
    value: Callable[[], Column] | None = None

    def _value(self) -> Column:
        c = self.value() if self.value is not None else F.col(self.column)  # type: ignore[arg-type]
        return c.cast(self.cast) if self.cast else c

    def _finish(self, agg: Column) -> Column:
        if self.kind != "sum" and self.blank_if_zero:
            agg = F.nullif(agg, F.lit(0))
        if self.result_type:
            agg = agg.cast(self.result_type)
        return agg.alias(self.name)

    def aggregate(self, where: Column | None = None) -> Column:
        """The aggregate over all rows, or only over rows where ``where`` holds."""

        def only(value: Column) -> Column:
            return value if where is None else F.when(where, value)

        if self.kind == "sum":
            agg = F.sum(only(self._value()))
        elif self.kind == "count_rows":
            agg = F.count(only(F.lit(1)))
        elif self.kind == "count_where":
            agg = F.count(only(F.when(self.condition(), F.lit(1))))  # type: ignore[misc]
        elif self.kind == "count_distinct":
            agg = F.count_distinct(only(F.col(self.column)))  # type: ignore[arg-type]
        else:
            raise ValueError(f"unknown measure kind {self.kind!r}")
        return self._finish(agg)

    # --- two-phase form for grouped evaluation ------------------------------------------------
    @property
    def decomposable(self) -> bool:
        """Partial results per key add up to the group result (sums and counts)."""
        return self.kind in ("sum", "count_rows", "count_where")

    def partial_agg(self, where: Column | None = None) -> Column:
        """Per-key partial aggregate of a decomposable measure, of all rows or of those where
        ``where`` holds."""

        def only(value: Column) -> Column:
            return value if where is None else F.when(where, value)

        if self.kind == "sum":
            return F.sum(only(self._value()))
        if self.kind == "count_rows":
            return F.count(only(F.lit(1)))
        return F.count(only(F.when(self.condition(), F.lit(1))))  # type: ignore[misc]

    def partial(self, df: DataFrame, key: str) -> DataFrame:
        """Per join key: partial aggregate in ``__p``. For count_distinct, the values: where the
        counted column is the key itself, each once (grouped by the key, as the join wants them);
        else as they are, since the count after the join removes repeats in its map-side step."""
        if self.kind == "count_distinct":
            if self.column == key:
                keys = df.select(F.col(key).alias("__k")).distinct()
                return keys.select("__k", F.col("__k").alias("__p"))
            return df.select(F.col(key).alias("__k"), F.col(self.column).alias("__p"))  # type: ignore[arg-type]
        return df.groupBy(F.col(key).alias("__k")).agg(self.partial_agg().alias("__p"))

    def final(self, partial_col: str = "__p") -> Column:
        if self.kind == "count_distinct":
            return self._finish(F.count_distinct(F.col(partial_col)))
        return self._finish(F.sum(F.col(partial_col)))

    def rows(self, model: StarModel, ctx: FilterContext) -> DataFrame:
        if self.scope is not None:
            return self.scope(model, ctx)
        return model.scoped(self.table, self.effective(ctx))

    def effective(self, ctx: FilterContext) -> FilterContext:
        return self.context(ctx) if self.context else ctx


@dataclass(frozen=True, eq=False)
class Derived:
    """Arithmetic over other measures of the same row, e.g. a target = 1.1 x a total."""

    name: str
    inputs: tuple[str, ...]
    formula: Callable[..., Column]
    result_type: str | None = None

    def column(self) -> Column:
        c = self.formula(*[F.col(i) for i in self.inputs])
        if self.result_type:
            c = c.cast(self.result_type)
        return c.alias(self.name)


Item = Measure | Derived


@dataclass
class Catalog:
    """Named measures of a model, so derived measures can be resolved by name."""

    items: dict[str, Item] = field(default_factory=dict)

    def add(self, *items: Item) -> Catalog:
        for it in items:
            self.items[it.name] = it
        return self

    def __getitem__(self, name: str) -> Item:
        return self.items[name]

    def resolve(self, names: Sequence[str]) -> tuple[list[Measure], list[Derived]]:
        base: dict[str, Measure] = {}
        derived: dict[str, Derived] = {}

        def visit(name: str) -> None:
            it = self.items[name]
            if isinstance(it, Measure):
                base.setdefault(name, it)
            else:
                for dep in it.inputs:
                    visit(dep)
                derived.setdefault(name, it)

        for n in names:
            visit(n)
        return list(base.values()), list(derived.values())


def _as_items(catalog: Catalog | None, measures: Sequence[Item | str]) -> tuple[list[Measure], list[Derived], list[str]]:
    cat = Catalog()
    if catalog is not None:
        cat.items.update(catalog.items)
    names = []
    for m in measures:
        if isinstance(m, str):
            names.append(m)
        else:
            cat.add(m)
            names.append(m.name)
    base, derived = cat.resolve(names)
    return base, derived, names


def _direct_date_column(model: StarModel, date_table: str, table: str) -> str | None:
    hops = model.path(date_table, table)
    return hops[0].dst_col if hops and len(hops) == 1 else None


def _date_flags(model: StarModel, ctx: FilterContext, date_table: str, cal_col: str, sets: Sequence[DateSet]) -> DataFrame:
    """One row per calendar date that is in any of the sets: ``__d`` and a flag ``__f<i>`` per set.

    Where the calendar is filtered by its own predicate only, all flags come from one pass over it:
    the first and last visible date are a window over its distinct dates, tests on a date are
    row-wise, and a set moved by months sends each visible date to its moved one, where an
    aggregation by date puts the flags together (and drops dates that the calendar doesn't have).
    """
    names = [f"__f{i}" for i in range(len(sets))]
    any_flag = reduce(lambda a, b: a | b, [F.col(n) for n in names])
    if model.inbound(date_table) or any(s.member is None for s in sets):
        flags = model.tables[date_table].select(F.col(cal_col).alias("__d")).distinct()
        for name, ds in zip(names, sets, strict=True):
            dates = ds.dates(model, ctx).select(F.col(ds.date_col).alias("__s")).distinct()
            flags = flags.join(dates, F.col("__d") == F.col("__s"), "left").withColumn(name, F.col("__s").isNotNull()).drop("__s")
        return flags.filter(any_flag)
    predicate = ctx.predicate_for(date_table)
    visible = F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))
    # The window's one partition is the calendar: its size is bounded by the DATE key.
    whole = Window.partitionBy(F.lit(0))
    seen = F.when(F.col("__v"), F.col("__d"))
    days = (
        model.tables[date_table]
        .select(F.col(cal_col).alias("__d"), visible.alias("__v"))
        .groupBy("__d")
        .agg(F.bool_or("__v").alias("__v"))
        .select("__d", "__v", F.min(seen).over(whole).alias("__lo"), F.max(seen).over(whole).alias("__hi"))
    )
    day, v, lo, hi = (F.col(c) for c in ("__d", "__v", "__lo", "__hi"))
    if any(s.contiguous for s in sets):
        gap = F.coalesce(F.bool_or(~v & (day > lo) & (day < hi)).over(whole), F.lit(False))
        days = days.withColumn("__v", F.when(gap, F.raise_error(F.lit(GAP_TEXT)).cast("boolean")).otherwise(v))

    def entry(date: Column, values: Sequence[Column], listed: bool) -> Column:
        flags = [F.coalesce(x, F.lit(False)).alias(n) for n, x in zip(names, values, strict=True)]
        return F.struct(date.alias("__d"), F.lit(listed).alias("__listed"), *flags)

    entries = [entry(day, [s.member(day, v, lo, hi) for s in sets], True)]  # type: ignore[misc]
    for months in sorted({s.moved for s in sets if s.moved is not None}):
        entries.append(entry(F.add_months(day, months), [v if s.moved == months else F.lit(False) for s in sets], False))
    each = days.select(F.explode(F.array(*entries)).alias("__e")).select("__e.*")
    merged = each.groupBy("__d").agg(*[F.bool_or(c).alias(c) for c in ("__listed", *names)])
    return merged.filter(F.col("__listed") & any_flag).drop("__listed")


def _date_set_frame(model: StarModel, ctx: FilterContext, table: str, date_table: str, members: list[tuple[Measure, DateSet]]) -> DataFrame:
    """Several measures of one fact over different date sets of one calendar, in ONE fact scan and
    ONE calendar scan.

    Each date set is a subset of the calendar (bounded by its number of days); a per-date flag
    frame (date, in set 1, in set 2, ...) is broadcast into a single join with the fact, scoped by
    every filter except the calendar's own. Each measure then sums only the rows whose date carries
    its flag.
    """
    fact_col = _direct_date_column(model, date_table, table)
    cal_col = members[0][1].date_col
    flags = _date_flags(model, ctx, date_table, cal_col, [ds for _, ds in members])
    rows = model.scoped(table, ctx.removing_table(date_table))
    bounds = date_set_bounds(ctx, [ds for _, ds in members])
    pred = range_predicate(fact_col, bounds) if bounds else None  # type: ignore[arg-type]
    if pred is not None:
        rows = rows.filter(pred)
    joined = rows.join(model.bounded(date_table, cal_col, flags, "__d"), F.col(fact_col) == F.col("__d"))  # type: ignore[arg-type]
    return joined.agg(*[m.aggregate(where=F.col(f"__f{i}")) for i, (m, _) in enumerate(members)])


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row aggregates side by side, without a join.

    The frames (each exactly one row, distinct column names) are stacked with ``unionByName``
    (missing columns null) and folded back to one row by taking each column's non-null value:
    an aggregate over as many rows as there are frames. Names and types are kept; a measure
    that is itself blank stays null.
    """
    if len(frames) == 1:
        return frames[0]
    cols = [c for f in frames for c in f.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in cols])


def evaluate(model: StarModel, ctx: FilterContext, measures: Sequence[Item | str], catalog: Catalog | None = None) -> DataFrame:
    """All requested measures as one row."""
    base, derived, names = _as_items(catalog, measures)
    # Time-intelligence measures, per (fact, calendar); plain measures of the same fact join them
    # when the context filters that calendar (their date set is then the visible dates).
    dated: dict[tuple[str, str], list[tuple[Measure, DateSet]]] = {}
    for m in base:
        if m.date_set is not None and _direct_date_column(model, m.date_set.date_table, m.table):
            dated.setdefault((m.table, m.date_set.date_table), []).append((m, m.date_set))
    groups: list[tuple[object, list[Measure]]] = []
    in_dated = {id(m) for members in dated.values() for m, _ in members}
    for m in base:
        if id(m) in in_dated:
            continue
        if m.context is None and m.scope is None:
            target = next(
                (
                    (t, dt)
                    for (t, dt) in dated
                    if t == m.table and ctx.predicate_for(dt) is not None and not model.inbound(dt)
                ),
                None,
            )
            if target is not None:
                dt = target[1]
                col = dated[target][0][1].date_col
                dated[target].append((m, _visible_set(dt, col)))
                continue
        if m.scope is not None:
            groups.append((m, [m]))
            continue
        eff = m.effective(ctx)
        for key, members in groups:
            if isinstance(key, tuple) and key[0] == m.table and key[1].same_as(eff):
                members.append(m)
                break
        else:
            groups.append(((m.table, eff), [m]))
    frames = [members[0].rows(model, ctx).agg(*[m.aggregate() for m in members]) for _, members in groups]
    frames += [_date_set_frame(model, ctx, t, dt, members) for (t, dt), members in dated.items()]
    row = one_row(*frames)
    if derived:
        row = row.select("*", *[d.column() for d in derived])
    return row.select(*names)


def _dated_groups(model: StarModel, ctx: FilterContext, group_table: str, base: list[Measure]) -> dict[tuple[str, str], list[tuple[Measure, DateSet | None]]]:
    """The sums and counts over date sets that a chart shows, by fact and calendar, with the plain
    measures of the same facts (their set: the visible dates, or no set where the calendar isn't
    filtered). Not where the chart's axis is that calendar: a date set replaces its filter."""
    dated: dict[tuple[str, str], list[tuple[Measure, DateSet | None]]] = {}
    for m in base:
        ds = m.date_set
        if ds is None or not m.decomposable or not _direct_date_column(model, ds.date_table, m.table):
            continue
        if group_table in (ds.date_table, m.table) or model.path(group_table, m.table) is None or model.inbound(ds.date_table):
            continue
        dated.setdefault((m.table, ds.date_table), []).append((m, ds))
    for m in base:
        if m.scope is not None or m.context is not None or not m.decomposable:
            continue
        target = next((k for k in dated if k[0] == m.table), None)
        if target is not None:
            col = next(ds.date_col for _, ds in dated[target] if ds is not None)
            dated[target].append((m, _visible_set(target[1], col) if ctx.predicate_for(target[1]) is not None else None))
    return dated


def _visible_set(date_table: str, date_col: str) -> DateSet:
    return DateSet(
        date_table,
        date_col,
        lambda model, ctx: model.scoped(date_table, ctx).select(date_col),
        member=lambda day, visible, lo, hi: visible,
    )


def _dated_by(
    model: StarModel, ctx: FilterContext, group_table: str, group_cols: Sequence[str], table: str, date_table: str, members: list[tuple[Measure, DateSet | None]]
) -> DataFrame:
    """Several measures of one fact over date sets of one calendar, per group, in ONE fact scan: the
    date flags are broadcast into one join, and one pre-aggregation by the chart's join key sums each
    measure's flagged rows."""
    sets = [ds for _, ds in members if ds is not None]
    fact_col = _direct_date_column(model, date_table, table)
    flags = _date_flags(model, ctx, date_table, sets[0].date_col, sets)
    rows = model.scoped(table, ctx.removing_table(date_table))
    every = len(sets) == len(members)
    bounds = date_set_bounds(ctx, sets) if every else None
    pred = range_predicate(fact_col, bounds) if bounds else None  # type: ignore[arg-type]
    if pred is not None:
        rows = rows.filter(pred)
    flagged = model.bounded(date_table, sets[0].date_col, flags, "__d")
    joined = rows.join(flagged, F.col(fact_col) == F.col("__d"), "inner" if every else "left")  # type: ignore[arg-type]
    join_col, mapping = model.group_mapping(group_table, group_cols, table, ctx)
    where = [None if ds is None else F.col(f"__f{sets.index(ds)}") for _, ds in members]
    partials = [m.partial_agg(w).alias(f"__p{i}") for i, ((m, _), w) in enumerate(zip(members, where, strict=True))]
    partial = joined.groupBy(F.col(join_col).alias("__k")).agg(*partials)
    finals = [m.final(f"__p{i}") for i, (m, _) in enumerate(members)]
    return partial.join(mapping, F.col("__k") == F.col("__gkey"), "left").groupBy(*group_cols).agg(*finals)


def evaluate_by(
    model: StarModel,
    ctx: FilterContext,
    group_table: str,
    group_cols: Sequence[str],
    measures: Sequence[Item | str],
    catalog: Catalog | None = None,
) -> DataFrame:
    """Measures per value of ``group_cols`` of ``group_table`` (a chart's category axis).

    Fact rows whose key has no dimension row form the blank group (null), unless a filter on
    the dimension removed them. Groups with only blank measures are dropped.
    """
    base, derived, names = _as_items(catalog, measures)
    group_cols = list(group_cols)
    dated = _dated_groups(model, ctx, group_table, base)
    in_dated = {id(m) for members in dated.values() for m, _ in members}
    # Decomposable measures of one table under one effective context share a scan, a
    # pre-aggregation and a join; the others are evaluated one by one.
    batches: list[list[Measure]] = []
    for m in base:
        if id(m) in in_dated:
            continue
        for batch in batches:
            head = batch[0]
            if (
                m.decomposable
                and head.decomposable
                and m.scope is None
                and head.scope is None
                and head.table == m.table
                and head.effective(ctx).same_as(m.effective(ctx))
            ):
                batch.append(m)
                break
        else:
            batches.append([m])
    parts = [_dated_by(model, ctx, group_table, group_cols, t, dt, members) for (t, dt), members in dated.items()]
    for batch in batches:
        head = batch[0]
        rows = head.rows(model, ctx)
        if head.table == group_table:
            parts.append(rows.groupBy(*group_cols).agg(*[m.aggregate() for m in batch]))
            continue
        if model.path(group_table, head.table) is None:
            # No filter flows from the group table to this one: every member shows the same total.
            total = evaluate(model, ctx, batch)
            members = model.scoped(group_table, ctx).select(*group_cols).distinct()
            parts.append(members.select("*", *[total.select(m.name).scalar().alias(m.name) for m in batch]))
            continue
        join_col, mapping = model.group_mapping(group_table, group_cols, head.table, ctx)
        if len(batch) == 1:
            partial = head.partial(rows, join_col)
            finals = [head.final("__p")]
        else:
            partial = rows.groupBy(F.col(join_col).alias("__k")).agg(*[m.partial_agg().alias(f"__p{i}") for i, m in enumerate(batch)])
            finals = [m.final(f"__p{i}") for i, m in enumerate(batch)]
        joined = partial.join(mapping, F.col("__k") == F.col("__gkey"), "left")
        if not head.decomposable:
            # Rows without a key aren't grouped before the join: keep them out of it, so that they
            # don't meet in one partition, and put them back as the blank group.
            keyed = partial.filter(F.col("__k").isNotNull()).join(mapping, F.col("__k") == F.col("__gkey"), "left")
            joined = keyed.unionByName(partial.filter(F.col("__k").isNull()), allowMissingColumns=True)
        parts.append(joined.groupBy(*group_cols).agg(*finals))
    out = parts[0]
    for nxt in parts[1:]:
        a, b = out.alias("a"), nxt.alias("b")
        cond = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group_cols])
        out = a.join(b, cond, "full").select(
            *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in group_cols],
            *[F.col(f"a.{c}") for c in out.columns if c not in group_cols],
            *[F.col(f"b.{c}") for c in nxt.columns if c not in group_cols],
        )
    base_names = [m.name for m in base]
    out = out.filter(F.coalesce(*[F.col(n) for n in base_names]).isNotNull())
    if derived:
        out = out.select("*", *[d.column() for d in derived])
    return out.select(*group_cols, *names)


def highlight_by(
    model: StarModel,
    ctx: FilterContext,
    selection: FilterContext,
    group_table: str,
    group_cols: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """A chart while members are picked in another one: per group each measure under ``ctx`` and,
    as ``<name>_highlighted``, the part under ``ctx`` and ``selection``, in one scan of each fact.
    The selection marks rows (``StarModel.marked``) and doesn't filter them; groups without a
    highlighted part stay, with a blank one."""
    group_cols = list(group_cols)
    flag, parts = F.col("__mark"), []
    by_table: dict[str, list[Measure]] = {}
    for m in measures:
        if m.scope is not None or m.context is not None:
            raise ValueError(f"{m.name} has a context of its own")
        by_table.setdefault(m.table if m.decomposable else f"{m.table}.{m.column}", []).append(m)
    for batch in by_table.values():
        table = batch[0].table
        rows = model.marked(table, ctx, selection, "__mark")
        lit_up = [dataclasses.replace(m, name=f"{m.name}_highlighted") for m in batch]
        if table == group_table:
            parts.append(rows.groupBy(*group_cols).agg(*[m.aggregate() for m in batch], *[m.aggregate(flag) for m in lit_up]))
            continue
        join_col, mapping = model.group_mapping(group_table, group_cols, table, ctx)
        keyed = rows.withColumn("__k", F.col(join_col))
        if batch[0].decomposable:
            partial = keyed.groupBy("__k").agg(
                *[m.partial_agg().alias(f"__p{i}") for i, m in enumerate(batch)], *[m.partial_agg(flag).alias(f"__h{i}") for i, m in enumerate(batch)]
            )
            finals = [m.final(f"__p{i}") for i, m in enumerate(batch)] + [m.final(f"__h{i}") for i, m in enumerate(lit_up)]
        else:
            values = keyed.groupBy("__k", F.col(batch[0].column).alias("__p")).agg(F.bool_or(flag).alias("__m"))  # type: ignore[arg-type]
            partial = values.withColumn("__h", F.when(F.col("__m"), F.col("__p")))
            finals = [m.final("__p") for m in batch] + [m.final("__h") for m in lit_up]
        parts.append(partial.join(mapping, F.col("__k") == F.col("__gkey"), "left").groupBy(*group_cols).agg(*finals))
    names = [n for m in measures for n in (m.name, f"{m.name}_highlighted")]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    out = every if len(parts) == 1 else every.groupBy(*group_cols).agg(*[F.first(F.col(n), ignorenulls=True).alias(n) for n in names])
    return out.filter(F.coalesce(*[F.col(m.name) for m in measures]).isNotNull()).select(*group_cols, *names)


def implicit_aggregates(df: DataFrame, summarize: Mapping[str, str], fields: Sequence[str]) -> DataFrame:
    """A visual's implicit query: fields whose default summary is ``sum`` are summed, the others
    are grouping columns."""
    keys = [f for f in fields if summarize.get(f, "none") == "none"]
    sums = [F.sum(F.col(f)).alias(f"sum_{f}") for f in fields if summarize.get(f) == "sum"]
    if not sums:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*sums) if keys else df.agg(*sums)


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Each row's share of the column total; the total is a scalar subquery (no join)."""
    total = df.agg(F.sum(F.col(value))).scalar()
    return df.withColumn(name, F.col(value).cast("double") / total.cast("double"))


__all__ = [
    "Catalog",
    "DateSet",
    "one_row",
    "Derived",
    "Measure",
    "evaluate",
    "evaluate_by",
    "highlight_by",
    "implicit_aggregates",
    "share_of_total",
]
