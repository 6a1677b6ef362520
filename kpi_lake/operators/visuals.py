"""A page's cards and charts together, with one scan of each fact.

Every visual alone would scan its facts again. Here the base measures of all visuals are put in
batches: those of one table whose effective filters (as far as they reach the table) are the same. A
batch reads its rows once and pre-aggregates them by the join keys of all its charts, a partial row
per combination of keys (for distinct counts: the distinct values beside the keys). The grand total and
each chart's groups are then branches over that one shuffled pre-aggregation, stacked with a visual's
name and its members, and aggregated once: explicit grouping sets. The branches share the exchange of
the pre-aggregation (Spark reuses equal exchanges; they keep the same columns for that reason), so
files are read once for the page.

The blank rules are ``evaluate_by``'s: rows whose key has no member form the blank group, groups of
blank measures are dropped, and a card always has its row. Measures over date sets have a row set of
their own and are read apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_lake.operators.context import FilterContext
from kpi_lake.operators.measures import Catalog, Derived, Measure
from kpi_lake.operators.model import StarModel


@dataclass(frozen=True)
class Visual:
    """A card or gauge (no group), or a chart by ``group_cols`` of ``group_table``; ``exempt`` names
    the slicers that don't filter it."""

    name: str
    measures: tuple[str, ...]
    group_table: str | None = None
    group_cols: tuple[str, ...] = ()
    exempt: tuple[str, ...] = ()


@dataclass
class _Batch:
    table: str
    ctx: FilterContext
    decomposable: bool
    asked: list[tuple[Visual, Measure]]


def _reaching(model: StarModel, ctx: FilterContext, table: str) -> FilterContext:
    """The filters of a context that reach a table."""
    return FilterContext(tuple(f for f in ctx.filters if model.reaches(f.table, table)))


def _batches(model: StarModel, ctx: FilterContext, visuals: Sequence[Visual], catalog: Catalog) -> tuple[list[_Batch], dict[str, list[Derived]]]:
    batches: list[_Batch] = []
    derived: dict[str, list[Derived]] = {}
    for v in visuals:
        base, derived[v.name] = catalog.resolve(v.measures)
        own = ctx.without(*v.exempt)
        for m in base:
            if m.scope is not None:
                raise ValueError(f"{m.name} has a date set of its own; evaluate it apart")
            eff = _reaching(model, m.effective(own), m.table)
            for b in batches:
                same_kind = b.decomposable == m.decomposable and (m.decomposable or m.column == b.asked[0][1].column)
                if b.table == m.table and same_kind and b.ctx.same_as(eff):
                    b.asked.append((v, m))
                    break
            else:
                batches.append(_Batch(m.table, eff, m.decomposable, [(v, m)]))
    return batches, derived


def _stacked(branches: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), branches)


def _answer(model: StarModel, batch: _Batch, members: dict[tuple[str, str], str], types: dict[str, str]) -> DataFrame:
    """The rows of one batch: ``visual``, the members of all visuals, and the batch's measures."""
    visuals = list(dict.fromkeys(v for v, _ in batch.asked))
    measures = list({m.name: m for _, m in batch.asked}.values())
    rows = model.scoped(batch.table, batch.ctx)
    keys: dict[str, Column] = {}  # columns of the fact that a branch joins or groups by
    plans = []
    for v in visuals:
        if v.group_table is None or (v.group_table != batch.table and model.path(v.group_table, batch.table) is None):
            plans.append((v, None, None))  # a card, or a chart whose axis doesn't reach the fact
        elif v.group_table == batch.table:
            keys |= {c: F.col(c) for c in v.group_cols}
            plans.append((v, None, v.group_cols))
        else:
            col, mapping = model.group_mapping(v.group_table, v.group_cols, batch.table, batch.ctx)
            keys[col] = F.col(col)
            plans.append((v, (col, mapping), None))
    # One pre-aggregation, by all keys that the branches need.
    by = [c.alias(f"__g_{n}") for n, c in keys.items()]
    if batch.decomposable:
        values = [f"__p{i}" for i in range(len(measures))]
        pre = rows.groupBy(*by).agg(*[m.partial_agg().alias(n) for m, n in zip(measures, values, strict=True)])
    else:
        values = ["__p0"]
        pre = rows.select(*by, F.col(measures[0].column).alias("__p0")).distinct()
    branches = []
    for v, mapped, own in plans:
        source, found = pre, {}
        if mapped is not None:
            key, mapping = f"__g_{mapped[0]}", mapped[1]
            renamed = mapping.select("__gkey", *[F.col(c).alias(f"__m_{c}") for c in v.group_cols])
            source = pre.join(renamed, F.col(key) == F.col("__gkey"), "left")
            found = {c: F.col(f"__m_{c}") for c in v.group_cols}
        elif own is not None:
            found = {c: F.col(f"__g_{c}") for c in own}
        cells = [found[c].alias(n) if v.group_table == t and c in found else F.lit(None).cast(types[n]).alias(n) for (t, c), n in members.items()]
        branches.append(source.select(F.lit(v.name).alias("visual"), *cells, *values))
    grouped = _stacked(branches).groupBy("visual", *members.values())
    finals = [m.final(n) for m, n in zip(measures, values if batch.decomposable else ["__p0"] * len(measures), strict=True)]
    answer = grouped.agg(*finals)
    asked = {m.name: [v.name for v, x in batch.asked if x.name == m.name] for m in measures}
    only = [F.when(F.col("visual").isin(asked[m.name]), F.col(m.name)).alias(m.name) for m in measures]
    return answer.select("visual", *members.values(), *only)


def evaluate_visuals(model: StarModel, ctx: FilterContext, visuals: Sequence[Visual], catalog: Catalog) -> DataFrame:
    """One row per card and per member of each chart: ``visual``, a column per group column (null in
    the rows of other visuals) and a column per measure. Charts whose axis doesn't reach a measure's
    table show its total once, under a null member."""
    if len({v.name for v in visuals}) < len(visuals):
        raise ValueError("visuals need names of their own")
    members: dict[tuple[str, str], str] = {}
    types: dict[str, str] = {}
    for v in visuals:
        for c in v.group_cols:
            name = c if c not in types else f"{v.group_table}_{c}"
            name = members.setdefault((v.group_table, c), name)  # type: ignore[arg-type]
            types[name] = model.tables[v.group_table].schema[c].dataType.simpleString()  # type: ignore[index]
    batches, derived = _batches(model, ctx, visuals, catalog)
    names = list({m.name: m for b in batches for _, m in b.asked})
    cards = [v.name for v in visuals if v.group_table is None]
    answers = [_answer(model, b, members, types) for b in batches]
    if cards:  # a card over no rows is blank, but there
        spark = answers[0].sparkSession
        seeds = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in cards])).alias("visual"))
        answers.append(seeds.select("visual", *[F.lit(None).cast(types[n]).alias(n) for n in members.values()]))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), answers)
    row = every.groupBy("visual", *members.values()).agg(*[F.first(F.col(n), ignorenulls=True).alias(n) for n in names])
    row = row.filter(F.coalesce(F.col("visual").isin(cards), F.lit(False)) | F.coalesce(*[F.col(n) for n in names]).isNotNull())
    done: set[str] = set()
    for v in visuals:
        for d in derived[v.name]:
            if d.name not in done:
                row = row.withColumn(d.name, d.column())
                done.add(d.name)
    asked = list(dict.fromkeys(n for v in visuals for n in v.measures))
    shown = [F.when(F.col("visual").isin([v.name for v in visuals if n in v.measures]), F.col(n)).alias(n) for n in asked]
    return row.select("visual", *members.values(), *shown)


__all__ = ["Visual", "evaluate_visuals"]
