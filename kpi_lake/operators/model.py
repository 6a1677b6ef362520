"""Relationship model: which filters reach which table, and how.

Relationships are many-to-one key pairs. A filter always flows from the one side to the many
side; it flows back only over a relationship marked ``both_directions``. A table is *scoped*
under a context by its own predicates plus one ``left_semi`` join per relationship through
which some filter arrives. Semi joins never multiply rows, so a measure over a scoped table is
never inflated by a join.

Join strategy is left to Spark: the distinct keys of calendar dimensions get a broadcast hint.
Their type is checked: a DATE key has at most ~3.65 million distinct values (years 1-9999), i.e.
tens of MB even when the source holds garbage dates, and in practice a few thousand; a calendar
with any other key type is refused. Every other dimension is left to AQE, which broadcasts a
side only after measuring it below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps
a shuffle join (with skewed partitions split).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from kpi_lake.operators.context import FilterContext, ranges_predicate


@dataclass(frozen=True)
class Relationship:
    many: str
    many_col: str
    one: str
    one_col: str
    both_directions: bool = False
    one_unique: bool = True  # the one side's key is declared unique

    def __str__(self) -> str:
        arrow = "<->" if self.both_directions else "->"
        return f"{self.many}.{self.many_col} {arrow} {self.one}.{self.one_col}"


@dataclass(frozen=True)
class Hop:
    """Filter flow over one relationship: rows of ``src`` restrict rows of ``dst``."""

    rel: Relationship
    src: str
    src_col: str
    dst: str
    dst_col: str


class StarModel:
    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        relationships: Sequence[Relationship],
        calendar_tables: Iterable[str] = (),
    ) -> None:
        self.tables = tables  # may be lazy: a table is only built when a query touches it
        self.relationships = list(relationships)
        self.calendar_tables = set(calendar_tables)
        for r in self.relationships:
            for t in (r.many, r.one):
                if t not in tables:
                    raise KeyError(f"relationship {r} names unknown table {t}")

    # --- graph ---------------------------------------------------------------------------------
    def inbound(self, table: str) -> list[Hop]:
        """Hops through which a filter can arrive at ``table``."""
        hops = []
        for r in self.relationships:
            if r.many == table:
                hops.append(Hop(r, r.one, r.one_col, r.many, r.many_col))
            elif r.one == table and r.both_directions:
                hops.append(Hop(r, r.many, r.many_col, r.one, r.one_col))
        return hops

    def outbound(self, table: str) -> list[Hop]:
        """Hops through which a filter on ``table`` leaves it."""
        hops = []
        for r in self.relationships:
            if r.one == table:
                hops.append(Hop(r, r.one, r.one_col, r.many, r.many_col))
            elif r.many == table and r.both_directions:
                hops.append(Hop(r, r.many, r.many_col, r.one, r.one_col))
        return hops

    def reaches(self, src: str, dst: str) -> bool:
        return src == dst or self.path(src, dst) is not None

    def path(self, src: str, dst: str) -> list[Hop] | None:
        """Shortest filter-flow path from ``src`` to ``dst`` (breadth first, no edge reused)."""
        if src == dst:
            return []
        queue: deque[tuple[str, list[Hop]]] = deque([(src, [])])
        seen = {src}
        while queue:
            table, hops = queue.popleft()
            for hop in self.outbound(table):
                if hop.dst in seen:
                    continue
                nxt = hops + [hop]
                if hop.dst == dst:
                    return nxt
                seen.add(hop.dst)
                queue.append((hop.dst, nxt))
        return None

    # --- scoping -------------------------------------------------------------------------------
    def _filtered(self, table: str, ctx: FilterContext, came_by: Relationship | None, seen: frozenset) -> bool:
        if ctx.predicate_for(table) is not None:
            return True
        return any(
            self._filtered(h.src, ctx, h.rel, seen | {h.rel})
            for h in self.inbound(table)
            if h.rel is not came_by and h.rel not in seen
        )

    def is_filtered(self, table: str, ctx: FilterContext) -> bool:
        """Does any filter of ``ctx`` reach ``table``?"""
        return self._filtered(table, ctx, None, frozenset())

    def _key_frame(self, hop: Hop, ctx: FilterContext, seen: frozenset) -> DataFrame:
        keys = self._scoped(hop.src, ctx, hop.rel, seen | {hop.rel}).select(F.col(hop.src_col).alias("__key"))
        return self.bounded(hop.src, hop.src_col, keys.distinct(), "__key") if hop.src in self.calendar_tables else keys

    def bounded(self, calendar: str, key: str, frame: DataFrame, name: str) -> DataFrame:
        """A frame with one row per key of a calendar table, to be broadcast. Only a DATE key bounds
        its size (a timestamp could differ in every row), so other types are refused."""
        kind = frame.schema[name].dataType
        if not isinstance(kind, DateType):
            raise TypeError(f"calendar {calendar}.{key} must be a date, not {kind.simpleString()}")
        return F.broadcast(frame)

    def _scoped(self, table: str, ctx: FilterContext, came_by: Relationship | None, seen: frozenset) -> DataFrame:
        df = self.tables[table]
        pred = ctx.predicate_for(table)
        if pred is not None:
            df = df.filter(pred)
        for hop in self.inbound(table):
            if hop.rel is came_by or hop.rel in seen:
                continue
            if not self._filtered(hop.src, ctx, hop.rel, seen | {hop.rel}):
                continue
            if hop.src in self.calendar_tables:
                # Literal date ranges on the calendar key (or selected periods, as ranges) are repeated
                # on the fact's date column: the scan can skip files / row groups; the semi join
                # below keeps it exact.
                ranges = ctx.key_ranges(hop.src, hop.src_col)
                pred = ranges_predicate(hop.dst_col, ranges) if ranges is not None else None
                if pred is not None:
                    df = df.filter(pred)
            keys = self._key_frame(hop, ctx, seen)
            df = df.join(keys, F.col(hop.dst_col) == F.col("__key"), "left_semi")
        return df

    def scoped(self, table: str, ctx: FilterContext) -> DataFrame:
        """Rows of ``table`` visible under ``ctx``."""
        return self._scoped(table, ctx, None, frozenset())

    def marked(self, table: str, ctx: FilterContext, selection: FilterContext, name: str) -> DataFrame:
        """Rows of ``table`` visible under ``ctx``, with a flag: also visible under ``selection``. The
        selection's keys arrive by left joins on distinct keys, so no row is dropped or repeated."""
        df = self.scoped(table, ctx)
        pred = selection.predicate_for(table)
        flag = F.lit(True) if pred is None else F.coalesce(pred, F.lit(False))
        df = df.withColumn(name, flag)
        for i, hop in enumerate(self.inbound(table)):
            if not self._filtered(hop.src, selection, hop.rel, frozenset({hop.rel})):
                continue
            keys = self._key_frame(hop, selection, frozenset()).distinct().select(F.col("__key").alias(f"__key{i}"))
            joined = df.join(keys, F.col(hop.dst_col) == F.col(f"__key{i}"), "left")
            df = joined.withColumn(name, F.col(name) & F.col(f"__key{i}").isNotNull()).drop(f"__key{i}")
        return df

    # --- grouping across tables ----------------------------------------------------------------
    def group_mapping(self, group_table: str, group_cols: Sequence[str], target: str, ctx: FilterContext) -> tuple[str, DataFrame]:
        """Map rows of ``target`` to group values of ``group_table``.

        Returns (target join column, frame of [__gkey, *group_cols]). Where a key isn't declared
        unique, each of its different group values appears once, so a target row counts once in
        every group that it belongs to, as it does under a filter on that group. Only the group
        table is scoped here: any filter that reaches a table on the path also reaches the target,
        which the caller scopes.
        """
        hops = self.path(group_table, target)
        if hops is None:
            raise ValueError(f"filters on {group_table} do not reach {target}")
        if not hops:
            raise ValueError("group table and target are the same table")
        mapping = self.scoped(group_table, ctx).select(F.col(hops[0].src_col).alias("__gkey"), *group_cols)
        unique = self._unique(hops[0])
        if not unique:
            mapping = mapping.distinct()
        if group_table in self.calendar_tables:
            mapping = self.bounded(group_table, hops[0].src_col, mapping, "__gkey")
        for prev, hop in zip(hops, hops[1:]):
            # Rows of hop.src hold the key coming from the previous hop and the key of the next.
            step = self.tables[hop.src].select(F.col(prev.dst_col).alias("__prev"), F.col(hop.src_col).alias("__next"))
            mapping = step.join(mapping, F.col("__prev") == F.col("__gkey")).select(F.col("__next").alias("__gkey"), *group_cols)
            if not (unique and self._unique(hop)):
                unique, mapping = False, mapping.distinct()
        return hops[-1].dst_col, mapping

    @staticmethod
    def _unique(hop: Hop) -> bool:
        """Whether the key that a hop leaves by is declared unique in its source table."""
        return hop.rel.one_unique and hop.src == hop.rel.one


__all__ = ["Hop", "Relationship", "StarModel"]
