"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_lake.llm.common import drop_table, materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node links its larger neighbours (large star), or its smaller neighbours and
    itself (small star), to the smallest node that it sees."""
    both = edges.select("a", "b")
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (any ordered type): ``root`` is the
    smallest node reachable. Every round is written to the shared folder."""
    kept = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    table, known = materialise(kept, "edges"), None
    for _ in range(max_rounds):
        state = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known or not state[0]:
            break
        known = state
        step = materialise(_stars(_stars(table, large=True), large=False), "edges")
        drop_table(table)
        table = step
    else:
        raise RuntimeError(f"no convergence in {max_rounds} rounds")
    return table.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(table.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
