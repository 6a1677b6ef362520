"""Quality counters of a write, taken while it runs.

A check of its own reads its table again. Here the frames that a layer write runs anyway carry
observed metrics (``DataFrame.observe``): rows read, rows written, values that a step turned to null
and null keys are counted by the tasks of the write itself, and come back with the job. Nothing is
scanned or shuffled for them. Counting rows read keeps a step's row filter above the scan, so that
the dropped rows are seen.

Counters are those of a write that succeeded; a task that runs again counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


class QualityCounters:
    """Collects the counters of several writes; ``report`` gives them per table after the writes."""

    def __init__(self) -> None:
        self._seen: dict[str, list[Observation]] = {}

    def _observe(self, table: str, df: DataFrame, metrics: dict) -> DataFrame:
        observation = Observation()
        self._seen.setdefault(table, []).append(observation)
        return df.observe(observation, *[c.alias(n) for n, c in metrics.items()])

    def step(self, table: str, source: DataFrame, step: Step, not_null: Sequence[str] = ()) -> DataFrame:
        """``step(source)`` with ``rows_in``, ``rows_out``, ``nulled_<column>`` (values that the step
        made null, for columns that it keeps in their place, renamed or not) and ``null_<column>``
        for columns that are not to be null."""
        before = source.columns
        carried = [f"__before_{i}" for i in range(len(before))]
        counted = self._observe(table, source, {"rows_in": F.count(F.lit(1))})
        out = step(counted.select("*", *[F.col(f"`{c}`").alias(k) for c, k in zip(before, carried, strict=True)]))
        after = out.columns[: len(before)]
        metrics = {"rows_out": F.count(F.lit(1))}
        if out.columns[len(before) : 2 * len(before)] == carried:
            for name, old in zip(after, carried, strict=True):
                metrics[f"nulled_{name}"] = F.count_if(F.col(old).isNotNull() & F.col(f"`{name}`").isNull())
        metrics |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in not_null}
        return self._observe(table, out, metrics).drop(*carried)

    def output(self, table: str, df: DataFrame, not_null: Sequence[str] = ()) -> DataFrame:
        """``df`` with ``rows_out`` and ``null_<column>``."""
        return self._observe(table, df, {"rows_out": F.count(F.lit(1))} | {f"null_{c}": F.count_if(F.col(c).isNull()) for c in not_null})

    def report(self) -> dict[str, dict[str, int]]:
        """Per table its counters, with ``rows_dropped`` where rows were read and written."""
        found: dict[str, dict[str, int]] = {}
        for table, observations in self._seen.items():
            counters: dict[str, int] = {}
            for o in observations:
                counters |= o.get
            if "rows_in" in counters:
                counters["rows_dropped"] = counters["rows_in"] - counters["rows_out"]
            found[table] = counters
        return found


__all__ = ["QualityCounters"]
