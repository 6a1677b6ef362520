"""A mapping of table name -> DataFrame whose frames are built on first access.

Building a DataFrame is cheap in data terms but not free: every API call is analysed on the
driver. A query that needs two gold tables should not pay for analysing thirteen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyFrames(Mapping[str, DataFrame]):
    def __init__(self, factories: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._factories = dict(factories)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)

    def __contains__(self, name: object) -> bool:
        return name in self._factories


__all__ = ["LazyFrames"]
