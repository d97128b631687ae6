"""A read-only mapping of named DataFrames built on first access."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping):
    """Read-only mapping whose tables are built on first access only."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
