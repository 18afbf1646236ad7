"""The set of lifecycle tables that reports and checks run on."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from subtide.schemas import TABLES
from subtide.sources import read_table

Source = DataFrame | Callable[[], DataFrame]


class Lifecycle:
    """Eight tables by name and the reporting cutoff.

    A table is given as a DataFrame, or as a function that is called on first use, so a report
    only sets up the tables it reads.
    """

    def __init__(self, cutoff: str, **tables: Source):
        if missing := TABLES.keys() - tables.keys():
            raise ValueError(f"missing tables: {sorted(missing)}")
        self.cutoff = cutoff
        self._sources = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._sources:
            raise AttributeError(name)
        source = self._sources[name]
        df = source() if callable(source) else source
        setattr(self, name, df)
        return df

    @classmethod
    def read(cls, spark: SparkSession, folder: str, cutoff: str) -> Lifecycle:
        """Open the eight tables stored as ``<folder>/<table>.parquet``, by their declared types."""
        return cls(
            cutoff,
            **{
                name: partial(read_table, spark, folder, name, table.ddl)
                for name, table in TABLES.items()
            },
        )

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}
