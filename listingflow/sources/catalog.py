"""Logical table names bound to paths, snapshots, JDBC tables or frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.operators.snapshots import SnapshotTable
from listingflow.functions.text import long_key
from listingflow.sources.jdbc import JdbcSource, read_jdbc_query, read_jdbc_table
from listingflow.sources.predicates import MOST_SPELLED, id_conditions


class TableMissing(LookupError):
    """The logical table is unbound, or its path or table does not exist."""


_MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def _chosen(df: DataFrame, column: str, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id, read as a whole number, is among the chosen ones."""
    wanted = ids.select(F.col(key).cast("long").alias("_chosen"))
    return df.join(wanted, long_key(df, column) == F.col("_chosen"), "left_semi")


@dataclass
class Catalog:
    """Names used by the jobs, and where their rows come from.

    ``columns`` maps a physical column name to the logical one, so tables with
    other column names need no copy.
    """

    spark: SparkSession
    _readers: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    _columns: dict[str, Mapping[str, str]] = field(default_factory=dict)
    _conditional: dict[str, Callable[[Sequence[str]], DataFrame]] = field(default_factory=dict)

    def bind(self, name: str, reader: Callable[[], DataFrame], columns: Mapping[str, str] | None = None) -> "Catalog":
        self._readers[name] = reader
        self._columns[name] = columns or {}
        self._conditional.pop(name, None)
        return self

    def bind_frame(self, name: str, df: DataFrame, columns: Mapping[str, str] | None = None) -> "Catalog":
        return self.bind(name, lambda: df, columns)

    def bind_path(self, name: str, path: str, fmt: str = "parquet", columns: Mapping[str, str] | None = None, **options):
        return self.bind(name, lambda: self.spark.read.format(fmt).options(**options).load(path), columns)

    def bind_table(self, name: str, table: str, columns: Mapping[str, str] | None = None) -> "Catalog":
        return self.bind(name, lambda: self.spark.table(table), columns)

    def bind_snapshot(self, name: str, root: str, columns: Mapping[str, str] | None = None) -> "Catalog":
        return self.bind(name, SnapshotTable(self.spark, root).read, columns)

    def bind_jdbc(
        self, name: str, source: JdbcSource, table: str | None = None, query: str | None = None,
        columns: Mapping[str, str] | None = None, **split,
    ) -> "Catalog":
        def read() -> DataFrame:
            if query:
                return read_jdbc_query(self.spark, source, query, **split)
            return read_jdbc_table(self.spark, source, table or name, **split)

        self.bind(name, read, columns)
        if query is None:
            self._conditional[name] = lambda conditions: read_jdbc_table(
                self.spark, source, table or name, fetch_size=split.get("fetch_size", 10_000), predicates=conditions)
        return self

    def bind_conditional(self, name: str, reader: Callable[[Sequence[str]], DataFrame], columns: Mapping[str, str] | None = None) -> "Catalog":
        """A table whose reader takes conditions, one for each partition; ``1 = 1`` stands for the whole."""
        self.bind(name, lambda: reader(["1 = 1"]), columns)
        self._conditional[name] = reader
        return self

    def restricted(self, ids: DataFrame, keys: Mapping[str, str], key: str = "id", most: int = MOST_SPELLED) -> "Catalog":
        """A copy in which tables of ``keys`` (table to id column) read the chosen ids only.

        Where the source takes conditions they reach it, as lists or ranges of
        the ids, and a semi-join leaves out what ranges hold besides; elsewhere
        the semi-join does it all. Unbound tables stay unbound.
        """
        copy = Catalog(self.spark, dict(self._readers), dict(self._columns), dict(self._conditional))
        for name, column in keys.items():
            if name not in self._readers:
                continue
            physical = {v: k for k, v in self._columns.get(name, {}).items()}.get(column, column)
            if name in self._conditional:
                conditions = id_conditions(ids, key, physical, most)
                copy._readers[name] = lambda read=self._conditional[name], c=conditions: read(c)
            inner = copy._readers[name]
            copy._readers[name] = lambda inner=inner, column=physical: _chosen(inner(), column, ids, key)
        return copy

    def overlay(self, **frames: DataFrame) -> "Catalog":
        """A copy in which some tables are planned frames instead of stored ones."""
        copy = Catalog(self.spark, dict(self._readers), dict(self._columns), dict(self._conditional))
        for name, df in frames.items():
            copy.bind_frame(name, df)
        return copy

    def read(self, name: str) -> DataFrame:
        """Whole-table scan; pruning and filters are left to the plan that uses it."""
        if name not in self._readers:
            raise TableMissing(name)
        try:
            df = self._readers[name]()
        except FileNotFoundError as err:
            raise TableMissing(name) from err
        except AnalysisException as err:
            if err.getCondition() in _MISSING:
                raise TableMissing(name) from err
            raise
        names = self._columns.get(name)
        return df.withColumnsRenamed(dict(names)) if names else df

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        """The table, or a typed empty frame when it does not exist; other errors are raised."""
        try:
            return self.read(name)
        except TableMissing:
            return self.spark.createDataFrame([], schema)

    def query(self, sql: str, **tables: str) -> DataFrame:
        """SQL over logical tables: ``query("SELECT … FROM {t}", t="name")``."""
        return self.spark.sql(sql, **{alias: self.read(name) for alias, name in tables.items()})
