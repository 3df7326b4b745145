"""JDBC scans and the staged merge into a database table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from listingflow.operators.merge import one_source_row
from listingflow.session import SOURCE_ZONE


@dataclass(frozen=True)
class JdbcSource:
    """Connection of one logical database."""

    host: str = "localhost"
    port: int = 3306
    database: str = ""
    user: str = ""
    password: str = field(default="", repr=False)
    charset: str = "utf8"
    url: str | None = None
    driver: str = "com.mysql.cj.jdbc.Driver"

    def jdbc_url(self) -> str:
        """Zero dates read as NULL, text in the given charset, times in the sources' zone."""
        if self.url:
            return self.url
        params = {
            "useSSL": "false",
            "characterEncoding": self.charset,
            "zeroDateTimeBehavior": "convertToNull",
            "serverTimezone": SOURCE_ZONE,
            # without it the driver buffers a whole result, whatever fetchsize says
            "useCursorFetch": "true",
        }
        tail = "&".join(f"{k}={v}" for k, v in params.items())
        return f"jdbc:mysql://{self.host}:{self.port}/{self.database}?{tail}"


def jdbc_options(source: JdbcSource, **extra) -> dict[str, str]:
    options = {
        "url": source.jdbc_url(), "user": source.user, "password": source.password,
        "driver": source.driver,
    }
    return options | {k: str(v) for k, v in extra.items() if v is not None}


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def split_options(
    spark: SparkSession, source: JdbcSource, relation: str, split_on: str | None,
    partitions: int | None, bounds: tuple | None,
) -> dict[str, object]:
    """Options for a parallel scan; missing bounds are asked from the database (one row)."""
    if split_on is None:
        return {}
    if bounds is None:
        edge = f"(SELECT MIN({_quote(split_on)}) AS lo, MAX({_quote(split_on)}) AS hi FROM {relation}) AS _edge"
        row = spark.read.format("jdbc").options(**jdbc_options(source, dbtable=edge)).load().first()
        if row is None or row[0] is None:
            return {}
        bounds = (row[0], row[1])
    return {
        "partitionColumn": split_on, "lowerBound": bounds[0], "upperBound": bounds[1],
        "numPartitions": partitions or spark.sparkContext.defaultParallelism,
    }


def read_jdbc_table(
    spark: SparkSession, source: JdbcSource, table: str, split_on: str | None = None,
    partitions: int | None = None, bounds: tuple | None = None, fetch_size: int = 10_000,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table; with ``predicates`` one partition for each of these conditions, which the database applies."""
    relation = _quote(table)
    if predicates is not None:
        options = jdbc_options(source, fetchsize=fetch_size)
        return spark.read.jdbc(options.pop("url"), relation, predicates=list(predicates), properties=options)
    split = split_options(spark, source, relation, split_on, partitions, bounds)
    options = jdbc_options(source, dbtable=relation, fetchsize=fetch_size, **split)
    return spark.read.format("jdbc").options(**options).load()


def read_jdbc_query(
    spark: SparkSession, source: JdbcSource, sql: str, split_on: str | None = None,
    partitions: int | None = None, bounds: tuple | None = None, fetch_size: int = 10_000,
) -> DataFrame:
    relation = f"({sql}) AS _sub"
    split = split_options(spark, source, relation, split_on, partitions, bounds)
    options = jdbc_options(source, dbtable=relation, fetchsize=fetch_size, **split)
    return spark.read.format("jdbc").options(**options).load()


#: The database's own names: replaced rows and inserted ones, by merge mode.
MODES = ("upsert", "replace", "insert_ignore", "insert_numbered", "keep_id", "update", "delete", "truncate")


def merge_statements(
    table: str, staging: str, columns: Sequence[str], mode: str, keys: Sequence[str] = (), set_columns: Sequence[str] = (),
    surrogate: str = "id",
) -> list[str]:
    """Statements that merge a staging table into a table whose unique key is ``keys``.

    ``keep_id`` and ``insert_numbered`` leave the surrogate to the table's own
    counter; ``truncate`` swaps the two tables in one step.
    """
    target, source = _quote(table), _quote(staging)
    if mode in ("keep_id", "insert_numbered"):
        columns = [c for c in columns if c != surrogate]
    names = ", ".join(_quote(c) for c in columns)
    body = f"INTO {target} ({names}) SELECT {names} FROM {source}"
    on = " AND ".join(f"t.{_quote(k)} = s.{_quote(k)}" for k in keys)
    if mode in ("upsert", "keep_id"):
        updates = ", ".join(f"{_quote(c)}=VALUES({_quote(c)})" for c in columns if c not in keys or mode == "upsert")
        return [f"INSERT {body} ON DUPLICATE KEY UPDATE {updates}"]
    if mode == "replace":
        return [f"REPLACE {body}"]
    if mode in ("insert_ignore", "insert_numbered"):
        return [f"INSERT IGNORE {body}"]
    if mode in ("update", "delete") and not keys:
        raise ValueError(f"{mode} needs keys")
    if mode == "update":
        sets = ", ".join(f"t.{_quote(c)} = s.{_quote(c)}" for c in set_columns)
        return [f"UPDATE {target} t JOIN {source} s ON {on} SET {sets}"]
    if mode == "delete":
        return [f"DELETE t FROM {target} t JOIN {source} s ON {on}"]
    if mode == "truncate":
        old = _quote(f"{staging}_old")
        return [f"RENAME TABLE {target} TO {old}, {source} TO {target}", f"DROP TABLE {old}"]
    raise ValueError(f"mode: {mode!r}")


def _execute(spark: SparkSession, source: JdbcSource, *statements: str) -> None:
    jvm = spark._jvm
    jvm.java.lang.Class.forName(source.driver)
    connection = jvm.java.sql.DriverManager.getConnection(source.jdbc_url(), source.user, source.password)
    try:
        for text in statements:
            statement = connection.createStatement()
            statement.execute(text)
            statement.close()
    finally:
        connection.close()


@dataclass(frozen=True)
class JdbcSink:
    """A database table as the sink of planned changes: rows are staged in parallel, then merged by statements.

    The staging table has the target's layout, so the database checks what the
    rows must satisfy, and goes whatever happens. ``plan`` is what ``take`` runs.
    """

    spark: SparkSession
    source: JdbcSource
    table: str
    batch: int = 2_000

    def plan(self, change, staging: str) -> list[str]:
        """All statements in order; the rows are appended after the first one."""
        if change.when is not None:
            raise ValueError(f"a condition on rows of {self.table} is no statement")
        columns = list(change.rows.columns)
        return [
            f"CREATE TABLE {_quote(staging)} LIKE {_quote(self.table)}",
            *merge_statements(self.table, staging, columns, change.mode, change.keys, change.columns),
            f"DROP TABLE IF EXISTS {_quote(staging)}",
        ]

    def staged_rows(self, change) -> DataFrame:
        """One row per key: what the database would otherwise settle by the order of arrival."""
        how = "first" if change.mode in ("insert_ignore", "update", "truncate", "insert_numbered") else change.on_duplicate
        rows = change.rows
        if change.mode == "update":
            rows = rows.select(*change.keys, *change.columns)
        if change.mode == "delete":
            return rows.select(*change.keys).distinct()
        return one_source_row(rows, list(change.keys), how, list(change.order) or None)

    def take(self, change, target=None) -> str:
        staging = f"_stage_{self.table}_{uuid.uuid4().hex[:8]}"
        create, *merge, drop = self.plan(change, staging)
        _execute(self.spark, self.source, create)
        try:
            options = jdbc_options(self.source, dbtable=_quote(staging), batchsize=self.batch)
            self.staged_rows(change).write.format("jdbc").options(**options).mode("append").save()
            _execute(self.spark, self.source, *merge)
        finally:
            _execute(self.spark, self.source, drop)
        return self.table

    def read(self) -> DataFrame:
        return read_jdbc_table(self.spark, self.source, self.table)
