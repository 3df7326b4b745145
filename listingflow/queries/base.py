"""Registry of queries on the driver's tables, each with the SQL it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# SQL of derived tables: text that Spark and DuckDB both read
DERIVED: dict[str, str] = {}


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


class Tables:
    """Driver tables of one folder, and tables derived from them by SQL."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._scans: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name not in self._scans:
                self._scans[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            return self._scans[name]
        if name in DERIVED:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over driver and derived tables."""
        text = with_derived(text)
        used = sorted(t for t in TABLES if re.search(rf"\b{t}\b", text))
        marked = re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(used)})\b", r"\1 {\2}", text)
        return self.spark.sql(marked, **{t: getattr(self, t) for t in used})


def _needs(text: str) -> list[str]:
    return [n for n in DERIVED if re.search(rf"\b{n}\b", text)]


def with_derived(text: str) -> str:
    """The statement with the derived tables it uses (and those they use) as a WITH clause."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in _needs(body):
            if name not in order:
                visit(DERIVED[name])
                order.append(name)

    visit(text)
    if not order:
        return text
    clauses = ", ".join(f"{n} AS ({DERIVED[n]})" for n in order)
    body = text.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {clauses}, {body[5:]}"
    return f"WITH {clauses} {body}"


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name with its SQL."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        text = None if sql is None else with_derived(sql)
        QUERIES[name] = Query(lambda spark, folder: fn(Tables(spark, folder)), text)
        return fn

    return add


def quoted(text: str | None) -> str:
    """A SQL text literal that both engines read alike."""
    if text is None:
        return "NULL"
    parts = ["'" + p.replace("'", "''") + "'" for p in text.split("\\")]
    return "(" + " || chr(92) || ".join(parts) + ")" if len(parts) > 1 else parts[0]


def cases(number: str, values: Sequence[str | None]) -> str:
    """A CASE that spreads text values over rows by a whole number."""
    arms = " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {arms} END"


def duck_fold(expr: str, rules: Iterable[Sequence[str]]) -> str:
    """Nested DuckDB replacements of ordered rules."""
    for pattern, replacement in rules:
        expr = f"regexp_replace({expr}, {duck(pattern)}, {duck(replacement)}, 'g')"
    return expr


def duck(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
