"""Conditions that a partitioned database read sends along, one for each partition."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids that are spelled out; more are covered by ranges. Ids of one IN list.
MOST_SPELLED, CHUNK = 5_000, 1_000

Value = int | float | Decimal | str | dt.date | dt.datetime


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: Value) -> str:
    """A value as SQL text that databases and Spark read alike."""
    if isinstance(value, bool):
        raise ValueError("no literal for a truth value")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return f"'{value}'"
    if "\\" in value:
        raise ValueError(f"backslash in a literal: {value!r}")
    return "'" + value.replace("'", "''") + "'"


def in_lists(column: str, values: Sequence[Value], chunk: int = CHUNK) -> list[str]:
    """IN conditions over the distinct values in order, ``chunk`` of them each."""
    values = sorted(set(values))
    return [f"{quoted(column)} IN ({', '.join(map(literal, values[i:i + chunk]))})" for i in range(0, len(values), chunk)]


def half_open(column: str, bounds: Sequence[Value], nulls: bool = True) -> list[str]:
    """Conditions that hold every row once: below the first bound, between neighbours, from the last one on.

    Rows without a value go with the first, or nowhere if ``nulls`` is false.
    """
    c, bounds = quoted(column), sorted(set(bounds))
    if not bounds:
        return ["1 = 1" if nulls else f"{c} IS NOT NULL"]
    first = f"{c} < {literal(bounds[0])}"
    between = [f"{c} >= {literal(a)} AND {c} < {literal(b)}" for a, b in zip(bounds, bounds[1:], strict=False)]
    return [f"({first} OR {c} IS NULL)" if nulls else first, *between, f"{c} >= {literal(bounds[-1])}"]


def quantile_bounds(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[Value]:
    """At most ``parts`` - 1 values that cut the rows into about equal parts, whatever gaps and clusters the keys have.

    ``keys`` is any frame with the column: the last copy of the table, or a scan
    of that column alone. Numbers, dates and times are cut; without values there is no bound.
    """
    if parts < 2:
        return []
    col = F.col(quoted(column))
    kind = dict(keys.dtypes)[column]
    # dates and times as whole numbers: the aggregate keeps a sketch, not the rows
    number = F.unix_date(col) if kind == "date" else F.unix_micros(col.cast("timestamp")) if kind.startswith("timestamp") else col
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = keys.agg(F.percentile_approx(number, shares, F.lit(accuracy)).alias("q")).head()["q"]
    values = sorted(set(found or []))
    if kind == "date":
        return [dt.date(1970, 1, 1) + dt.timedelta(days=v) for v in values]
    if kind.startswith("timestamp"):
        frame = keys.sparkSession.createDataFrame([(v,) for v in values], "v long")
        return [r[0] for r in frame.select(F.timestamp_micros("v").cast("timestamp_ntz")).orderBy(F.timestamp_micros("v")).collect()]
    return values


def month_bounds(first: dt.date, last: dt.date, months: int = 1) -> list[dt.date]:
    """Firsts of every ``months``-th month after ``first``, up to ``last``."""
    out, year, month = [], first.year, first.month
    while True:
        year, month = year + (month - 1 + months) // 12, (month - 1 + months) % 12 + 1
        if (day := dt.date(year, month, 1)) > last:
            return out
        out.append(day)


def id_conditions(ids: DataFrame, key: str, column: str, most: int = MOST_SPELLED, chunk: int = CHUNK, ranges: int = 64) -> list[str]:
    """Conditions on ``column`` under which every row of the ids (column ``key``) is read, and as few others as can be.

    Up to ``most`` ids are spelled out. More are covered by the ranges between
    quantiles of the ids, from the least id to the greatest; what else lies
    there is for a semi-join to leave out. No ids give a condition that never holds.
    """
    own = ids.select(F.col(quoted(key)).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    some = [r.id for r in own.limit(most + 1).collect()]
    if len(some) <= most:
        return in_lists(column, some, chunk) or ["1 = 0"]
    edge = own.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).head()
    cuts = [edge["lo"], *[b for b in quantile_bounds(own, "id", ranges) if edge["lo"] < b <= edge["hi"]], edge["hi"] + 1]
    c = quoted(column)
    return [f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
