"""Incremental batch reads: which source rows belong to this run.

The jobs have no streams; a run is a batch bounded below by a date or by what
was written last. Bounds are literals or one-row subqueries, so they reach the
scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V


def as_date(run_date: str | dt.date) -> dt.date:
    return run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(run_date)


def days_back(run_date: str | dt.date, days: int) -> dt.date:
    return as_date(run_date) - dt.timedelta(days=days)


def since_instant(col: Column, run_date: str | dt.date, days: int, inclusive: bool = False) -> Column:
    """Later than midnight ``days`` before the run: later hours of that day count."""
    bound = F.lit(days_back(run_date, days))
    return col >= bound if inclusive else col > bound


def after_day(col: Column, bound: str | dt.date) -> Column:
    """Strictly after the whole day, written as a bare column comparison so it can be pushed down."""
    return col >= F.lit(as_date(bound) + dt.timedelta(days=1))


def month_anchor(run_date: str | dt.date, back_days: int = 0, day: int = 1) -> dt.date:
    """A fixed day in the month that holds the date ``back_days`` before the run."""
    return days_back(run_date, back_days).replace(day=day)


def high_water_mark(
    df: DataFrame, column: str, where: Column, default: str = V.EARLIEST_MARK
) -> DataFrame:
    """One row: the largest value among the rows that qualify, or the default, as a date."""
    return df.where(where).agg(
        F.coalesce(F.max(F.col(column)).cast("date"), F.lit(default).cast("date")).alias("mark")
    )


def newer_than_mark(df: DataFrame, column: str, mark: DataFrame) -> DataFrame:
    """Rows later than the mark's midnight; the mark is read as a scalar subquery, not collected."""
    kind = dict(df.dtypes)[column]
    return df.where(F.col(column) > mark.select(F.col("mark").cast(kind)).scalar())
