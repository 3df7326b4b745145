"""Plausibility rules, guards and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.functions.listing import day


def price_gap_ok(
    guide: Column, paid: Column, of_paid: float = V.MAX_GAP_OF_PAID, of_guide: float = V.MAX_GAP_OF_GUIDE
) -> Column:
    """Both prices set and their gap at most 3 times the paid and 2 times the guide price."""
    guide, paid = guide.try_cast("double"), paid.try_cast("double")
    gap = F.abs(guide - paid)
    return (
        (guide != 0) & (paid != 0)
        & (F.try_divide(gap, paid) <= of_paid) & (F.try_divide(gap, guide) <= of_guide)
    )


def listing_ok(quote: Column, guide: Column, age: Column, registered: Column, run_date: str) -> Column:
    """Asking price, age and registration date of a listing are plausible on ``run_date``."""
    ratio = F.try_divide(quote.try_cast("double"), guide.try_cast("double"))
    registered = day(registered)
    return (
        (ratio > V.MIN_PRICE_RATIO) & (ratio < V.MAX_PRICE_RATIO)
        & ((age < 1) | (ratio < V.USED_PRICE_RATIO))
        & (registered > F.lit(V.EARLIEST_REGISTRATION).cast("date"))
        & (registered < F.lit(run_date).cast("date"))
    )


def eligible(
    status: Column | None = None, model_year: Column | None = None,
    price: Column | None = None, level: Column | None = None,
) -> Column:
    """Catalogue eligibility over the attributes given: on sale or sold, year known, priced, level known."""
    ok = F.lit(True)
    if status is not None:
        ok &= status != V.COMING_SOON
    if model_year is not None:
        ok &= model_year.isNotNull()
    if price is not None:
        # a text that is no number is no price
        ok &= price.try_cast("double") != 0
    if level is not None:
        ok &= level != V.UNKNOWN
    return ok


def approved(df: DataFrame) -> DataFrame:
    return df.where("is_check = 1")


def automatic_ids(col: Column, threshold: int = V.MANUAL_ID_THRESHOLD) -> Column:
    return col <= threshold


def split_on_threshold(
    df: DataFrame, column: str, threshold: int = V.MANUAL_ID_THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """Rows at or below the threshold, and the rest with a reason."""
    kept = df.where(F.col(column) <= threshold)
    refused = df.where(~F.coalesce(F.col(column) <= threshold, F.lit(False)))
    return kept, refused.withColumn("reason", F.lit(f"{column} above {threshold}"))


def require_some(kept: DataFrame, what: str) -> DataFrame:
    """The same frame; an error when every row was refused."""
    if kept.isEmpty():
        raise ValueError(f"no {what} left after removing manual entries")
    return kept


def explain_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the first rule a row breaks as its reason, NULL for a kept row; rules are in order."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(reason)
    return df.withColumn("reason", reason)


def shifted(emission: Column, fuel: Column) -> Column:
    """Columns slid sideways: emission is a bare number or fuel looks like a tyre size."""
    return F.coalesce(emission.cast("string"), F.lit("")).rlike(V.SHIFTED_EMISSION) | F.coalesce(
        fuel.cast("string"), F.lit("")
    ).rlike(V.SHIFTED_FUEL)


def shifted_rows(df: DataFrame, emission: str = "emission", fuel: str = "fuel") -> DataFrame:
    return df.where(shifted(F.col(emission), F.col(fuel)))


def coverage(requested: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """How many of the requested ids are in a table: one row."""
    hits = requested.select(key).distinct().join(
        found.select(key, F.lit(1).alias("_hit")).distinct(), key, "left"
    )
    return hits.agg(
        F.count(F.lit(1)).alias("requested"), F.count("_hit").alias("found")
    )


def change_counts(new: DataFrame, known: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """Rows in total, already known and new (per group when ``by`` is given)."""
    tagged = new.join(known.select(key, F.lit(1).alias("_known")).distinct(), key, "left")
    groups = [by] if by else []
    return tagged.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_known").isNotNull()).alias("reused"),
        F.count_if(F.col("_known").isNull()).alias("new"),
    )
