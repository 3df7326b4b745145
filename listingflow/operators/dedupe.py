"""Keeping, counting and marking rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.operators.skew import lookup_join


def full_order(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """Every sortable column, as a tie-break that does not depend on arrival order."""
    return [
        F.col(f"`{n}`").asc_nulls_last()
        for n, t in df.dtypes
        if n not in skip and not t.startswith("map")
    ]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key. Spark keeps one row per key and map task before it shuffles."""
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_by(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[Column] | None = None) -> DataFrame:
    """Row with the latest time per key, unknown times last; ties go to the full row order."""
    tie = full_order(df, [*keys, time]) if tie is None else list(tie)
    return first_by(df, keys, [F.col(time).desc_nulls_last(), *tie])


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the smallest row unless an order is given."""
    return first_by(df, keys, order or full_order(df, keys))


def only_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose (non-NULL) key occurs exactly once; counts before the shuffle, no join."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    counted = df.dropna(subset=keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(f"`{c}`").alias(c) for c in others]
    )
    return counted.where("_n = 1").select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def group_size_and_min(
    df: DataFrame, keys: Sequence[str], value: str, salts: int | None = None
) -> DataFrame:
    """Add the size of each row's group and whether the row holds the group's smallest value."""
    stats = df.groupBy(*keys).agg(
        F.count(value).alias("group_size"), F.min(value).alias("_least")
    )
    joined = lookup_join(df, stats, keys, "inner", salts)
    return joined.withColumn("is_min", (F.col(value) == F.col("_least")).cast("int")).drop("_least")


def rows_at_max(
    df: DataFrame, keys: Sequence[str], value: str, salts: int | None = None
) -> DataFrame:
    """Rows whose value equals the largest value of their group."""
    top = df.groupBy(*keys).agg(F.max(value).alias("_top"))
    return lookup_join(df, top, keys, "inner", salts).where(F.col(value) == F.col("_top")).drop("_top")


def representative_pair(
    df: DataFrame, group: str, newest: str, pair: Sequence[str], pick: str = "most"
) -> DataFrame:
    """Per group, the most (or least) frequent pair among the rows of the newest value; ties: smallest pair.

    Rows are counted per (group, newest, pair) before anything else, so the
    later steps only see those counts.
    """
    counts = df.where(F.col(newest).isNotNull()).groupBy(group, newest, *pair).agg(
        F.count(F.lit(1)).alias("_n")
    )
    rank = F.col("_n").desc() if pick == "most" else F.col("_n").asc()
    order = [F.col(newest).desc(), rank, *[F.col(c).asc_nulls_last() for c in pair]]
    return first_by(counts, [group], order).select(group, *pair)
