"""Differences, semi-filters and lookups between two frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.functions.text import long_key
from listingflow.operators.skew import lookup_join


def missing_from(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks (a NULL key is always lacking)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def missing_ids(source: DataFrame, target: DataFrame, source_id: str, target_id: str) -> DataFrame:
    """`missing_from` on ids of different types, compared as whole numbers."""
    known = target.select(long_key(target, target_id).alias("_known"))
    return source.join(known, long_key(source, source_id) == F.col("_known"), "left_anti")


def semi_filter(rows: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in the id frame; replaces an IN list of any length."""
    return rows.join(ids.select(*keys), list(keys), "left_semi")


def join_normalised(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Join on whole-number keys whatever their types; the key becomes a long, junk never matches."""
    left = left.withColumn(left_key, long_key(left, left_key))
    right = right.withColumn(right_key, long_key(right, right_key))
    if left_key != right_key:
        right = right.withColumnRenamed(right_key, left_key)
    return left.join(right, left_key, how)


def override_from(
    df: DataFrame, lookup: DataFrame, key: str, columns: Mapping[str, str], hit: str | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Replace columns by lookup values where the lookup hit; ``columns`` maps target to lookup column.

    ``hit`` names the lookup column that must be present for a hit (default: the first one).
    """
    hit = hit or next(iter(columns.values()))
    renamed = lookup.select(key, *[F.col(v).alias(f"_{v}") for v in dict.fromkeys([*columns.values(), hit])])
    joined = lookup_join(df, renamed, [key], "left", salts)
    found = F.col(f"_{hit}").isNotNull()
    return joined.withColumns(
        {c: F.when(found, F.col(f"_{v}")).otherwise(F.col(c)) for c, v in columns.items()}
    ).select(*df.columns)


def changed_rows(new: DataFrame, old: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose value differs from the old one as a number; unreadable numbers count as changed."""
    joined = new.select(key, F.col(value).alias(f"{value}_new")).join(
        old.select(key, F.col(value).alias(f"{value}_old")), key
    )
    return joined.where(differs(F.col(f"{value}_new"), F.col(f"{value}_old")))


def differs(a: Column, b: Column) -> Column:
    return F.coalesce(a.try_cast("double") != b.try_cast("double"), F.lit(True))


def map_values(col: Column, mapping: Mapping[str, object]) -> Column:
    """Value of a short fixed mapping, NULL for an unknown key."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)
