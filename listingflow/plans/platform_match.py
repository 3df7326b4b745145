"""Cross-platform model matching: all platforms against the standard list in one run.

A platform's name is part of every key. The history is unpivoted once, the
standard list is read once, and one cascade and one grouped pivot serve all
platforms; each platform's own table is the only scan that grows with their
number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow import schemas as S
from listingflow.functions.text import id_key
from listingflow.operators import match
from listingflow.operators.dedupe import one_per_key
from listingflow.operators.relational import missing_from
from listingflow.operators.skew import lookup_join
from listingflow.plans.base import Change, into
from listingflow.sources.catalog import Catalog, TableMissing

#: What a match is, by platform: columns ``<name>_<platform>`` of the wide result.
NAMES = {"id": "string", "match_type": "int", "is_only": "int"}
#: Platform columns that matching reads; a platform may lack some.
FIELDS = ("brand_name", "series_name", "model_year", "model_price", "liter", "car_auto", "discharge_standard", "model_name")


def history_rows(cat: Catalog, platforms: Sequence[str]) -> DataFrame:
    """(platform, id_std, id, match_type, is_only) of all earlier matches; none without a history table."""
    try:
        history = cat.read("match_history")
    except TableMissing:
        history = cat.spark.createDataFrame([], "id_che300 string")
    long = match.unpivot_history(history, "id_che300", platforms, NAMES)
    return long.select("platform", id_key(F.col("id_che300")).alias("id_std"), id_key(F.col("id")).alias("id"), "match_type", "is_only")


def decided(history: DataFrame) -> DataFrame:
    """Earlier matches that stand, one per platform and standard id."""
    return one_per_key(history.where(~F.col("match_type").isin(*V.DECIDED_EXCEPT)), ["platform", "id_std"])


def platform_models(cat: Catalog, platforms: Sequence[str]) -> DataFrame | None:
    """(platform, car_id, series_id, fields) of the platforms that have a table; None if none has."""
    frames = []
    for platform in platforms:
        try:
            models = cat.read(f"match_platform_{platform}")
        except TableMissing:
            continue
        frames.append(models.select(
            F.lit(platform).alias("platform"), id_key(F.col("car_id")).alias("car_id"), F.col("series_id").cast("string").alias("series_id"),
            *[(F.col(c) if c in models.columns else F.lit(None)).cast("string").alias(c) for c in FIELDS]))
    return reduce(DataFrame.unionByName, frames) if frames else None


def series_names(models: DataFrame, history: DataFrame, major: DataFrame) -> DataFrame:
    """(platform, series_id, brand, series) of the standard list for series with a known match; smallest names."""
    known = history.select("platform", F.col("id").alias("car_id"), F.col("id_std").alias("_std"))
    names = major.select(
        id_key(F.col("model_id")).alias("_std"), F.col("brand_name").alias("_b"), F.col("series_name").alias("_s"))
    return (
        models.select("platform", "car_id", "series_id").join(known, ["platform", "car_id"]).join(names, "_std")
        .groupBy("platform", "series_id").agg(F.min(F.struct("_b", "_s")).alias("_first"))
    )


def result_rows(cat: Catalog, platforms: Sequence[str] = V.MATCH_PLATFORMS, use_drive: bool = False) -> DataFrame:
    """One row per standard id with three columns per platform; earlier matches stand, gaps are 0."""
    platforms = list(platforms)
    standard = cat.read("match_standard").withColumn("car_id", id_key(F.col("car_id")))
    base = standard.select(F.col("car_id").alias("id_std"))
    history = history_rows(cat, platforms)
    old = decided(history)
    models = platform_models(cat, platforms)
    found = old.where("id IS NOT NULL")
    if models is not None:
        named = lookup_join(models, series_names(models, history, cat.read("catalogue_major")), ["platform", "series_id"], "left")
        hit = F.col("_first._b").isNotNull()
        models = named.withColumns({
            "brand_name": F.when(hit, F.col("_first._b").cast("string")).otherwise(F.col("brand_name")),
            "series_name": F.when(hit, F.col("_first._s").cast("string")).otherwise(F.col("series_name"))}).drop("_first")
        open_models = missing_from(models, old.select("platform", F.col("id").alias("car_id")), ["platform", "car_id"])
        # the list is read once and dealt to the platforms; what a platform has decided leaves its share
        dealt = match.features(standard, use_drive).withColumn("platform", F.explode(F.array(*[F.lit(p) for p in platforms])))
        open_standard = missing_from(dealt, old.select("platform", F.col("id_std").alias("car_id")), ["platform", "car_id"])
        probes = match.features(open_models, use_drive, keep=("platform",))
        cascaded = match.cascade(probes, open_standard, use_drive, by=("platform",))
        fresh = match.settled_matches(cascaded, by=("platform",)).withColumnRenamed("platform_id", "id")
        found = found.unionByName(fresh)
    return match.pivot_platforms(base, found, platforms, NAMES)


def plan(cat: Catalog, platforms: Sequence[str] = V.MATCH_PLATFORMS, use_drive: bool = False) -> list[Change]:
    rows = result_rows(cat, platforms, use_drive)
    return [into(S.MATCH_RESULT, "match_history", rows.withColumnRenamed("id_std", "id_che300"), "replace")]
