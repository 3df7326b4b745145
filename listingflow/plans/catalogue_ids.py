"""Standard brand, series and model ids, and the standard wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow import schemas as S
from listingflow.functions import vehicle
from listingflow.operators.dedupe import one_per_key, representative_pair
from listingflow.operators.ids import allocate
from listingflow.operators.relational import missing_from
from listingflow.plans.base import Change, Step, into, plan_steps
from listingflow.sources.catalog import Catalog


def brand_rows(cat: Catalog) -> DataFrame:
    """New brands with id Initial ‖ next number; equal names of one initial share the id."""
    brands = cat.read("standard_major").select("Initial", "brandid", "brand_name").distinct()
    known = cat.read("std_brand").select("brandid", "std_brandid")
    existing = brands.select("Initial", "brandid").join(known, "brandid").select("Initial", "std_brandid")
    fresh = missing_from(brands, known.where("std_brandid IS NOT NULL"), ["brandid"])
    coded = allocate(fresh, existing, "Initial", "brand_name", "std_brandid")
    return coded.select("brandid", "Initial", "brand_name", "std_brandid", F.lit(V.NONE_TEXT).alias("car_country"))


def series_rows(cat: Catalog) -> DataFrame:
    """New series with id brand ‖ 'S' ‖ next number, ranked by the cleaned name."""
    series = cat.read("standard_major").select(
        "brandid", "series_id", "series_group_name", "series_name").distinct()
    brands = cat.read("std_brand").select("brandid", "std_brandid")
    known = cat.read("std_series").select("series_id", "std_seriesid")
    branded = series.join(brands, "brandid")
    existing = branded.join(known, "series_id").select("std_brandid", "std_seriesid")
    fresh = missing_from(branded, known.where("std_seriesid IS NOT NULL"), ["series_id"]).drop("brandid")
    coded = allocate(
        vehicle.import_naming(fresh, standard=True), existing, "std_brandid", "series_name", "std_seriesid", "S")
    return coded.select(
        "series_id", "series_group_name", "series_name", "std_seriesid", "is_import",
        F.lit(V.NONE_TEXT).alias("car_level"), F.lit(V.NONE_TEXT).alias("is_green"),
    )


def series_levels(cat: Catalog, pick: str = "most") -> DataFrame:
    """(series_id, car_level, is_green) for series that lack one: the pair of the newest model year."""
    open_series = cat.read("std_series").where(
        (F.col("car_level") == V.NONE_TEXT) | (F.col("is_green") == V.NONE_TEXT)).select("series_id")
    pairs = representative_pair(
        cat.read("standard_major").select("series_id", "model_year", "car_level", "is_green"),
        "series_id", "model_year", ["car_level", "is_green"], pick)
    return pairs.join(open_series, "series_id", "left_semi").withColumn("is_green", F.col("is_green").cast("string"))


def model_rows(cat: Catalog) -> DataFrame:
    """New models with id series ‖ 'M' ‖ next number."""
    major = cat.read("standard_major").select("model_id", "series_id", "auto", "liter", "is_green")
    series = cat.read("std_series").select("series_id", "std_seriesid")
    known = cat.read("std_model").select("model_id", "std_modelid")
    existing = known.join(major.select("model_id", "series_id"), "model_id").join(series, "series_id").select(
        "std_seriesid", "std_modelid")
    fresh = missing_from(major, known, ["model_id"]).join(series, "series_id")
    coded = allocate(fresh, existing, "std_seriesid", "model_id", "std_modelid", "M")
    return coded.select("std_modelid", "model_id", "auto", "liter", "is_green", F.lit(0).alias("is_check"))


def wide_rows(cat: Catalog) -> DataFrame:
    """Model ⋈ master ⋈ brand ⋈ series, without series whose level is not set."""
    a = cat.read("std_model").select("std_modelid", "model_id", "auto", "liter", "is_green")
    b = cat.read("standard_major").select(
        "model_id", "Initial", "brandid", "series_id", "model_name", "short_name", "model_price", "model_year",
        "discharge_standard", "max_reg_year", "min_reg_year", "seat_number", "hl_configs", "hl_configc")
    c = cat.read("std_brand").select("brandid", "std_brandid", "brand_name")
    d = cat.read("std_series").where(F.col("car_level") != V.NONE_TEXT).select(
        "series_id", "series_group_name", "std_seriesid", "series_name", "car_level", "is_import")
    joined = a.join(b, "model_id").join(c, "brandid").join(d, "series_id")
    return joined.select(*S.STD_WIDE_COLUMNS)


def recent(name: str) -> F.Column:
    return F.col(name).try_cast("int") >= V.RECENT_REG_YEAR


def reg_year_update(cat: Catalog) -> Change:
    """Refresh the last registration year where both the old and the new one are recent."""
    rows = cat.read("standard_major").where(recent("max_reg_year")).select("model_id", "max_reg_year")
    return Change("catalogue_major", rows, ("model_id",), "update", columns=("max_reg_year",),
                  when=recent("max_reg_year"))


SCHEMAS = {"std_brand": S.STD_BRAND, "std_series": S.STD_SERIES, "std_model": S.STD_MODEL}


def steps(pick: str = "most") -> list[Step]:
    """Brands, series, levels, models, wide table, registration years."""
    return [
        lambda cat: into(S.STD_BRAND, "std_brand", one_per_key(brand_rows(cat), ["brandid"]), "replace"),
        lambda cat: into(S.STD_SERIES, "std_series", one_per_key(series_rows(cat), ["series_id"]), "replace"),
        lambda cat: Change("std_series", series_levels(cat, pick), ("series_id",), "update",
                           columns=("car_level", "is_green")),
        lambda cat: into(S.STD_MODEL, "std_model", one_per_key(model_rows(cat), ["model_id"]), "replace"),
        lambda cat: Change("catalogue_major", one_per_key(wide_rows(cat), ["model_id"]), ("model_id",), "replace"),
        reg_year_update,
    ]


def plan(cat: Catalog, pick: str = "most") -> list[Change]:
    """All changes, each planned on top of the ones before it."""
    return plan_steps(cat, steps(pick), SCHEMAS)
