"""Crawled catalogue tables into the operational store.

Each job restricts its source either by the weekly window or, for a point
re-sync, by a frame of ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow import schemas as S
from listingflow.functions import text, vehicle
from listingflow.operators import quality
from listingflow.operators.dedupe import one_per_key
from listingflow.operators.relational import missing_from
from listingflow.plans.base import Change, Step, into
from listingflow.sources.catalog import Catalog
from listingflow.streaming.incremental import since_instant

WINDOW_DAYS = 7


#: Source tables that have a row per model, and its id there.
SOURCE_IDS = {"src_model_ev": "model_id", "src_model_detail": "autohome_id", "src_model_master": "model_id"}


def chosen(cat: Catalog, ids: DataFrame | None) -> Catalog:
    """Model tables narrowed to the given ids (column ``id``), at the source where it takes conditions."""
    return cat if ids is None else cat.restricted(ids, SOURCE_IDS)


def in_scope(df: DataFrame, time: str, run_date: str | None, ids: DataFrame | None) -> DataFrame:
    """Rows of the weekly window; a table of chosen ids is in scope whole."""
    return df if ids is not None else df.where(since_instant(F.col(time), run_date, WINDOW_DAYS, inclusive=True))


def ev_rows(cat: Catalog, run_date: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    src = in_scope(chosen(cat, ids).read("src_model_ev"), "add_time", run_date, ids)
    src = src.select("model_id", *V.EV_TEXT_COLUMNS, "add_time", F.col("add_time").alias("update_time"))
    return vehicle.ev_block(text.blank_to_dash(src, {"model_id", "add_time", "update_time"}))


def detail_rows(cat: Catalog, run_date: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    cat = chosen(cat, ids)
    detail = in_scope(cat.read("src_model_detail"), "update_time", run_date, ids)
    detail = detail.where(quality.eligible(level=F.col("level"))).select(*V.DETAIL_COLUMNS)
    # a model is one master row, so the inner join is a semi join
    master = cat.read("src_model_master").where(quality.eligible(model_year=F.col("model_year")))
    return detail.join(master.select(F.col("model_id").alias("autohome_id")), "autohome_id", "left_semi")


def new_brands(cat: Catalog) -> DataFrame:
    local = cat.read("src_model_master").select(
        F.col("brand_id").alias("brandid"), F.col("brand_letter").alias("Initial"), "brand_name"
    ).distinct()
    known = cat.read_or_empty("ods_brand", S.ODS_BRAND)
    return missing_from(local, known, ["brandid"]).withColumn("car_country", F.lit(V.NONE_TEXT))


def new_series(cat: Catalog) -> DataFrame:
    """New series with import naming and level; one row per series (smallest level text)."""
    detail = cat.read("src_model_detail").where(quality.eligible(level=F.col("level")))
    master = cat.read("src_model_master").select(
        F.col("model_id").alias("autohome_id"), "series_id", "series_group_name", "series_name",
        F.col("brand_id").alias("brandid"), "brand_name",
    )
    local = (
        master.join(detail.select("autohome_id", F.col("level").alias("car_level")), "autohome_id")
        .drop("autohome_id").distinct()
    )
    fresh = missing_from(local, cat.read_or_empty("ods_series", S.ODS_SERIES), ["series_id"])
    named = vehicle.import_naming(fresh).withColumn("car_level", vehicle.car_level(F.col("car_level")))
    named = named.select(
        "series_id", "series_group_name", "series_name", "brandid", "brand_name", "car_level", "is_import"
    )
    return one_per_key(named, ["series_id"])


def master_rows(cat: Catalog, run_date: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    cat = chosen(cat, ids)
    a = in_scope(cat.read("src_model_master"), "add_time", run_date, ids).where(
        quality.eligible(F.col("status"), F.col("model_year"), F.col("model_price"))
    )
    b = cat.read("src_model_detail").where(quality.eligible(level=F.col("level"))).select(
        F.col("autohome_id").alias("model_id"), "emission", "gear_box", "environmental_standards_org", "fuel"
    )
    c = cat.read("src_model_ev").select("model_id", F.lit(True).alias("_ev"))
    power = vehicle.power_code(F.col("fuel"), F.col("_ev").isNotNull())
    rows = a.join(b, "model_id").join(c, "model_id", "left").withColumn("is_green", power)
    name, green = F.col("model_name"), F.col("is_green")
    return rows.select(
        "model_id", F.col("brand_id").alias("brandid"), "brand_name", F.col("brand_letter").alias("Initial"),
        "series_group_name", "series_id", "series_name", "model_year", "model_name", "model_price",
        vehicle.sale_status(F.col("status")).alias("status"),
        vehicle.catalogue_displacement(name, F.col("emission"), green).alias("liter"),
        vehicle.catalogue_gearbox(name, F.col("gear_box"), green).alias("auto"),
        vehicle.emission_standard(name, F.col("environmental_standards_org")).alias("discharge_standard"),
        "is_green", F.lit(1).alias("is_check"),
    )


def steps(run_date: str | None = None, ids: DataFrame | None = None) -> list[Step]:
    """The changes of a run in write order; they only read source tables and their own targets."""
    return [
        lambda cat: into(S.ODS_MODEL_EV, "ods_model_ev", ev_rows(cat, run_date, ids)),
        lambda cat: into(S.ODS_MODEL_DETAIL, "ods_model_detail", detail_rows(cat, run_date, ids)),
        lambda cat: into(S.ODS_BRAND, "ods_brand", new_brands(cat), "insert_ignore"),
        lambda cat: into(S.ODS_SERIES, "ods_series", new_series(cat)),
        lambda cat: into(S.ODS_MODEL_MASTER, "ods_model_master", master_rows(cat, run_date, ids)),
    ]


def plan(cat: Catalog, run_date: str | None = None, ids: DataFrame | None = None) -> list[Change]:
    return [step(cat) for step in steps(run_date, ids)]


SCHEMAS = {
    "ods_model_ev": S.ODS_MODEL_EV, "ods_model_detail": S.ODS_MODEL_DETAIL, "ods_brand": S.ODS_BRAND,
    "ods_series": S.ODS_SERIES, "ods_model_master": S.ODS_MODEL_MASTER,
}
