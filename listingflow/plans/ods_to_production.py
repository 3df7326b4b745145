"""Operational store into the production catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow import schemas as S
from listingflow.functions import text, vehicle
from listingflow.operators import quality
from listingflow.operators.dedupe import one_per_key
from listingflow.operators.relational import changed_rows, join_normalised, missing_from, missing_ids
from listingflow.plans.base import Change, Step, into, plan_steps
from listingflow.sources.align import align
from listingflow.sources.catalog import Catalog


def _only(df: DataFrame, key: str, ids: DataFrame | None) -> DataFrame:
    return df if ids is None else df.join(ids.select(F.col("id").alias(key)), key, "left_semi")


def new_brands(cat: Catalog) -> DataFrame:
    return missing_from(cat.read("ods_brand"), cat.read_or_empty("prod_brand", S.PROD_BRAND), ["brandid"])


def new_series(cat: Catalog) -> DataFrame:
    series = cat.read("ods_series").select(*[f.name for f in S.PROD_SERIES.fields])
    return missing_from(series, cat.read_or_empty("prod_series", S.PROD_SERIES), ["series_id"])


def series_colors(cat: Catalog, ids: DataFrame | None = None) -> DataFrame:
    """Colours per model: the smallest colour row of its series."""
    colors = one_per_key(
        cat.read("src_color").where("color_outside IS NOT NULL")
        .select("series_id", "color_outside", "color_outside_code"),
        ["series_id"],
    )
    models = cat.read("ods_model_master").select(F.col("model_id").alias("autohome_id"), "series_id")
    return _only(models, "autohome_id", ids).join(colors, "series_id").drop("series_id")


def color_backfill(cat: Catalog, ids: DataFrame | None = None) -> Change:
    return Change(
        "ods_model_detail", series_colors(cat, ids), ("autohome_id",), "update",
        columns=("color_outside", "color_outside_code"),
    )


def base_part(cat: Catalog, ids: DataFrame | None = None) -> DataFrame:
    """Approved models with brand and series names, under production names; one row per model."""
    major = quality.approved(cat.read("ods_model_master")).select(
        text.long_key(cat.read("ods_model_master"), "model_id").alias("autohome_id"), "brandid", "series_id",
        F.col("status").alias("is_selling"), "model_name", F.col("model_price").alias("recommend_price"),
        F.col("model_year").alias("year"), "is_green",
    )
    brand = cat.read("prod_brand").select(
        "brandid", F.col("Initial").alias("mark"), F.col("brand_name").alias("brand"))
    series = cat.read("prod_series").select(
        "series_id", F.col("series_name").alias("series"), F.col("series_group_name").alias("factory_name"))
    named = _only(major, "autohome_id", ids).join(brand, "brandid").join(series, "series_id")
    # details are keyed by model, so only these narrow rows can repeat
    return one_per_key(named, ["autohome_id"]).withColumns({
        "type_name": text.join_words(F.col("series"), F.col("model_name")),
        "produced_place": F.lit(""),
    }).drop("model_name")


def detail_part(cat: Catalog, ids: DataFrame | None = None) -> DataFrame:
    """Details of approved models with the series level, pairs split and flags set."""
    master = quality.approved(cat.read("ods_model_master")).select(
        F.col("model_id").alias("autohome_id"), "series_id")
    level = cat.read("ods_series").select("series_id", "car_level")
    detail = cat.read("ods_model_detail").drop("url", "update_time", "level")
    rows = (
        _only(detail, "autohome_id", ids).join(master, "autohome_id").join(level, "series_id", "left")
        .drop("series_id")
        .withColumnsRenamed({"max_n_m": V.TORQUE_PRODUCTION, "car_level": "level"})
        .withColumns({"hl_configs": F.lit(""), "hl_configc": F.lit(""),
                      "emission": vehicle.first_token(F.col("emission"))})
    )
    return vehicle.equipment_flags(vehicle.split_pairs(rows))


def config_rows(cat: Catalog, ids: DataFrame | None = None, only_new: bool = True) -> DataFrame:
    """Production wide rows, aligned to the target and filled with '-'; by default only absent ids."""
    if only_new:
        # known ids leave both inputs before anything is joined, ranked, split or flagged
        known = cat.read_or_empty("prod_config", S.PROD_CONFIG)
        cat = cat.overlay(**{
            name: missing_ids(cat.read(name), known, key, "autohome_id")
            for name, key in (("ods_model_master", "model_id"), ("ods_model_detail", "autohome_id"))})
    wide = base_part(cat, ids).join(detail_part(cat, ids), "autohome_id")
    wide = wide.withColumns({
        "color_outside": vehicle.catalogue_color(F.col("color_outside")),
        "color_outside_code": vehicle.catalogue_color(F.col("color_outside_code")),
        "environmental_standards": vehicle.emission_standard_production(F.col("environmental_standards_org")),
    })
    return text.fill_text(align(wide, S.PROD_CONFIG, "intersect", skip=["id"]))


def price_changes(cat: Catalog) -> DataFrame:
    """(autohome_id, recommend_price_new, recommend_price_old) where the price moved; hand-made ids never."""
    new = quality.approved(cat.read("ods_model_master")).select(
        F.col("model_id").alias("autohome_id"), F.col("model_price").alias("recommend_price"))
    old = cat.read("prod_config").where(quality.automatic_ids(F.col("autohome_id")))
    return changed_rows(new, old.select("autohome_id", "recommend_price"), "autohome_id", "recommend_price")


def price_update(cat: Catalog) -> Change:
    rows = price_changes(cat).select(
        "autohome_id", F.col("recommend_price_new").cast("string").alias("recommend_price"))
    # the changed rows were read from the table without the hand-made ids
    return Change("prod_config", rows, ("autohome_id",), "update", columns=("recommend_price",))


def ev_rows(cat: Catalog, ids: DataFrame | None = None) -> DataFrame:
    """Electric-drive side rows under the production row's id."""
    ev = cat.read("ods_model_ev").drop("add_time", "update_time").withColumnsRenamed(
        {"model_id": "autohome_id", "ee_fast_charge": V.EV_FAST_CHARGE_PRODUCTION})
    config = cat.read("prod_config").where(quality.automatic_ids(F.col("autohome_id"))).select(
        "id", "autohome_id")
    joined = join_normalised(_only(ev, "autohome_id", ids), config, "autohome_id", "autohome_id")
    rows = vehicle.ev_export(joined.drop("autohome_id"), "id")
    return rows.select("id", *[F.col(f"`{c}`") for c in rows.columns if c != "id"])


SCHEMAS = {
    "prod_brand": S.PROD_BRAND, "prod_series": S.PROD_SERIES, "prod_config": S.PROD_CONFIG,
    "prod_config_ev": S.PROD_EV,
}


def steps(ids: DataFrame | None = None) -> list[Step]:
    """The production changes in write order.

    Without ids only new models are inserted and prices updated; with ids the
    given models are overwritten in place.
    """
    key = ("autohome_id",)
    if ids is None:
        models = [
            lambda cat: Change("prod_config", config_rows(cat), key, "insert_numbered", on_duplicate="trusted"),
            price_update,
        ]
    else:
        models = [lambda cat: Change(
            "prod_config", config_rows(cat, ids, only_new=False), key, "keep_id", on_duplicate="trusted")]
    return [
        lambda cat: into(S.PROD_BRAND, "prod_brand", new_brands(cat)),
        lambda cat: into(S.PROD_SERIES, "prod_series", new_series(cat)),
        lambda cat: color_backfill(cat, ids),
        *models,
        lambda cat: into(S.PROD_EV, "prod_config_ev", ev_rows(cat, ids)),
    ]


def plan(cat: Catalog, ids: DataFrame | None = None) -> list[Change]:
    """All production changes, each planned on top of the ones before it."""
    return plan_steps(cat, steps(ids), SCHEMAS)
