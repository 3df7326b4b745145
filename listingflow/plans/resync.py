"""Point re-sync of chosen models through both catalogue stages, and the change preview."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.operators import quality
from listingflow.operators.snapshots import SnapshotTable
from listingflow.plans import catalogue_to_ods, ods_to_production
from listingflow.plans.base import Change, Step, plan_steps, planned, run_steps
from listingflow.sources.catalog import Catalog


@dataclass(frozen=True)
class Resync:
    """Steps of both stages, the ids refused, and why requested ids yield nothing."""

    steps: list[Step]
    refused: DataFrame
    unusable: DataFrame

    def plan(self, cat: Catalog) -> list[Change]:
        """Dry run: stage two is planned on stage one's planned output."""
        return plan_steps(cat, self.steps, SCHEMAS)

    def run(self, cat: Catalog, stores: Mapping[str, SnapshotTable]) -> list[str]:
        return run_steps(cat, self.steps, stores, SCHEMAS)


SCHEMAS = {**catalogue_to_ods.SCHEMAS, **ods_to_production.SCHEMAS}


def unusable_ids(cat: Catalog, ids: DataFrame) -> DataFrame:
    """Requested ids that cannot be synced, with the first reason."""
    cat = catalogue_to_ods.chosen(cat, ids)
    master = cat.read("src_model_master").select(
        F.col("model_id").alias("id"), "status", "model_year", "model_price", F.lit(True).alias("_master"))
    detail = cat.read("src_model_detail").select(
        F.col("autohome_id").alias("id"), "level", F.lit(True).alias("_detail"))
    joined = ids.select("id").join(master, "id", "left").join(detail, "id", "left")
    tagged = quality.explain_rejects(joined, {
        "unknown model": F.col("_master").isNotNull(),
        "no detail row": F.col("_detail").isNotNull(),
        "coming soon": quality.eligible(status=F.col("status")),
        "no model year": quality.eligible(model_year=F.col("model_year")),
        "price is zero": quality.eligible(price=F.col("model_price")),
        "level unknown": quality.eligible(level=F.col("level")),
    })
    return tagged.where("reason IS NOT NULL").select("id", "reason")


def prepare(cat: Catalog, ids: DataFrame, threshold: int = V.MANUAL_ID_THRESHOLD) -> Resync:
    """A re-sync of the ids (column ``id``) at or below the threshold."""
    kept, refused = quality.split_on_threshold(ids, "id", threshold)
    quality.require_some(kept, "ids")
    steps = [*catalogue_to_ods.steps(ids=kept), *ods_to_production.steps(kept)]
    return Resync(steps, refused, unusable_ids(cat, kept))


def change_preview(cat: Catalog) -> dict[str, DataFrame]:
    """New brands, new series, new models and moved prices; nothing is written."""
    brands, series = ods_to_production.new_brands(cat), ods_to_production.new_series(cat)
    after = planned(
        cat,
        [Change("prod_brand", brands, ("brandid",)), Change("prod_series", series, ("series_id",))],
        ods_to_production.SCHEMAS,
    )
    return {
        "brand": brands,
        "series": series,
        "config": ods_to_production.config_rows(after),
        "price_update": ods_to_production.price_changes(cat),
    }
