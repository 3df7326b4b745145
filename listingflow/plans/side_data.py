"""Complaints, dealer quotes, sales, reviews, dealers and paid prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.functions import geo, listing, vehicle
from listingflow.functions.text import long_key
from listingflow.operators import quality
from listingflow.operators.relational import join_normalised
from listingflow.operators.skew import lookup_join
from listingflow.plans.base import Change
from listingflow.sources.catalog import Catalog
from listingflow.streaming.incremental import after_day, days_back, month_anchor, since_instant

COMPLAINT_DAYS = 31


def gazetteer(cat: Catalog) -> geo.Gazetteer:
    return geo.Gazetteer.load(geo.county_dim(cat.read("dim_district"), cat.read("dim_region")))


def _add_province(df: DataFrame, places: geo.Gazetteer) -> DataFrame:
    """Inner join on the province of each city: one row per city, rows without one are dropped."""
    provinces = geo.one_row_per_city(places.districts).select("city", "province").where("city <> ''")
    # '' is no city; a NULL here would make Spark test, and so compute, the place a second time
    df = df.withColumn("city", F.coalesce("city", F.lit("")))
    if places.cities is not None:
        # one row per city and the cities were counted when the dictionary was loaded
        return df.join(F.broadcast(provinces), "city")
    return lookup_join(df, provinces, ["city"], "inner")


def _ymd(name: str) -> F.Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


COMPLAINT_FEEDS = {
    "src_complaint_2": ("id", "series", "brand", "question", "complain_time"),
    "src_complaint_3": ("id", "series", "brand", "car_type", "car_status", "appeal", "question",
                        "buy_time", "complain_time"),
    "src_complaint_4": ("id", "series", "brand", "tag1", "tag2", "tag3", "complain_time"),
}


def complaint_feed(cat: Catalog, name: str, run_date: str) -> DataFrame:
    """Recent rows of one complaint feed: whole rows of feed 1, chosen columns of the others."""
    src = cat.read(name)
    if name == "src_complaint_1":
        return src.where(since_instant(F.col("add_time"), run_date, COMPLAINT_DAYS))
    recent = src.where(after_day(F.col("add_time"), days_back(run_date, COMPLAINT_DAYS)))
    return recent.select(*COMPLAINT_FEEDS[name], _ymd("add_time"))


def owner_complaints(cat: Catalog, run_date: str) -> DataFrame:
    """Owner complaints with city standardised and its province; unknown places are dropped."""
    recent = cat.read("src_complaint_owner").where(
        after_day(F.col("update_time"), days_back(run_date, COMPLAINT_DAYS)))
    tags = [f"{kind}{n}" for n in range(1, 7) for kind in ("tag", "des")]
    rows = recent.select("complain_id", "series_id", "city", *tags, _ymd("complain_time"), _ymd("update_time"))
    places = gazetteer(cat)
    placed = _add_province(geo.standardise_city(rows, "city", places), places)
    return placed.select("complain_id", "series_id", "province", "city", *tags, "complain_time", "update_time")


def complaints(cat: Catalog, run_date: str, whole_row_key: str = "id") -> list[Change]:
    feeds = [
        Change(name.replace("src_", "side_"), complaint_feed(cat, name, run_date),
               (whole_row_key if name == "src_complaint_1" else "id",))
        for name in ("src_complaint_1", *COMPLAINT_FEEDS)
    ]
    return [*feeds, Change("side_complaint_owner", owner_complaints(cat, run_date), ("complain_id",))]


def dealer_quotes(cat: Catalog, run_date: str) -> DataFrame:
    """Quotes of the 15th of this month."""
    return cat.read("src_quote").where(F.col("stat_time") == F.lit(month_anchor(run_date, 0, 15)))


def discount(cat: Catalog, run_date: str, key: str = "id") -> list[Change]:
    return [Change("side_quote", dealer_quotes(cat, run_date), (key,))]


def sales_feed(cat: Catalog, run_date: str) -> DataFrame:
    """Whole rows added after the first instant of this month."""
    return cat.read("src_sales_a").where(F.col("add_time") > F.lit(month_anchor(run_date)))


def sales_volumes(cat: Catalog, run_date: str) -> DataFrame:
    """Monthly sales with series and brand names; the month becomes its first day."""
    src = cat.read("src_sales_b").where(since_instant(F.col("update_time"), run_date, COMPLAINT_DAYS))
    names = cat.read("src_series_brand").select("series_id", "series_name", "brand_id", "brand_name").distinct()
    rows = src.select(
        "series_id", listing.month_start(F.col("stat_date")).alias("stat_date"), "salesNum",
        F.col("update_time").alias("add_time"))
    joined = join_normalised(rows, names.withColumn("brand_id", long_key(names, "brand_id")),
                             "series_id", "series_id")
    return joined.select("brand_id", "brand_name", "series_id", "series_name", "stat_date", "salesNum", "add_time")


def sales(cat: Catalog, run_date: str, feed_key: str = "id") -> list[Change]:
    return [
        Change("side_sales_a", sales_feed(cat, run_date), (feed_key,)),
        Change("side_sales_b", sales_volumes(cat, run_date), ("series_id", "stat_date")),
    ]


SCORES = {
    "score_spaceScene": "space", "score_powerScene": "power", "score_maneuverabilityScene": "control",
    "score_oilScene": "oilconsumption", "score_batteryScene": "eleconsumption",
    "score_comfortablenessScene": "comfortableness", "score_apperanceScene": "apperance",
    "score_internalScene": "interior", "score_costefficientScene": "costefficient",
}


def review_rows(cat: Catalog, run_date: str) -> DataFrame:
    """Owner reviews with model, province and (optional) city names."""
    src = cat.read("src_review")
    src = src.where(after_day(F.col("add_time"), month_anchor(run_date, 5, 1)))
    rows = src.select(
        "id", "eid", long_key(src, "model_id").alias("model_id"), "isbattery",
        listing.larger_mileage(F.col("drivenKilometers_appends"), F.col("drivekilometer")).alias("miles"),
        listing.month_start(F.col("boughtdate")).alias("boughtdate"),
        F.substring("boughtcity_id", 1, 2).alias("province_id"),
        F.substring("boughtcity_id", 1, 4).alias("city_id"),
        "visitcount", "helpfulcount", "commentcount", "boughtPrice",
        *[F.col(s).alias(t) for s, t in SCORES.items()],
        "satisfaction", F.col("append_time").alias("comment_time"), _ymd("add_time"),
    )
    models = cat.read("src_model_master").select(
        "model_id", "model_name", "brand_id", "brand_name", "series_id", "series_name", "model_year", "model_price")
    codes = geo.city_code_dim(cat.read("dim_district"))
    joined = join_normalised(rows, models, "model_id", "model_id")
    joined = lookup_join(joined, geo.one_per_code(codes, "province_id", "province"), ["province_id"], "inner")
    joined = lookup_join(joined, geo.one_per_code(codes, "city_id", "city"), ["city_id"], "left")
    return joined.select(
        "id", "eid", "model_id", "brand_id", "brand_name", "series_id", "series_name", "model_year",
        "model_name", "model_price", "isbattery", "boughtdate", "boughtPrice", "province", "city", "miles",
        "visitcount", "helpfulcount", "commentcount", *SCORES.values(), "satisfaction", "comment_time", "add_time",
    )


def reviews(cat: Catalog, run_date: str) -> list[Change]:
    return [Change("side_review", review_rows(cat, run_date), ("id",))]


DEALER_COLUMNS = ("id", "dealer_id", "shop_4s", "name", "brand", "linkPhone", "province_name", "city_name", "update_time")


def dealer_rows(cat: Catalog, name: str, run_date: str) -> DataFrame:
    rows = cat.read(name).where(after_day(F.col("update_time"), month_anchor(run_date, 5, 1))).select(*DEALER_COLUMNS)
    if name == "src_dealer_3":
        rows = rows.withColumn("city_name", listing.strip_city_suffix(F.col("city_name")))
    return rows


def dealers(cat: Catalog, run_date: str) -> list[Change]:
    return [
        Change(f"side_dealer_{n}", dealer_rows(cat, f"src_dealer_{n}", run_date), ("id",)) for n in (1, 2, 3)
    ]


def paid_prices_a(cat: Catalog, run_date: str) -> DataFrame:
    """Paid prices with province and city read from the place text; implausible prices dropped."""
    src = cat.read("src_paid_a").where(after_day(F.col("add_time"), month_anchor(run_date, 5, 1)))
    src = src.where(quality.price_gap_ok(F.col("model_price"), F.col("bare_price")))
    rows = src.withColumnsRenamed({"boughtaddress": "city", "owner_price_id": "owner_id"})
    places = gazetteer(cat)
    rows = places.add_first(rows, "city", "province", "province")
    rows = geo.standardise_city(rows, "city", places)
    return rows.select(
        "id", "model_id", "series_id", "series_name", "model_name", "model_price", "province", "city",
        listing.day(F.col("boughtdate")).alias("boughtdate"), "owner_id", "bare_price", "fullprice",
        "purchase_tax", "commercial_insure", "vehicle_tax", "high_insure", "card_fee", "add_time",
    )


def paid_prices_b(cat: Catalog, run_date: str) -> DataFrame:
    """Paid prices in yuan scaled to ten thousands, with year from the model name and place names."""
    src = cat.read("src_paid_b").where(after_day(F.col("add_time"), month_anchor(run_date, 8, 20)))
    rows = src.select(
        "id", "brand_name", "series_name", "model_name", "buy_time", "city",
        F.round(F.col("guidance_price").try_cast("double") / 10000, 2).alias("model_price"),
        F.round(F.col("naked_price").try_cast("double") / 10000, 2).alias("bare_price"), "add_time",
    ).where(quality.price_gap_ok(F.col("model_price"), F.col("bare_price")))
    places = gazetteer(cat)
    placed = _add_province(geo.standardise_city(rows, "city", places), places)
    return placed.select(
        "id", F.upper("brand_name").alias("brand_name"), F.upper("series_name").alias("series_name"),
        vehicle.model_year_from_name(F.col("model_name")).alias("model_year"), "model_name", "model_price",
        "province", "city", listing.day(F.col("buy_time")).alias("buy_time"), "bare_price", "add_time",
    )


def unreadable_prices_b(cat: Catalog) -> DataFrame:
    """Source rows of which a price is no number, with the first such price as ``reason``."""
    rules = {f"{c} is no number": F.col(c).try_cast("double").isNotNull() | F.col(c).isNull() for c in ("guidance_price", "naked_price")}
    return quality.explain_rejects(cat.read("src_paid_b"), rules).where("reason IS NOT NULL")


def owner_prices_a(cat: Catalog, run_date: str) -> list[Change]:
    return [Change("side_paid_a", paid_prices_a(cat, run_date), ("id",))]


def owner_prices_b(cat: Catalog, run_date: str) -> list[Change]:
    return [Change("side_paid_b", paid_prices_b(cat, run_date), ("id",))]


JOBS = {
    "complaint": complaints, "discount": discount, "salesnum": sales, "koubei": reviews,
    "dealer": dealers, "owner_price_ah": owner_prices_a, "owner_price_yiche": owner_prices_b,
}
