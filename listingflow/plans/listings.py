"""Used-car listings of seven platforms into one wide table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow import schemas as S
from listingflow.functions import geo, listing
from listingflow.operators import merge, quality
from listingflow.operators.dedupe import latest_by, one_per_key, only_unique
from listingflow.operators.skew import broadcast_lookup_join, lookup_join
from listingflow.operators.journal import Journal
from listingflow.operators.snapshots import SnapshotTable, touched_partitions
from listingflow.operators.store import BucketTable, Conflict, ManifestTable, drop_staged, staged
from listingflow.plans.base import Change, Sink, commit_all, into, resume
from listingflow.sources.align import align, project
from listingflow.sources.catalog import Catalog
from listingflow.streaming.incremental import high_water_mark, newer_than_mark

_MARKET = {
    "quotes": "price", "location": "location", "address": "place", "transfer": "transfer_number",
    "color": "body_color", "mile": "mile", "regDate": "reg_date",
    "add_time": "add_time", "update_time": "update_time",
}
_INSPECTED = {"annual": "inspect_date", "insure": "insure_date"}


def _blank() -> Column:
    return F.lit("")


@dataclass(frozen=True)
class PlatformSpec:
    """How one platform's raw table becomes a listing frame.

    ``columns`` maps listing columns to raw columns or to functions that make
    a column. A platform is either keyed by model (``mid_column``; it reads
    listings updated since the mark) or by listing (it reads the listings whose
    mapping changed since the mark).
    """

    name: str
    id_column: str
    columns: Mapping[str, str | Callable[[], Column]]
    mid_column: str | None = None
    xlat_id: str = "platform_id"
    county_fallback: bool = False
    strip_brackets: bool = False
    fee_text: bool = False
    expiry: tuple[str, ...] = ()
    added: Callable[[], Column] = field(
        default=lambda: listing.listing_day(F.col("update_time"), F.col("add_time")))
    drops_superseded: bool = False

    @property
    def source(self) -> str:
        return f"listing_{self.name}"

    @property
    def xlat(self) -> str:
        return f"xlat_{self.name}"


def _state(code: str) -> Callable[[], Column]:
    return lambda: F.lit(code)


PLATFORMS: dict[str, PlatformSpec] = {
    spec.name: spec
    for spec in (
        PlatformSpec(
            "guazi", "car_id", {**_MARKET, **_INSPECTED, "state": _state("0"), "trans_fee": "is_transfer_fee"},
            mid_column="model_id", county_fallback=True, strip_brackets=True, expiry=("annual", "insure"),
        ),
        PlatformSpec(
            # prices and mileage in 1/10000; location and address are stored swapped
            "che168", "car_id",
            {
                "quotes": lambda: F.col("quotes").try_cast("double") / 10000, "location": "address", "address": "location",
                "transfer": "transfer", "color": "color", "mile": lambda: F.col("mile").try_cast("double") / 10000,
                "state": "state", "trans_fee": "trans_fee", "annual": "annual", "insure": "insure",
                "regDate": "regDate", "add_time": "add_time", "update_time": "update_time",
            },
            mid_column="model_id", expiry=("annual", "insure"),
        ),
        PlatformSpec(
            "che58", "id", {**_MARKET, **_INSPECTED, "state": _state("1"), "trans_fee": "is_transfer_fee"},
            fee_text=True, expiry=("annual", "insure"), drops_superseded=True,
        ),
        PlatformSpec(
            "rrc", "id", {**_MARKET, **_INSPECTED, "state": _state("0"), "trans_fee": "is_transfer_fee"},
            expiry=("annual", "insure"),
        ),
        PlatformSpec(
            "ttp", "car_id",
            {**_MARKET, "quotes": "deal_price", "deal_date": "deal_date", "state": _state("1"),
             "trans_fee": _blank, "annual": _blank, "insure": _blank},
            added=lambda: listing.deal_day(F.col("deal_date"), F.col("add_time"), F.col("update_time")),
        ),
        PlatformSpec(
            "yiche", "car_id",
            {**_MARKET, "state": _state("0"), "trans_fee": "is_transfer_fee", "annual": _blank, "insure": _blank},
            mid_column="model_id", fee_text=True,
        ),
        PlatformSpec(
            "youxin", "car_id",
            {**_MARKET, "state": _state("0"), "trans_fee": "is_transfer_fee", "annual": _blank, "insure": _blank},
            mid_column="model_id",
        ),
    )
}


def last_run(cat: Catalog, spec: PlatformSpec) -> DataFrame:
    """One row: the latest processing date of the platform in the wide table."""
    wide = cat.read_or_empty("listing_wide", S.LISTING_WIDE)
    return high_water_mark(wide, "date_add", F.col("car_platform") == spec.name)


def mapping(cat: Catalog, spec: PlatformSpec, mark: DataFrame) -> DataFrame:
    """(platform_key, che300_model_id, std_modelid), only keys that map to one model."""
    xlat = cat.read(spec.xlat)
    if spec.mid_column is None:
        xlat = newer_than_mark(xlat, "update_time", mark)
    pairs = xlat.select("std_modelid", F.col(spec.xlat_id).try_cast("long").alias("platform_key")).join(
        cat.read("xlat_standard").select("std_modelid", "che300_model_id"), "std_modelid")
    return only_unique(pairs, ["platform_key"])


def raw_listings(cat: Catalog, spec: PlatformSpec, mark: DataFrame) -> DataFrame:
    """Raw rows under listing names; model-keyed platforms only since the mark, ids that are no numbers left out."""
    src = cat.read(spec.source)
    if spec.mid_column is not None:
        src = newer_than_mark(src, "update_time", mark)
    src = src.where(F.col(spec.id_column).try_cast("long").isNotNull())
    columns: dict[str, str | Column] = {"id_data_input": F.col(spec.id_column).try_cast("long")}
    for target, source in spec.columns.items():
        columns[target] = source if isinstance(source, str) else source()
    key = spec.mid_column or spec.id_column
    columns["platform_key"] = F.col(key).try_cast("long")
    return project(src, columns)


def unreadable(cat: Catalog, platform: str) -> DataFrame:
    """Source rows whose id, price or mileage is no number, with the first of these as ``reason``."""
    spec = PLATFORMS[platform]
    price = "deal_price" if platform == "ttp" else "quotes" if platform == "che168" else "price"
    rules = {f"{c} is no number": F.col(c).try_cast(kind).isNotNull() | (F.lit(c != spec.id_column) & F.col(c).isNull())
             for c, kind in ((spec.id_column, "long"), (price, "double"), ("mile", "double"))}
    return quality.explain_rejects(cat.read(spec.source), rules).where("reason IS NOT NULL")


def clean_raw(df: DataFrame, spec: PlatformSpec, places: geo.Gazetteer) -> DataFrame:
    """Latest row per listing, listing day, place, fee and expiry flags."""
    df = latest_by(df, ["id_data_input"], "update_time")
    df = df.withColumns({"add_time": spec.added(), "update_time": listing.day(F.col("update_time"))})
    if spec.strip_brackets:
        df = df.withColumn("location", listing.strip_brackets(F.col("location")))
    if spec.fee_text:
        df = df.withColumn("trans_fee", listing.transfer_fee(F.col("trans_fee")))
    if spec.expiry:
        df = df.withColumns({c: listing.expiry_flag(F.col("add_time"), F.col(c)) for c in spec.expiry})
    return geo.standardise_listing_location(df, places, spec.county_fallback)


def model_dim(cat: Catalog, models: DataFrame) -> DataFrame:
    """Mapping, catalogue and brand country in one row per platform key: model-sized, joined before any listing."""
    major = cat.read("catalogue_major").select(
        F.col("model_id").alias("che300_model_id"), "std_brandid", "std_seriesid",
        F.col("brand_name").alias("brand"), F.col("series_name").alias("series"),
        "model_name", "model_price", "model_year", "auto", "liter", "discharge_standard",
        "car_level", "is_green", "is_import",
    )
    country = cat.read("brand_country").select("std_brandid", "car_country").distinct()
    return models.join(major, "che300_model_id").join(country, "std_brandid")


def enrich(df: DataFrame, cat: Catalog, spec: PlatformSpec, models: DataFrame, places: geo.Gazetteer) -> DataFrame:
    """Star join: district and model attributes; listings without either are dropped."""
    cities = geo.one_row_per_city(places.districts).withColumnRenamed("city", "location").drop("regional")
    # '' is no city; a NULL here would make Spark test, and so compute, the place a second time
    df = df.withColumn("location", F.coalesce("location", F.lit("")))
    cities = cities.where("location <> ''")
    if places.cities is not None:
        # one row per city and the cities were counted when the dictionary was loaded
        df = df.join(F.broadcast(cities), "location")
    else:
        df = lookup_join(df, cities, ["location"], "inner")
    dim = model_dim(cat, models)
    if spec.mid_column is None:
        # one listing per mapping and both have one row per id: joined where the latest rows already lie
        df = df.drop("platform_key").join(dim.withColumnRenamed("platform_key", "id_data_input"), "id_data_input")
    else:
        df = broadcast_lookup_join(df, dim, ["platform_key"], "inner")
    month = listing.reg_month(F.col("regDate"))
    return df.withColumns({
        "car_platform": F.lit(spec.name),
        "id_che300": F.col("che300_model_id"),
        "mile": F.round(F.col("mile").try_cast("double"), 2),
        "quotes": F.round(F.col("quotes").try_cast("double"), 2),
        "regDate": month,
        "user_years": listing.age_years(F.col("add_time"), month),
        "partition_month": listing.partition_month(F.col("add_time")),
    })


def clean_common(df: DataFrame, run_date: str) -> DataFrame:
    df = listing.text_defaults(df)
    df = df.withColumns({"color": listing.color(F.col("color")), "date_add": F.lit(run_date).cast("date")})
    return df.where(quality.listing_ok(
        F.col("quotes"), F.col("model_price"), F.col("user_years"), F.col("regDate"), run_date))


def wide_rows(cat: Catalog, platform: str, run_date: str) -> DataFrame:
    """All stages of one platform as one lazy plan with the wide table's columns."""
    spec = PLATFORMS[platform]
    mark = last_run(cat, spec)
    models = mapping(cat, spec, mark)
    places = geo.Gazetteer.load(geo.county_dim(cat.read("dim_district"), cat.read("dim_region")))
    raw = clean_raw(raw_listings(cat, spec, mark), spec, places)
    return align(clean_common(enrich(raw, cat, spec, models, places), run_date), S.LISTING_WIDE)


def superseded(cat: Catalog, platform: str) -> DataFrame:
    """Ids of older crawls of a car: the car has several rows, one of them newly mapped, this one not."""
    spec = PLATFORMS[platform]
    ids = mapping(cat, spec, last_run(cat, spec)).select(
        F.col("platform_key").alias("id"), F.lit(True).alias("_mapped"))
    rows = cat.read(spec.source).select(F.col("id").try_cast("long").alias("id"), "car_id").where("id IS NOT NULL")
    rows = rows.join(ids, "id", "left").withColumn("_mapped", F.coalesce("_mapped", F.lit(False)))
    cars = rows.groupBy("car_id").agg(F.count(F.lit(1)).alias("_n"), F.bool_or("_mapped").alias("_any"))
    cars = cars.where("_n > 1 AND _any AND car_id IS NOT NULL").select("car_id")
    return lookup_join(rows.where("NOT _mapped"), cars, ["car_id"], "inner").select("id").distinct()


def plan(cat: Catalog, platform: str, run_date: str, old: DataFrame | None = None) -> list[Change]:
    """The changes of one run; ``old`` has the superseded crawls, if they are known already."""
    spec = PLATFORMS[platform]
    changes = []
    if spec.drops_superseded:
        old = superseded(cat, platform) if old is None else old
        gone = old.select(F.lit(spec.name).alias("car_platform"), F.col("id").alias("id_data_input"))
        changes += [
            Change("listing_wide", gone, ("car_platform", "id_data_input"), "delete"),
            Change(spec.source, old, ("id",), "delete"),
        ]
    changes.append(into(S.LISTING_WIDE, "listing_wide", wide_rows(cat, platform, run_date)))
    return changes


KEYS = ("car_platform", "id_data_input")
PARTITIONS = ("car_platform", "partition_month")


# Partition of listings whose month is unknown; a NULL would match no partition.
UNKNOWN_MONTH = "unknown"


def wide_table(spark: SparkSession, path: str) -> ManifestTable:
    """The wide table at ``path``: a partition for each platform and month."""
    return ManifestTable(spark, path, S.LISTING_WIDE, PARTITIONS)


def commit_wide(
    table: ManifestTable, platform: str, rows: DataFrame, deleted: DataFrame | None = None, attempts: int = 5
) -> None:
    """Merge a platform's rows into the wide table as one new version, rewriting only the months they touch.

    ``deleted`` has listing ids (column ``id``) that leave the table. Of several
    rows with one key the smallest counts, in the first write as in later ones.
    The rows are written to the shared folder once, since they are read for the
    months and for the merge; if another writer is first, only the merge is
    made again.
    """
    month = F.coalesce("partition_month", F.lit(UNKNOWN_MONTH))
    rows, _ = staged(one_per_key(align(rows, S.LISTING_WIDE).withColumn("partition_month", month), KEYS), "listings")
    ids = table.rows_of(None).select("id_data_input") if deleted is None else deleted.select(F.col("id").try_cast("long").alias("id_data_input"))
    gone, _ = staged(ids.withColumn("car_platform", F.lit(platform)), "gone-listings")
    for attempt in range(attempts):
        old = table.manifest()
        mine = table.rows_of(old, [c for c in old.folders if c[0] == platform] if old else [])
        found = touched_partitions(mine, rows, KEYS, PARTITIONS).unionByName(mine.join(gone, list(KEYS), "left_semi").select(*PARTITIONS))
        # months of one platform, not rows
        touched = [tuple(r) for r in found.distinct().collect()]
        inside = merge.delete_matching(table.rows_of(old, touched), gone, KEYS)
        try:
            table.replace(merge.upsert(inside, rows, KEYS), touched, old)
            break
        except Conflict:
            if attempt + 1 == attempts:
                raise
    drop_staged(rows)
    drop_staged(gone)


@dataclass(frozen=True)
class WideSink:
    """The partitioned wide table as the sink of planned changes: rows of one platform, or its listings that go."""

    table: ManifestTable
    platform: str

    def take(self, change: Change, target: Callable[[], DataFrame]) -> str:
        if change.mode == "delete":
            commit_wide(self.table, self.platform, self.table.rows_of(None), change.rows.select(F.col("id_data_input").alias("id")))
        elif change.mode == "upsert":
            commit_wide(self.table, self.platform, change.rows)
        else:
            raise ValueError(f"the wide table takes no {change.mode}")
        return f"{self.table.root}@{self.table.manifest().version}"

    def read(self) -> DataFrame:
        return self.table.read()


def run(cat: Catalog, platform: str, run_date: str, path: str, source: SnapshotTable | BucketTable | Sink | None = None) -> list[str]:
    """One platform, from its mark to the wide table at ``path``.

    A platform that drops superseded crawls drops them from its ``source`` as
    well. What is to be written to either is journaled first: a run that stops
    between the tables is finished by the next one. A source without rows is
    refused.
    """
    spec = PLATFORMS[platform]
    if spec.drops_superseded and source is None:
        raise ValueError(f"{platform} deletes from its source: name the table")
    table = wide_table(cat.spark, path)
    stores = {"listing_wide": WideSink(table, platform)} | ({spec.source: source} if spec.drops_superseded else {})
    journal, name = Journal(cat.spark, f"{path}/journal"), f"listings-{platform}"
    if table.manifest() is not None:
        cat.bind("listing_wide", table.read)
    done = resume(cat, journal, name, stores)
    quality.require_some(cat.read(spec.source), spec.source)
    # both tables lose the same crawls: these are found once
    old = staged(superseded(cat, platform), "superseded")[0] if spec.drops_superseded else None
    try:
        return done + commit_all(cat, plan(cat, platform, run_date, old), stores, journal, name, {"listing_wide": S.LISTING_WIDE})
    finally:
        if old is not None:
            drop_staged(old)
