"""Target layouts with keys and defaults (kept as column metadata)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from listingflow import fixed_values as V

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "text": T.StringType(),
    "price": T.DecimalType(10, 2), "time": T.TimestampType(), "double": T.DoubleType(),
    "date": T.DateType(),
}


def layout(key: str | Sequence[str], *columns: tuple) -> T.StructType:
    """A schema from (name, kind[, default]) entries; key columns are marked."""
    keys = (key,) if isinstance(key, str) else tuple(key)
    fields = []
    for name, kind, *default in columns:
        meta = {"key": True} if name in keys else {}
        if default:
            meta["default"] = default[0]
        fields.append(T.StructField(name, _TYPES[kind], name not in keys, meta))
    return T.StructType(fields)


def keys_of(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("key")]


def defaults_of(schema: T.StructType) -> dict[str, object]:
    return {f.name: f.metadata["default"] for f in schema.fields if "default" in f.metadata}


def _texts(names: Sequence[str], default: str | None = V.UNKNOWN) -> list[tuple]:
    return [(n, "text") if default is None else (n, "text", default) for n in names]


ODS_MODEL_EV = layout(
    "model_id", ("model_id", "long"), *_texts(V.EV_TEXT_COLUMNS),
    ("update_time", "time"), ("add_time", "time"),
)
ODS_STANDARD_EV = ODS_MODEL_EV

_NO_DEFAULT = ("color_outside", "color_outside_code")
ODS_MODEL_DETAIL = layout(
    "autohome_id", ("autohome_id", "long"),
    *_texts([c for c in V.DETAIL_TEXT_COLUMNS if c not in _NO_DEFAULT]),
    *_texts(_NO_DEFAULT, None), ("url", "text"), ("update_time", "time"),
)
ODS_STANDARD_DETAIL = layout(
    "model_id", ("model_id", "long"),
    *_texts([c for c in V.DETAIL_TEXT_COLUMNS[V.DETAIL_TEXT_COLUMNS.index("master_air_bag"):]
             if c not in _NO_DEFAULT]),
    ("update_time", "time"),
)
ODS_BRAND = layout(
    "brandid", ("brandid", "int"), ("Initial", "text"), ("brand_name", "text"),
    ("car_country", "text", V.NONE_TEXT),
)
ODS_SERIES = layout(
    "series_id", ("series_id", "int"), ("series_group_name", "text"), ("series_name", "text"),
    ("brandid", "int"), ("brand_name", "text"), ("car_level", "text", V.NONE_TEXT),
    ("is_import", "int", 0),
)
ODS_STANDARD_MASTER = layout(
    "model_id", ("model_id", "long"), ("Initial", "text"), ("brandid", "int"), ("brand_name", "text"),
    ("series_group_name", "text"), ("series_id", "int"), ("series_name", "text"), ("model_name", "text"),
    ("model_price", "price", 0), ("model_year", "text"), ("auto", "text", V.UNKNOWN),
    ("liter", "text", V.UNKNOWN), ("liter_type", "text", V.UNKNOWN), ("gear_type", "text", V.UNKNOWN),
    ("discharge_standard", "text", V.UNKNOWN), ("max_reg_year", "text"), ("min_reg_year", "text"),
    ("car_level", "text"), ("seat_number", "text"), ("short_name", "text"), ("hl_configs", "text"),
    ("hl_configc", "text"), ("is_green", "int", 0), ("update_time", "time"),
)
ODS_MODEL_MASTER = layout(
    "model_id", ("model_id", "long"), ("brandid", "int"), ("brand_name", "text"), ("Initial", "text"),
    ("series_group_name", "text"), ("series_id", "int"), ("series_name", "text"), ("model_year", "text"),
    ("model_name", "text"), ("model_price", "price", 0), ("status", "text"), ("liter", "text", V.UNKNOWN),
    ("auto", "text", V.UNKNOWN), ("discharge_standard", "text", V.UNKNOWN), ("is_green", "int", 0),
    ("is_check", "int", 0),
)
ODS_OWNER_MASTER = layout(
    "model_id", ("model_id", "long"), ("brandid", "int"), ("brand_name", "text"), ("Initial", "text"),
    ("series_group_name", "text"), ("series_id", "int"), ("series_name", "text"), ("model_year", "int", 0),
    ("model_name", "text"), ("model_price", "price", 0), ("liter", "text", V.UNKNOWN),
    ("auto", "text", V.UNKNOWN), ("discharge_standard", "text", V.UNKNOWN),
)
ODS_COLOR = layout(
    "id", ("id", "long"), ("series_id", "int"), ("color_outside", "text"),
    ("color_outside_code", "text"), ("update_time", "time"),
)
PROD_BRAND = layout(
    "brandid", ("brandid", "int"), ("Initial", "text"), ("brand_name", "text"), ("car_country", "text"),
)
PROD_SERIES = layout(
    "series_id", ("series_id", "int"), ("series_group_name", "text"), ("series_name", "text"),
    ("brandid", "int"), ("brand_name", "text"), ("car_level", "text"), ("is_import", "text"),
)
_PROD_DETAIL = [V.TORQUE_PRODUCTION if c == "max_n_m" else c for c in V.DETAIL_TEXT_COLUMNS]
PROD_CONFIG = layout(
    "id", ("id", "long"), ("autohome_id", "long"), ("mark", "text"), ("brandid", "int"), ("brand", "text"),
    ("series_id", "int"), ("series", "text"), ("is_selling", "text"), ("type_name", "text"),
    ("recommend_price", "text"), ("year", "text"), ("factory_name", "text"), ("produced_place", "text"),
    ("is_green", "int"), *_texts(_PROD_DETAIL, None), ("hl_configs", "text"), ("hl_configc", "text"),
    ("environmental_standards", "text"),
)
PROD_EV = layout(
    "id", ("id", "long"), *_texts([c for c in V.EV_TEXT_COLUMNS if c != "ee_fast_charge"], None),
    (V.EV_FAST_CHARGE_PRODUCTION, "text"),
)

_LISTING_TYPES = {
    "id_data_input": "long", "id_che300": "long", "is_import": "text", "is_green": "text",
    "quotes": "double", "model_price": "double", "mile": "double", "user_years": "double",
    "add_time": "date", "update_time": "date", "date_add": "date",
}
LISTING_WIDE = layout(
    ("car_platform", "id_data_input"),
    *[(c, _LISTING_TYPES.get(c, "text")) for c in V.LISTING_COLUMNS],
)
STD_BRAND = layout(
    "brandid", ("brandid", "int"), ("Initial", "text"), ("brand_name", "text"), ("std_brandid", "text"),
    ("car_country", "text"),
)
STD_SERIES = layout(
    "series_id", ("series_id", "int"), ("series_group_name", "text"), ("series_name", "text"),
    ("std_seriesid", "text"), ("is_import", "text"), ("car_level", "text"), ("is_green", "text"),
)
STD_MODEL = layout(
    "model_id", ("std_modelid", "text"), ("model_id", "long"), ("auto", "text"), ("liter", "text"),
    ("is_green", "int"), ("is_check", "int"),
)
STD_WIDE_COLUMNS = (
    "std_modelid", "model_id", "Initial", "brandid", "std_brandid", "brand_name", "series_group_name",
    "series_id", "std_seriesid", "series_name", "model_name", "short_name", "model_price", "model_year",
    "auto", "liter", "discharge_standard", "max_reg_year", "min_reg_year", "car_level", "seat_number",
    "hl_configs", "hl_configc", "is_green", "is_import",
)
MATCH_RESULT = layout(
    "id_che300", ("id_che300", "text"),
    *[c for p in V.MATCH_PLATFORMS
      for c in ((f"id_{p}", "text"), (f"match_type_{p}", "int"), (f"is_only_{p}", "int"))],
)
