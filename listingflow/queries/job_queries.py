"""Whole jobs on vehicle-shaped tables that are derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.operators import quality
from listingflow.operators.store import BucketTable
from listingflow.plans import base, catalogue_ids, catalogue_to_ods, ods_to_production, platform_match, resync, side_data
from listingflow.plans.base import planned
from listingflow.queries.base import DERIVED, QUERIES, Query, cases, duck, duck_fold, query
from listingflow.queries.match_queries import _rounds_sql
from listingflow.queries.merge_queries import fresh_folder
from listingflow.queries.rule_queries import gearbox_sql, leftmost, pick
from listingflow.session import cut_lineage
from listingflow.sources.catalog import Catalog

CATALOGUE_RUN = "2024-01-29"
SIDE_RUN = "2022-03-28"

# --- derived vehicle tables ------------------------------------------------
# A part is a model, its brand a brand, brand and type together a series.

_BRAND = "CAST(substr(p_brand, 7) AS INT)"
_KIND = "CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END"
_SERIES = f"{_BRAND} * 10 + {_KIND}"
_YEAR = "CAST(2014 + p_size % 8 AS STRING)"
_LETTER = f"substr('ABCDEFGHIJ', {_BRAND} % 10 + 1, 1)"
_GROUP = "CASE p_type WHEN 'ECONOMY' THEN '宝马' WHEN 'LARGE' THEN '北京奔驰' WHEN 'PROMO' THEN '进口宝马' ELSE '国产' END"
_NAME = f"{_YEAR} || '款 ' || {cases('p_partkey', ['1.5L 手动舒适型', '2.0T DCT豪华 国V', '1.8L CVT 国IV 豪华', '长续航版', '1.6L AT'])}"
_DAY = "CAST('2024-01-01' AS DATE) + CAST(p_partkey % 28 AS INT)"
_PRICE = "CASE p_partkey % 17 WHEN 0 THEN 0.0 ELSE round(p_retailprice / 50, 2) END"

DERIVED["j_master"] = f"""SELECT p_partkey AS model_id, {_BRAND} AS brand_id, p_brand AS brand_name, {_LETTER} AS brand_letter,
    {_GROUP} AS series_group_name, {_SERIES} AS series_id,
    p_type || CASE p_type WHEN 'ECONOMY' THEN '(进口)' WHEN 'LARGE' THEN '(停售)' ELSE '' END AS series_name,
    CASE p_partkey % 13 WHEN 0 THEN NULL ELSE {_YEAR} END AS model_year, {_NAME} AS model_name, {_PRICE} AS model_price,
    {cases('p_size', ['在售', '停产在售', '即将销售', '停售', '未上市'])} AS status, {_DAY} AS add_time FROM part"""

_SPECIAL = {
    "emission": ["1.5T 150马力", "2.0L", "-", "4650"],
    "level": ["紧凑型SUV", "中型车", "-", "豪华MPV", None],
    "gear_box": ["5挡手动", "7挡双离合", "CVT无级变速(模拟8挡)", "电动车单速变速箱", None],
    "fuel": ["汽油", "纯电动", "油电混合", None, "插电式混合动力"],
    "environmental_standards_org": ["国VI(国V)", "国4+OBD", "-", None, "未知"],
    "color_outside": ["红;白;", "无", None, "黑;;"],
    "color_outside_code": ["#f00;#fff;", "无", None],
}
_EQUIPPED = ["标配", "选配", "-", "无", "主标配\\/副标配", None]


def _detail_column(position: int, name: str) -> str:
    if name in _SPECIAL:
        return f"{cases(f'p_partkey + {position}', _SPECIAL[name])} AS {name}"
    if name in V.EQUIPMENT_COLUMNS:
        return f"{cases(f'p_partkey + {position}', _EQUIPPED)} AS {name}"
    return f"CASE (p_partkey + {position}) % 9 WHEN 0 THEN NULL ELSE p_name END AS {name}"


DERIVED["j_detail"] = f"""SELECT p_partkey AS autohome_id,
    {', '.join(_detail_column(i, c) for i, c in enumerate(V.DETAIL_TEXT_COLUMNS))},
    '/m/' || CAST(p_partkey AS STRING) AS url, {_DAY} AS update_time FROM part"""

_EV_VALUES = {
    "ee_type": ["永磁/同步", "前异步/后永磁", None, ""], "ee_battery_type": ["三元锂电池", "铅酸", "磷酸铁锂"],
    "ee_pure_electric_range": ["510km", "标配", "300公里"], "ee_battery_quality_assurance": ["八年或12万公里", "十五年", None],
    "ee_fast_charging_time": ["0.5", "待查"], "ee_slow_charging_time": ["8", "选配"], "ee_fast_charge": ["80", "-", ""],
}


def _ev_column(position: int, name: str) -> str:
    if name in _EV_VALUES:
        return f"{cases(f'p_size + {position}', _EV_VALUES[name])} AS {name}"
    return f"CASE (p_size + {position}) % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(p_size AS STRING) END AS {name}"


DERIVED["j_ev"] = f"""SELECT p_partkey AS model_id, {', '.join(_ev_column(i, c) for i, c in enumerate(V.EV_TEXT_COLUMNS))},
    {_DAY} AS add_time FROM part WHERE p_type = 'PROMO'"""
DERIVED["j_color"] = f"""SELECT p_partkey AS id, {_SERIES} AS series_id, CASE p_size % 3 WHEN 0 THEN NULL ELSE p_name || ';' END AS color_outside,
    p_brand AS color_outside_code FROM part WHERE p_type <> 'SMALL'"""
# what the stores hold before a run
DERIVED["j_ods_brand"] = f"""SELECT DISTINCT {_BRAND} AS brandid, {_LETTER} AS Initial, p_brand AS brand_name, '无' AS car_country
    FROM part WHERE {_BRAND} <= 12"""
DERIVED["j_ods_series"] = f"""SELECT DISTINCT {_SERIES} AS series_id, {_GROUP} AS series_group_name, p_type AS series_name,
    {_BRAND} AS brandid, p_brand AS brand_name, CASE p_type WHEN 'SMALL' THEN NULL ELSE '中型车' END AS car_level, 0 AS is_import
    FROM part WHERE {_BRAND} <= 20"""
DERIVED["j_ods_master"] = f"""SELECT p_partkey AS model_id, {_BRAND} AS brandid, p_brand AS brand_name, {_LETTER} AS Initial,
    {_GROUP} AS series_group_name, {_SERIES} AS series_id, p_type AS series_name, {_YEAR} AS model_year, {_NAME} AS model_name,
    {_PRICE} AS model_price, '在售' AS status, '1.5' AS liter, '手动' AS auto, '国五' AS discharge_standard, p_size % 5 AS is_green,
    CASE p_size % 9 WHEN 0 THEN 0 ELSE 1 END AS is_check FROM part"""
DERIVED["j_prod_brand"] = f"""SELECT DISTINCT {_BRAND} AS brandid, {_LETTER} AS Initial, p_brand AS brand_name, '德国' AS car_country
    FROM part WHERE {_BRAND} <= 18"""
DERIVED["j_prod_series"] = f"""SELECT DISTINCT {_SERIES} AS series_id, {_GROUP} AS series_group_name, p_type AS series_name,
    {_BRAND} AS brandid, p_brand AS brand_name, '中型车' AS car_level, '0' AS is_import FROM part WHERE p_type <> 'LARGE'"""
_HAND_MADE = "CASE WHEN p_size = 7 THEN p_partkey + 2000000000 ELSE p_partkey END"
DERIVED["j_prod_config"] = f"""SELECT p_partkey + 90 AS id, {_HAND_MADE} AS autohome_id, p_brand AS brand,
    CASE p_partkey % 3 WHEN 0 THEN CAST({_PRICE} AS STRING) WHEN 1 THEN 'n/a' ELSE '18.5' END AS recommend_price
    FROM part WHERE p_type IN ('PROMO', 'MEDIUM')"""


def vehicle_catalog(t) -> Catalog:
    cat = Catalog(t.spark)
    for name, table in {
        "src_model_master": "j_master", "src_model_detail": "j_detail", "src_model_ev": "j_ev", "src_color": "j_color",
        "ods_brand": "j_ods_brand", "ods_series": "j_ods_series", "ods_model_master": "j_ods_master",
        "ods_model_detail": "j_detail", "prod_brand": "j_prod_brand", "prod_series": "j_prod_series",
        "prod_config": "j_prod_config",
    }.items():
        cat.bind(name, lambda table=table: getattr(t, table))
    # the operational store's EV rows are the cleaned source rows
    cat.bind("ods_model_ev", lambda: catalogue_to_ods.ev_rows(cat, "2023-01-01"))
    return cat


# --- catalogue to the operational store ------------------------------------

_WEEK = "DATE '2024-01-22'"


def _dashed(name: str) -> str:
    return f"coalesce(nullif({name}, ''), '-')"


def ev_columns_sql() -> dict[str, str]:
    out = {c: _dashed(c) for c in V.EV_TEXT_COLUMNS}
    out["ee_type"] = duck_fold(out["ee_type"], V.EV_TYPE_RULES)
    for c in ("ee_fast_charging_time", "ee_slow_charging_time"):
        out[c] = duck_fold(out[c], V.EV_CHARGING_TIME_RULES)
    out["ee_battery_type"] = f"coalesce({pick(out['ee_battery_type'], V.EV_BATTERY_KINDS)} || '电池', '-')"
    out["ee_pure_electric_range"] = duck_fold(out["ee_pure_electric_range"], V.EV_RANGE_RULES)
    out["ee_battery_quality_assurance"] = duck_fold(out["ee_battery_quality_assurance"], V.EV_WARRANTY_RULES)
    charge = out["ee_fast_charge"]
    out["ee_fast_charge"] = f"CASE WHEN {charge} <> '-' THEN {charge} || '%' ELSE {charge} END"
    return out


def ev_sql(since: str) -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in ev_columns_sql().items())
    return f"SELECT model_id, {columns}, add_time, add_time AS update_time FROM j_ev WHERE add_time >= {since}"


@query("job_ev_to_ods", ev_sql(_WEEK))
def job_ev_to_ods(t):
    return catalogue_to_ods.ev_rows(vehicle_catalog(t), CATALOGUE_RUN)


@query("job_detail_to_ods", f"""
    SELECT b.* FROM j_detail b JOIN j_master a ON a.model_id = b.autohome_id
    WHERE a.model_year IS NOT NULL AND b.level <> '-' AND b.update_time >= {_WEEK}""")
def job_detail_to_ods(t):
    return catalogue_to_ods.detail_rows(vehicle_catalog(t), CATALOGUE_RUN)


@query("job_brands_to_ods", """
    SELECT DISTINCT brand_id AS brandid, brand_letter AS "Initial", brand_name, '无' AS car_country FROM j_master
    WHERE brand_id NOT IN (SELECT brandid FROM j_ods_brand)""")
def job_brands_to_ods(t):
    return catalogue_to_ods.new_brands(vehicle_catalog(t))


_IMPORT = duck_fold("CASE WHEN series_name LIKE '%进口%' THEN '进口' || series_group_name ELSE series_group_name END",
                    [(V.IMPORT_REPEATS, "进口")])


@query("job_series_to_ods", f"""
    WITH s AS (SELECT DISTINCT a.series_id, series_group_name, series_name, brand_id, brand_name, level
        FROM j_master a JOIN j_detail b ON a.model_id = b.autohome_id
        WHERE level <> '-' AND series_id NOT IN (SELECT series_id FROM j_ods_series)),
    n AS (SELECT series_id, {_IMPORT} AS series_group_name, upper({duck_fold('series_name', [(V.IMPORT_OR_STOPPED_SUFFIX, '')])}) AS series_name,
        brand_id AS brandid, brand_name, coalesce({pick('level', '(' + V.CAR_LEVELS + ')')}, '无') AS car_level,
        CAST({_IMPORT} LIKE '%进口%' AS INTEGER) AS is_import FROM s)
    SELECT series_id, series_group_name, series_name, brandid, brand_name, min(car_level) AS car_level, is_import FROM n GROUP BY ALL""")
def job_series_to_ods(t):
    return catalogue_to_ods.new_series(vehicle_catalog(t))


def master_sql(scope: str) -> str:
    green = """CASE WHEN fuel LIKE '%纯电%' THEN 1 WHEN fuel LIKE '%油电%' THEN 2 WHEN fuel LIKE '%插电%' THEN 3
        WHEN fuel LIKE '%增程%' THEN 4 ELSE CAST(c.model_id IS NOT NULL AS INTEGER) END"""
    standard = duck_fold(
        f"CASE WHEN regexp_matches(environmental_standards_org, {duck(V.EMISSION_MARK)}) THEN environmental_standards_org "
        f"ELSE {pick('model_name', V.EMISSION_IN_NAME)} END", V.EMISSION_RULES)
    liter = f"coalesce({pick('emission', V.DISPLACEMENT)}, {pick('model_name', V.DISPLACEMENT)})"
    return f"""SELECT a.model_id, brand_id AS brandid, brand_name, brand_letter AS "Initial", series_group_name, series_id, series_name,
        model_year, model_name, model_price, coalesce({pick('status', V.SALE_STATUS)}, status) AS status,
        CASE WHEN {green} = 1 THEN '-' ELSE {liter} END AS liter,
        CASE WHEN {green} = 1 THEN '电动' ELSE {gearbox_sql('(model_name || gear_box)')} END AS auto,
        {standard} AS discharge_standard, {green} AS is_green, 1 AS is_check
      FROM j_master a JOIN j_detail b ON a.model_id = b.autohome_id LEFT JOIN j_ev c ON a.model_id = c.model_id
      WHERE status <> '即将销售' AND model_year IS NOT NULL AND model_price <> 0 AND level <> '-' AND {scope}"""


@query("job_master_to_ods", master_sql(f"a.add_time >= {_WEEK}"))
def job_master_to_ods(t):
    return catalogue_to_ods.master_rows(vehicle_catalog(t), CATALOGUE_RUN)


# --- operational store to production ---------------------------------------

@query("job_new_brands", """SELECT * FROM j_ods_brand WHERE brandid NOT IN (
    SELECT brandid + CASE brandid % 3 WHEN 0 THEN 1000000 ELSE 0 END FROM j_prod_brand)""")
def job_new_brands(t):
    # all of production's brands, some under ids that the store does not have
    moved = F.when(F.col("brandid") % 3 == 0, F.col("brandid") + 1000000).otherwise(F.col("brandid"))
    return ods_to_production.new_brands(vehicle_catalog(t).overlay(prod_brand=t.j_prod_brand.withColumn("brandid", moved)))


@query("job_new_series", """SELECT * FROM j_ods_series WHERE series_id NOT IN (SELECT series_id FROM j_prod_series)""")
def job_new_series(t):
    return ods_to_production.new_series(vehicle_catalog(t))


_COLORED = """colors AS (SELECT series_id, min(struct_pack(o := color_outside, c := color_outside_code)) AS v FROM j_color
        WHERE color_outside IS NOT NULL GROUP BY series_id)"""


@query("job_color_backfill", f"""
    WITH {_COLORED} SELECT d.* REPLACE (CASE WHEN v IS NOT NULL THEN v.o ELSE color_outside END AS color_outside,
        CASE WHEN v IS NOT NULL THEN v.c ELSE color_outside_code END AS color_outside_code)
    FROM j_detail d LEFT JOIN j_ods_master m ON d.autohome_id = m.model_id LEFT JOIN colors ON m.series_id = colors.series_id""")
def job_color_backfill(t):
    return ods_to_production.color_backfill(vehicle_catalog(t)).apply(t.j_detail)


def config_sql(scope: str) -> str:
    """The production wide row of each approved model in scope, before ids."""
    out = {c: c for c in V.DETAIL_TEXT_COLUMNS}
    front = f"{chr(92)}?{V.PAIR_SEPARATOR}.*|{V.PAIR_SEPARATOR}.*"
    rear = f".*{V.PAIR_SEPARATOR}{chr(92) * 2}?|.*{V.PAIR_SEPARATOR}"
    for c in V.FRONT_COLUMNS:
        out[c] = duck_fold(out[c], [(front, "")])
    for c in V.REAR_COLUMNS:
        out[c] = duck_fold(out[c], [(rear, "")])
    for c in V.EQUIPMENT_COLUMNS:
        out[c] = duck_fold(out[c], V.EQUIPMENT_RULES)
    for c in ("color_outside", "color_outside_code"):
        out[c] = duck_fold(out[c], V.CATALOGUE_COLOR_RULES)
    out["emission"] = "split_part(emission, ' ', 1)"
    out["level"] = "s.car_level"
    texts = ", ".join(f"""coalesce({e}, '-') AS "{V.TORQUE_PRODUCTION if c == 'max_n_m' else c}" """ for c, e in out.items())
    return f"""SELECT autohome_id, pb."Initial" AS mark, m.brandid, pb.brand_name AS brand, m.series_id, ps.series_name AS series,
        m.status AS is_selling, trim(regexp_replace(trim(concat_ws(' ', ps.series_name, m.model_name)), ' +', ' ', 'g')) AS type_name,
        CAST(m.model_price AS VARCHAR) AS recommend_price, m.model_year AS "year", ps.series_group_name AS factory_name,
        '' AS produced_place, m.is_green, {texts}, '' AS hl_configs, '' AS hl_configc,
        coalesce({duck_fold('environmental_standards_org', V.EMISSION_PRODUCTION_RULES)}, '-') AS environmental_standards
      FROM j_detail d JOIN j_ods_master m ON d.autohome_id = m.model_id JOIN j_prod_brand pb ON m.brandid = pb.brandid
      JOIN j_prod_series ps ON m.series_id = ps.series_id LEFT JOIN j_ods_series s ON m.series_id = s.series_id
      WHERE is_check = 1 AND {scope}"""


@query("job_config_wide", config_sql("autohome_id NOT IN (SELECT autohome_id FROM j_prod_config)"))
def job_config_wide(t):
    return ods_to_production.config_rows(vehicle_catalog(t))


@query("job_price_changes", f"""
    SELECT autohome_id, model_price AS recommend_price_new, recommend_price AS recommend_price_old
    FROM j_ods_master JOIN j_prod_config ON model_id = autohome_id
    WHERE is_check = 1 AND autohome_id <= {V.MANUAL_ID_THRESHOLD}
      AND coalesce(model_price <> try_cast(recommend_price AS DOUBLE), true)""")
def job_price_changes(t):
    return ods_to_production.price_changes(vehicle_catalog(t))


@query("job_ev_export", f"""
    WITH e AS ({ev_sql("DATE '2000-01-01'")})
    SELECT id, {', '.join(_dashed(c) + f' AS {c}' for c in V.EV_TEXT_COLUMNS if c != 'ee_fast_charge')},
        coalesce(nullif(regexp_replace(ee_fast_charge, '^%', '-'), ''), '-') AS "{V.EV_FAST_CHARGE_PRODUCTION}"
    FROM e JOIN j_prod_config ON model_id = autohome_id WHERE autohome_id <= {V.MANUAL_ID_THRESHOLD}""")
def job_ev_export(t):
    return ods_to_production.ev_rows(vehicle_catalog(t))


# --- point re-sync and preview ---------------------------------------------
# The ids to re-sync: parts bought in quantity 50, plus hand-made ids that must be refused.

DERIVED["j_ids"] = """SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_quantity = 50
    UNION ALL SELECT DISTINCT l_partkey + 3000000000 AS id FROM lineitem WHERE l_quantity = 1"""
DERIVED["j_kept"] = f"SELECT id FROM j_ids WHERE id <= {V.MANUAL_ID_THRESHOLD}"


@query("job_resync_master", master_sql("a.model_id IN (SELECT id FROM j_kept)"))
def job_resync_master(t):
    return catalogue_to_ods.master_rows(vehicle_catalog(t), ids=t.j_kept)


@query("job_resync_config", f"""
    WITH fresh AS ({config_sql("d.autohome_id IN (SELECT id FROM j_kept)")})
    SELECT fresh.* FROM fresh""")
def job_resync_config(t):
    return ods_to_production.config_rows(vehicle_catalog(t), t.j_kept, only_new=False)


@query("job_resync_refused", f"""
    SELECT id, 'id above {V.MANUAL_ID_THRESHOLD}' AS reason FROM j_ids WHERE id > {V.MANUAL_ID_THRESHOLD}""")
def job_resync_refused(t):
    return quality.split_on_threshold(t.j_ids, "id")[1]


@query("job_resync_unusable", """
    SELECT id, CASE WHEN a.model_id IS NULL THEN 'unknown model' WHEN b.autohome_id IS NULL THEN 'no detail row'
        WHEN status = '即将销售' THEN 'coming soon' WHEN model_year IS NULL THEN 'no model year'
        WHEN model_price = 0 THEN 'price is zero' ELSE 'level unknown' END AS reason
    FROM j_kept LEFT JOIN j_master a ON id = a.model_id LEFT JOIN j_detail b ON id = b.autohome_id
    WHERE a.model_id IS NULL OR b.autohome_id IS NULL OR status = '即将销售' OR model_year IS NULL OR model_price = 0
       OR coalesce(level, '-') = '-'""")
def job_resync_unusable(t):
    return resync.unusable_ids(vehicle_catalog(t), t.j_kept)


@query("job_change_preview", f"""
    WITH c AS ({config_sql("autohome_id NOT IN (SELECT autohome_id FROM j_prod_config)")})
    SELECT CAST(brandid AS BIGINT) AS key, 'brand' AS kind FROM j_ods_brand WHERE brandid NOT IN (SELECT brandid FROM j_prod_brand)
    UNION ALL SELECT series_id, 'series' FROM j_ods_series WHERE series_id NOT IN (SELECT series_id FROM j_prod_series)
    UNION ALL SELECT model_id, 'config' FROM j_ods_master JOIN j_detail ON autohome_id = model_id WHERE is_check = 1
        AND brandid IN (SELECT brandid FROM j_prod_brand UNION SELECT brandid FROM j_ods_brand)
        AND series_id IN (SELECT series_id FROM j_prod_series UNION SELECT series_id FROM j_ods_series)
        AND model_id NOT IN (SELECT autohome_id FROM j_prod_config)
    UNION ALL SELECT autohome_id, 'price_update' FROM j_ods_master JOIN j_prod_config ON model_id = autohome_id
        WHERE is_check = 1 AND autohome_id <= {V.MANUAL_ID_THRESHOLD}
          AND coalesce(model_price <> try_cast(recommend_price AS DOUBLE), true)""")
def job_change_preview(t):
    keys = {"brand": "brandid", "series": "series_id", "config": "autohome_id", "price_update": "autohome_id"}
    parts = [
        df.select(F.col(keys[kind]).cast("bigint").alias("key"), F.lit(kind).alias("kind"))
        for kind, df in resync.change_preview(vehicle_catalog(t)).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- side data -------------------------------------------------------------

DERIVED["d_complaint"] = """SELECT event_id AS id, 'S' || CAST(user_id % 40 AS STRING) AS series, 'B' || CAST(user_id % 9 AS STRING) AS brand,
    event_type AS question, event_type AS car_type, 'ok' AS car_status, props AS appeal, '2021-05' AS buy_time,
    event_type AS tag1, props AS tag2, 'x' AS tag3, CAST(CAST(ts AS DATE) AS STRING) AS complain_time, CAST(ts AS DATE) - 660 AS add_time
    FROM events"""
# complaints are read 31 days back from the run: 2022-03-28 - 31 days = 2022-02-25
for _feed, _columns in {"src_complaint_1": None, **side_data.COMPLAINT_FEEDS}.items():
    _sql = (
        "SELECT * FROM d_complaint WHERE add_time > DATE '2022-02-25'" if _columns is None else
        f"""SELECT {', '.join(_columns)}, strftime(add_time, '%Y-%m-%d') AS add_time FROM d_complaint
            WHERE strftime(add_time, '%Y-%m-%d') > '2022-02-25'"""
    )

    @query(f"job_complaint_{_feed[-1]}", _sql)
    def _complaint(t, feed=_feed):
        cat = Catalog(t.spark).bind_frame(feed, t.d_complaint)
        return side_data.complaint_feed(cat, feed, SIDE_RUN)


_TAGS = [f"{k}{n}" for n in range(1, 7) for k in ("tag", "des")]
DERIVED["d_owner"] = f"""SELECT o.o_orderkey AS complain_id, o_custkey % 300 AS series_id, p.location AS city,
    {', '.join(f'o_orderpriority AS {c}' for c in _TAGS)}, CAST(o_orderdate AS DATE) + 8300 AS complain_time,
    CAST(o_orderdate AS DATE) + 8400 AS update_time FROM orders o JOIN v_place p ON o.o_orderkey = p.o_orderkey"""


def place_catalog(t, **tables: str) -> Catalog:
    cat = Catalog(t.spark).bind("dim_district", lambda: t.v_district).bind("dim_region", lambda: t.v_region)
    for name, table in tables.items():
        cat.bind(name, lambda table=table: getattr(t, table))
    return cat


def place_ctes(table: str, column: str) -> str:
    """City, county and province words of a text column, and the smallest place rows per key."""
    return f"""cities AS (SELECT DISTINCT key_municipal AS w FROM v_district),
        counties AS (SELECT DISTINCT key_county AS w FROM v_district),
        provinces AS (SELECT DISTINCT key_province AS w FROM v_district),
        county_city AS (SELECT key_county, min(key_municipal) AS city FROM v_district GROUP BY key_county),
        city_province AS (SELECT key_municipal AS city, arg_min(key_province, (regional, key_province)) AS province
            FROM v_district JOIN v_region ON key_province = province GROUP BY key_municipal),
        by_city AS ({leftmost(column, 'cities', 'hit', table)}), by_county AS ({leftmost(column, 'counties', 'hit', table)}),
        by_province AS ({leftmost(column, 'provinces', 'hit', table)}),
        places AS (SELECT x.txt AS place_text, coalesce(by_city.hit, county_city.city) AS place, by_province.hit AS named_province
            FROM (SELECT DISTINCT {column} AS txt FROM {table}) x LEFT JOIN by_city ON x.txt = by_city.txt
            LEFT JOIN by_county ON x.txt = by_county.txt LEFT JOIN county_city ON by_county.hit = key_county
            LEFT JOIN by_province ON x.txt = by_province.txt)"""


@query("job_owner_complaints", f"""
    WITH {place_ctes('d_owner', 'city')}
    SELECT complain_id, series_id, province, place AS city, {', '.join(_TAGS)},
        strftime(complain_time, '%Y-%m-%d') AS complain_time, strftime(update_time, '%Y-%m-%d') AS update_time
    FROM d_owner o JOIN places ON o.city = place_text JOIN city_province cp ON place = cp.city
    WHERE update_time > DATE '2022-02-25'""")
def job_owner_complaints(t):
    return side_data.owner_complaints(place_catalog(t, src_complaint_owner="d_owner"), SIDE_RUN)


DERIVED["d_quote"] = """SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey AS model_id, l_extendedprice AS quote, l_discount AS rate,
    CAST(l_shipdate AS DATE) + 8400 AS stat_time FROM lineitem"""


@query("job_discount", "SELECT * FROM d_quote WHERE stat_time = DATE '2022-03-15'")
def job_discount(t):
    return side_data.dealer_quotes(Catalog(t.spark).bind_frame("src_quote", t.d_quote), SIDE_RUN)


DERIVED["d_sales"] = """SELECT o_orderkey AS id, CASE o_orderkey % 9 WHEN 0 THEN 'bad' ELSE CAST(10 + o_custkey % 255 AS STRING) END AS series_id,
    substr(CAST(CAST(o_orderdate AS DATE) + 8400 AS STRING), 1, 7) AS stat_date, o_custkey AS salesNum,
    CAST(o_orderdate AS DATE) + 8400 AS update_time, CAST(o_orderdate AS DATE) + 8400 AS add_time FROM orders"""
DERIVED["d_series_brand"] = f"""SELECT CAST({_SERIES} AS STRING) AS series_id, p_type AS series_name, CAST({_BRAND} AS STRING) AS brand_id,
    p_brand AS brand_name FROM part"""


@query("job_sales_feed", "SELECT * FROM d_sales WHERE add_time > DATE '2022-03-01'")
def job_sales_feed(t):
    return side_data.sales_feed(Catalog(t.spark).bind_frame("src_sales_a", t.d_sales), SIDE_RUN)


@query("job_sales_volumes", """
    WITH n AS (SELECT DISTINCT * FROM d_series_brand)
    SELECT CAST(brand_id AS BIGINT) AS brand_id, brand_name, try_cast(s.series_id AS BIGINT) AS series_id, series_name,
        CAST(stat_date || '-01' AS DATE) AS stat_date, "salesNum", update_time AS add_time
    FROM d_sales s JOIN n ON try_cast(s.series_id AS BIGINT) = try_cast(n.series_id AS BIGINT)
    WHERE update_time > DATE '2022-02-25'""")
def job_sales_volumes(t):
    cat = Catalog(t.spark).bind_frame("src_sales_b", t.d_sales).bind_frame("src_series_brand", t.d_series_brand)
    return side_data.sales_volumes(cat, SIDE_RUN)


DERIVED["d_review"] = f"""SELECT o_orderkey AS id, o_orderkey + 7 AS eid, CASE o_orderkey % 11 WHEN 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS model_id,
    0 AS isbattery, CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE o_custkey % 50 END AS drivenKilometers_appends,
    o_orderkey % 40 AS drivekilometer, CASE o_orderkey % 13 WHEN 0 THEN 'bad' ELSE substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) END AS boughtdate,
    CAST(10 + o_custkey % 6 AS STRING) || lpad(CAST(o_custkey % 27 AS STRING), 2, '0') || '01' AS boughtcity_id,
    1 AS visitcount, 2 AS helpfulcount, 3 AS commentcount, o_totalprice AS boughtPrice,
    {', '.join(f'o_orderstatus AS {c}' for c in side_data.SCORES)}, o_orderpriority AS satisfaction,
    CAST(CAST(o_orderdate AS DATE) AS STRING) AS append_time, CAST(o_orderdate AS DATE) + 8400 AS add_time FROM orders"""


@query("job_reviews", f"""
    WITH codes AS (SELECT substr(city_code, 1, 2) AS province_id, substr(city_code, 1, 4) AS city_id, key_province AS province,
            min(key_municipal) AS city FROM v_district GROUP BY ALL),
        p AS (SELECT province_id, min(province) AS province FROM codes GROUP BY province_id),
        c AS (SELECT city_id, min(city) AS city FROM codes GROUP BY city_id)
    SELECT id, eid, m.model_id, brand_id, brand_name, series_id, series_name, model_year, model_name, model_price, isbattery,
        try_cast(boughtdate || '-01' AS DATE) AS boughtdate, "boughtPrice", province, city,
        CASE WHEN "drivenKilometers_appends" >= drivekilometer THEN "drivenKilometers_appends" ELSE drivekilometer END AS miles,
        visitcount, helpfulcount, commentcount, {', '.join(f'"{s}" AS {t}' for s, t in side_data.SCORES.items())},
        satisfaction, append_time AS comment_time, strftime(r.add_time, '%Y-%m-%d') AS add_time
    FROM d_review r JOIN j_master m ON try_cast(r.model_id AS BIGINT) = m.model_id
    JOIN p ON substr(boughtcity_id, 1, 2) = p.province_id LEFT JOIN c ON substr(boughtcity_id, 1, 4) = c.city_id
    WHERE r.add_time > DATE '2022-03-01'""")
def job_reviews(t):
    return side_data.review_rows(place_catalog(t, src_review="d_review", src_model_master="j_master"), SIDE_RUN)


DERIVED["d_dealer"] = """SELECT c_custkey AS id, c_custkey % 77 AS dealer_id, 'yes' AS shop_4s, c_name AS name, c_mktsegment AS brand,
    '000' AS linkPhone, 'NATION' AS province_name, c_mktsegment || '市' AS city_name,
    CAST('2022-02-01' AS DATE) + CAST(c_custkey % 60 AS INT) AS update_time FROM customer"""
for _n in (1, 2, 3):
    _city = "regexp_replace(city_name, '市', '', 'g')" if _n == 3 else "city_name"

    @query(f"job_dealers_{_n}", f"""SELECT * REPLACE ({_city} AS city_name) FROM d_dealer WHERE update_time > DATE '2022-03-01'""")
    def _dealers(t, name=f"src_dealer_{_n}"):
        return side_data.dealer_rows(Catalog(t.spark).bind_frame(name, t.d_dealer), name, SIDE_RUN)


_PLACE_TEXT = """CASE l_linenumber % 4 WHEN 0 THEN 'ASIA NATION_' || CAST(l_suppkey % 30 AS STRING)
    WHEN 1 THEN 'by Supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0') WHEN 2 THEN 'NATION_' || CAST(l_suppkey % 26 AS STRING) || '市'
    ELSE CASE l_orderkey % 2 WHEN 0 THEN 'nowhere' ELSE NULL END END"""
DERIVED["d_paid_a"] = f"""SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey AS model_id, l_suppkey AS series_id, l_returnflag AS series_name,
    l_linestatus AS model_name, {_PLACE_TEXT} AS boughtaddress,
    CASE l_orderkey % 9 WHEN 0 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) + 8000 AS STRING) END AS boughtdate, l_suppkey AS owner_price_id,
    CASE l_orderkey % 23 WHEN 0 THEN '0' WHEN 1 THEN 'n/a' ELSE '20.5' END AS model_price, l_extendedprice / 3000 AS bare_price,
    l_extendedprice AS fullprice, l_tax AS purchase_tax, l_tax AS commercial_insure, l_tax AS vehicle_tax, l_tax AS high_insure,
    l_discount AS card_fee, CAST(l_shipdate AS DATE) + 8400 AS add_time FROM lineitem"""
_GAP = "abs(try_cast(model_price AS DOUBLE) - bare_price)"


@query("job_paid_prices_a", f"""
    WITH {place_ctes('d_paid_a', 'boughtaddress')}
    SELECT id, model_id, series_id, series_name, model_name, model_price, named_province AS province, place AS city,
        try_cast(boughtdate AS DATE) AS boughtdate, owner_price_id AS owner_id, bare_price, fullprice, purchase_tax, commercial_insure,
        vehicle_tax, high_insure, card_fee, add_time
    FROM d_paid_a LEFT JOIN places ON boughtaddress = place_text
    WHERE add_time > DATE '2022-03-01' AND try_cast(model_price AS DOUBLE) <> 0 AND bare_price <> 0
      AND {_GAP} / bare_price <= 3 AND {_GAP} / try_cast(model_price AS DOUBLE) <= 2""")
def job_paid_prices_a(t):
    return side_data.paid_prices_a(place_catalog(t, src_paid_a="d_paid_a"), SIDE_RUN)


DERIVED["d_paid_b"] = f"""SELECT l_orderkey * 8 + l_linenumber AS id, lower(p_brand) AS brand_name, lower(p_type) AS series_name,
    CASE l_linenumber % 3 WHEN 0 THEN '2019款 豪华' WHEN 1 THEN '18款 舒适' ELSE '豪华' END AS model_name,
    CAST(CAST(l_shipdate AS DATE) + 8000 AS STRING) AS buy_time, {_PLACE_TEXT} AS city,
    CASE l_orderkey % 31 WHEN 0 THEN '面议' ELSE CAST(p_retailprice * 200 AS STRING) END AS guidance_price,
    CASE l_orderkey % 37 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE CAST(l_extendedprice * 3 AS STRING) END AS naked_price,
    CAST(l_shipdate AS DATE) + 8400 AS add_time
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


@query("job_paid_prices_b", f"""
    WITH {place_ctes('d_paid_b', 'city')},
    r AS (SELECT *, CAST(round(CAST(try_cast(guidance_price AS DOUBLE) AS DECIMAL(18, 4)) / 10000, 2) AS DOUBLE) AS mp,
                 CAST(round(CAST(try_cast(naked_price AS DOUBLE) AS DECIMAL(18, 4)) / 10000, 2) AS DOUBLE) AS bp FROM d_paid_b)
    SELECT id, upper(brand_name) AS brand_name, upper(series_name) AS series_name,
        coalesce({pick('model_name', V.MODEL_YEAR_LONG)}, regexp_extract(model_name, {duck(V.MODEL_YEAR_SHORT)}, 1)) AS model_year,
        model_name, mp AS model_price, province, place AS city, CAST(buy_time AS DATE) AS buy_time, bp AS bare_price, add_time
    FROM r JOIN places ON r.city = place_text JOIN city_province cp ON place = cp.city
    WHERE add_time > DATE '2022-03-20' AND mp <> 0 AND bp <> 0 AND abs(mp - bp) / bp <= 3 AND abs(mp - bp) / mp <= 2""")
def job_paid_prices_b(t):
    return side_data.paid_prices_b(place_catalog(t, src_paid_b="d_paid_b"), SIDE_RUN)


@query("job_paid_prices_b_unreadable", """
    SELECT reason, count(*) AS n FROM (SELECT CASE WHEN guidance_price IS NOT NULL AND try_cast(guidance_price AS DOUBLE) IS NULL
            THEN 'guidance_price is no number' WHEN naked_price IS NOT NULL AND try_cast(naked_price AS DOUBLE) IS NULL
            THEN 'naked_price is no number' END AS reason FROM d_paid_b) WHERE reason IS NOT NULL GROUP BY reason""")
def job_paid_prices_b_unreadable(t):
    found = side_data.unreadable_prices_b(place_catalog(t, src_paid_b="d_paid_b"))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- standard ids ----------------------------------------------------------

DERIVED["s_major"] = f"""SELECT p_partkey AS model_id, {_LETTER} AS Initial, {_BRAND} AS brandid, p_brand AS brand_name,
    {_GROUP} AS series_group_name, {_SERIES} AS series_id,
    CASE p_type WHEN 'ECONOMY' THEN 'x(进口)' WHEN 'LARGE' THEN 'x' ELSE lower(p_type) END AS series_name, {_NAME} AS model_name,
    p_name AS short_name, {_PRICE} AS model_price, {_YEAR} AS model_year, '手动' AS auto, '1.5' AS liter, '国五' AS discharge_standard,
    CASE p_size % 3 WHEN 0 THEN '2018' WHEN 1 THEN '2022' ELSE '-' END AS max_reg_year, '2015' AS min_reg_year,
    CASE p_size % 4 WHEN 0 THEN '中型车' WHEN 1 THEN 'SUV' ELSE 'MPV' END AS car_level, '5' AS seat_number, '' AS hl_configs, '' AS hl_configc,
    p_size % 2 AS is_green FROM part"""
DERIVED["s_brand"] = """SELECT DISTINCT brandid, Initial, brand_name, Initial || CAST(brandid + 2 AS STRING) AS std_brandid, '德国' AS car_country
    FROM s_major WHERE brandid <= 14"""
DERIVED["s_series"] = """SELECT DISTINCT m.series_id, series_group_name, series_name, std_brandid || 'S' || CAST(m.series_id AS STRING) AS std_seriesid,
    '0' AS is_import, CASE m.brandid % 3 WHEN 0 THEN '无' ELSE '中型车' END AS car_level, '1' AS is_green
    FROM s_major m JOIN s_brand b ON m.brandid = b.brandid WHERE m.series_group_name <> '国产'"""
DERIVED["s_model"] = """SELECT std_seriesid || 'M' || CAST(model_id AS STRING) AS std_modelid, model_id, auto, liter, m.is_green, 1 AS is_check
    FROM s_major m JOIN s_series s ON m.series_id = s.series_id WHERE model_price > 18.5"""


def standard_catalog(t) -> Catalog:
    cat = Catalog(t.spark)
    for name, table in {"standard_major": "s_major", "std_brand": "s_brand", "std_series": "s_series", "std_model": "s_model"}.items():
        cat.bind(name, lambda table=table: getattr(t, table))
    return cat


_TAIL = "CAST(regexp_extract({0}, '([0-9]+)$', 1) AS BIGINT)"


@query("job_allocate_brands", f"""
    WITH b AS (SELECT DISTINCT "Initial", brandid, brand_name FROM s_major),
    top AS (SELECT b."Initial", max({_TAIL.format('std_brandid')}) AS m FROM b JOIN s_brand s ON b.brandid = s.brandid GROUP BY ALL),
    n AS (SELECT * FROM b WHERE brandid NOT IN (SELECT brandid FROM s_brand))
    SELECT brandid, n."Initial", brand_name, n."Initial" || CAST(coalesce(m, 0)
        + dense_rank() OVER (PARTITION BY n."Initial" ORDER BY brand_name) AS VARCHAR) AS std_brandid, '无' AS car_country
    FROM n LEFT JOIN top ON n."Initial" = top."Initial" """)
def job_allocate_brands(t):
    return catalogue_ids.brand_rows(standard_catalog(t))


_STD_GROUP = duck_fold("CASE WHEN series_name LIKE '%进口%' THEN '进口' || series_group_name ELSE series_group_name END",
                       [(V.IMPORT_REPEATS, "进口")])


@query("job_allocate_series", f"""
    WITH b AS (SELECT DISTINCT m.brandid, series_id, series_group_name, series_name, std_brandid
               FROM s_major m JOIN s_brand s ON m.brandid = s.brandid),
    top AS (SELECT std_brandid, max({_TAIL.format('std_seriesid')}) AS m FROM b JOIN s_series s ON b.series_id = s.series_id GROUP BY ALL),
    n AS (SELECT series_id, std_brandid, {_STD_GROUP} AS g, upper({duck_fold('series_name', [(V.IMPORT_SUFFIX, '')])}) AS nm
          FROM b WHERE series_id NOT IN (SELECT series_id FROM s_series))
    SELECT series_id, g AS series_group_name, nm AS series_name, n.std_brandid || 'S' || CAST(coalesce(m, 0)
        + dense_rank() OVER (PARTITION BY n.std_brandid ORDER BY nm) AS VARCHAR) AS std_seriesid,
        CASE WHEN g LIKE '%进口%' THEN '1' ELSE '0' END AS is_import, '无' AS car_level, '无' AS is_green
    FROM n LEFT JOIN top ON n.std_brandid = top.std_brandid""")
def job_allocate_series(t):
    return catalogue_ids.series_rows(standard_catalog(t))


@query("job_series_levels", """
    WITH n AS (SELECT series_id, car_level, is_green, count(*) AS n FROM s_major a
               WHERE model_year = (SELECT max(model_year) FROM s_major b WHERE b.series_id = a.series_id) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY n DESC, car_level, is_green) AS rn FROM n)
    SELECT series_id, car_level, CAST(is_green AS VARCHAR) AS is_green FROM r
    WHERE rn = 1 AND series_id IN (SELECT series_id FROM s_series WHERE car_level = '无' OR is_green = '无')""")
def job_series_levels(t):
    return catalogue_ids.series_levels(standard_catalog(t))


@query("job_allocate_models", f"""
    WITH top AS (SELECT std_seriesid, max({_TAIL.format('std_modelid')}) AS m FROM s_model a JOIN s_major b ON a.model_id = b.model_id
                 JOIN s_series s ON b.series_id = s.series_id GROUP BY ALL),
    n AS (SELECT model_id, std_seriesid, auto, liter, m.is_green FROM s_major m JOIN s_series s ON m.series_id = s.series_id
          WHERE model_id NOT IN (SELECT model_id FROM s_model))
    SELECT n.std_seriesid || 'M' || CAST(coalesce(m, 0) + dense_rank() OVER (PARTITION BY n.std_seriesid ORDER BY model_id) AS VARCHAR) AS std_modelid,
        model_id, auto, liter, is_green, 0 AS is_check FROM n LEFT JOIN top ON n.std_seriesid = top.std_seriesid""")
def job_allocate_models(t):
    return catalogue_ids.model_rows(standard_catalog(t))


_WIDE_SQL = """SELECT a.std_modelid, a.model_id, b."Initial", b.brandid, c.std_brandid, c.brand_name, d.series_group_name, b.series_id,
        d.std_seriesid, d.series_name, b.model_name, b.short_name, b.model_price, b.model_year, a.auto, a.liter, b.discharge_standard,
        b.max_reg_year, b.min_reg_year, d.car_level, b.seat_number, b.hl_configs, b.hl_configc, a.is_green, d.is_import
    FROM s_model a JOIN s_major b ON a.model_id = b.model_id JOIN s_brand c ON b.brandid = c.brandid
    JOIN s_series d ON b.series_id = d.series_id WHERE d.car_level <> '无'"""


@query("job_standard_wide", _WIDE_SQL)
def job_standard_wide(t):
    return catalogue_ids.wide_rows(standard_catalog(t))


@query("job_reg_years", f"""
    WITH w AS (SELECT * REPLACE (CASE WHEN series_id % 2 = 0 THEN '2019' ELSE '2010' END AS max_reg_year) FROM ({_WIDE_SQL}))
    SELECT w.* REPLACE (CASE WHEN try_cast(b.max_reg_year AS INT) >= 2019 AND try_cast(w.max_reg_year AS INT) >= 2019
        THEN b.max_reg_year ELSE w.max_reg_year END AS max_reg_year) FROM w JOIN s_major b ON w.model_id = b.model_id""")
def job_reg_years(t):
    cat = standard_catalog(t)
    wide = catalogue_ids.wide_rows(cat).withColumn(
        "max_reg_year", F.when(F.col("series_id") % 2 == 0, "2019").otherwise("2010"))
    return planned(cat.overlay(catalogue_major=wide), [catalogue_ids.reg_year_update(cat)]).read("catalogue_major")


# --- platform match --------------------------------------------------------

# Platforms name their models by numbers of their own range; each has its share of spellings and of earlier matches.
for _i, _p in enumerate(V.MATCH_PLATFORMS):
    DERIVED[f"y_plat_{_p}"] = f"""SELECT car_id + {_i * 100_000_000} AS car_id, brand_name, CASE (car_id + {_i}) % 13 WHEN 0 THEN 'other' ELSE series_name END AS series_name,
        model_name, model_price, model_year, liter, car_auto, discharge_standard, {cases(f'(car_id + {_i})', ['1', '2', '3', '4', '5', '6', '7', '8', '9'])} AS series_id FROM x_plat"""
# a decided match, an undecided one (type 0), a discarded one (type 4) and none
_PAST = ", ".join(
    f"""CASE (p_partkey + {i}) % 6 WHEN 5 THEN NULL ELSE CAST(p_partkey + {500_001 + i * 100_000_000} AS STRING) END AS id_{p},
    CASE (p_partkey + {i}) % 6 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 5 THEN NULL ELSE 4 END AS match_type_{p}, 1 AS is_only_{p}"""
    for i, p in enumerate(V.MATCH_PLATFORMS))
DERIVED["y_history"] = f"SELECT CAST(p_partkey AS STRING) AS id_che300, {_PAST} FROM part"
DERIVED["s_wide"] = "SELECT p_partkey AS model_id, p_brand AS brand_name, p_type AS series_name FROM part"


def _match_sql(p: str) -> str:
    """One platform: the cascade over what history leaves open, then history first."""
    body = _rounds_sql("open_plat", "open_std")
    return f"""(WITH old AS (SELECT * FROM y_history WHERE match_type_{p} NOT IN (0, 4)),
      seen AS (SELECT series_id AS sid, min(struct_pack(b := m.brand_name, s := m.series_name)) AS v
        FROM y_plat_{p} p JOIN y_history h ON CAST(p.car_id AS VARCHAR) = h.id_{p} JOIN s_wide m ON h.id_che300 = CAST(m.model_id AS VARCHAR)
        GROUP BY series_id),
      open_plat AS (SELECT * REPLACE (CASE WHEN v IS NOT NULL THEN v.b ELSE brand_name END AS brand_name,
            CASE WHEN v IS NOT NULL THEN v.s ELSE series_name END AS series_name)
          FROM y_plat_{p} LEFT JOIN seen ON series_id = sid WHERE CAST(car_id AS VARCHAR) NOT IN (SELECT id_{p} FROM old WHERE id_{p} IS NOT NULL)),
      open_std AS (SELECT * FROM x_std WHERE CAST(car_id AS VARCHAR) NOT IN (SELECT id_che300 FROM old)),
      {body}, one AS (SELECT id, min(platform_id) AS platform_id FROM f GROUP BY id)
    SELECT CAST(car_id AS VARCHAR) AS id_std, coalesce(old.id_{p}, one.platform_id, '0') AS id_{p},
        coalesce(old.match_type_{p}, CASE WHEN one.id IS NOT NULL THEN 1 END, 0) AS match_type_{p},
        coalesce(old.is_only_{p}, CASE WHEN one.id IS NOT NULL THEN 1 END, 0) AS is_only_{p}
    FROM x_std LEFT JOIN old ON old.id_che300 = CAST(car_id AS VARCHAR) LEFT JOIN one ON one.id = CAST(car_id AS VARCHAR))"""


def match_catalog(t, platforms=V.MATCH_PLATFORMS) -> Catalog:
    cat = Catalog(t.spark)
    tables = {"match_standard": "x_std", "match_history": "y_history", "catalogue_major": "s_wide"}
    for name, table in (tables | {f"match_platform_{p}": f"y_plat_{p}" for p in platforms}).items():
        cat.bind(name, lambda table=table: getattr(t, table))
    return cat


@query("job_platform_match", "SELECT * FROM " + " JOIN ".join(
    f"{_match_sql(p)} m_{p}" + (" USING (id_std)" if n else "") for n, p in enumerate(V.MATCH_PLATFORMS)))
def job_platform_match(t):
    """All seven platforms in one run."""
    return platform_match.result_rows(match_catalog(t))


# --- jobs with their merges ------------------------------------------------

# Jobs whose rows are read back from the table they are merged into, and its key. (The driver's line items repeat ids, so the
# jobs fed from them would be refused by the merge.)
MERGED = {
    "job_ev_to_ods": ("model_id",), "job_detail_to_ods": ("autohome_id",), "job_series_to_ods": ("series_id",),
    "job_master_to_ods": ("model_id",), "job_owner_complaints": ("complain_id",), "job_reviews": ("id",),
}
_FAR = 100_000_000


def _merged(name: str, keys: tuple[str, ...]):
    """The job's rows merged into a table that holds older forms of half of them, and as many rows of other keys."""
    def run(spark, folder):
        rows = cut_lineage(QUERIES[name].run(spark, folder))
        other = rows.withColumn(keys[0], (F.col(keys[0]) + _FAR).cast(rows.schema[keys[0]].dataType))
        older = rows.where(F.pmod(F.xxhash64(*keys), F.lit(2)) == 0).withColumns({
            c: F.lit("older") for c, kind in rows.dtypes if kind == "string" and c not in keys})
        table = BucketTable.of(spark, f"{fresh_folder(spark)}/table", rows.schema, keys, buckets=8)
        table.load(older.unionByName(other))
        base.commit(Catalog(spark), [base.Change("t", rows, keys)], {"t": table})
        return table.read()

    own = QUERIES[name].sql
    return Query(run, f"SELECT * FROM ({own}) UNION ALL SELECT * REPLACE ({keys[0]} + {_FAR} AS {keys[0]}) FROM ({own})")


QUERIES.update({f"{name}_merged": _merged(name, keys) for name, keys in MERGED.items()})
