"""Cleaning rules on text spread over all orders (or parts), each against the same rule in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.functions import geo, listing, text, vehicle
from listingflow.queries.base import DERIVED, cases, duck, duck_fold, query

KEY = "o_orderkey"


def spread(**columns: list[str | None]) -> str:
    """Orders with text columns; later columns advance once per full turn of the earlier ones."""
    parts, step = [], 1
    for name, values in columns.items():
        number = KEY if step == 1 else f"CAST(floor({KEY} / {step}) AS BIGINT)"
        parts.append(f"{cases(number, values)} AS {name}")
        step *= len(values)
    return f"SELECT {KEY}, {', '.join(parts)} FROM orders"


def rule(name: str, source: str, sql: str, make: Callable[[], dict[str, Column]]) -> None:
    """Register a column rule: ``sql`` are DuckDB output columns over the source."""
    @query(name, f"WITH src AS ({source}) SELECT {KEY}, {sql} FROM src")
    def run(t) -> DataFrame:
        return t.sql(source).select(KEY, *[c.alias(n) for n, c in make().items()])


def pick(expr: str, pattern: str, group: int = 1) -> str:
    """DuckDB: first match or NULL."""
    return f"nullif(regexp_extract({expr}, {duck(pattern)}, {group}), '')"


# --- gearbox, drive --------------------------------------------------------

_GEARS = ["6挡手自一体", "7挡双离合", "CVT无级变速(模拟8挡)", "5挡手动", "电动车单速变速箱", "2.0L MT豪华", "6AT",
          "AMT智能手动", "自动DSG", None, "Manual 5", "8 AT 豪华", "2.0AT", "5MT", "双离合手自动一体", "tiptronic", "G-DCT",
          "MT-5", "1.6-CVT", "xMTy", "自动 CVT 型"]


def gearbox_sql(expr: str) -> str:
    """The gearbox rules without look-around: neighbours are captured and put back."""
    r = V.GEARBOX_RULES
    out = duck_fold(expr, r[:5])
    out = f"regexp_replace({out}, 'AT([^a-zA-Z0-9]|$)', '自动\\1', 'g')"
    out = duck_fold(out, [r[6], (r"[0-9]MT", "手动")])
    out = f"regexp_replace({out}, '(^|[^a-zA-Z])MT([^a-zA-Z]|$)', '\\1手动\\2', 'g')"
    out = duck_fold(out, [(r"MT[-\s]", "手动"), r[8]])
    hit = f"regexp_extract({out}, '({V.GEARBOX_KINDS})', 1)"
    return f"CASE WHEN {hit} = '' THEN '-' ELSE {hit} END"


rule("rule_gearbox", spread(raw=_GEARS), f"{gearbox_sql('raw')} AS gearbox",
     lambda: {"gearbox": vehicle.gearbox(F.col("raw"))})

_NAMES = ["2020款 1.5L 手动舒适型", "2019款 2.0T 自动豪华", "电动 标准版", None]
rule("rule_gearbox_catalogue", spread(raw=["5挡手动", "-", None], name=_NAMES),
     f"CASE WHEN {KEY} % 5 = 1 THEN '电动' ELSE {gearbox_sql('(name || raw)')} END AS gearbox",
     lambda: {"gearbox": vehicle.catalogue_gearbox(F.col("name"), F.col("raw"), F.col(KEY) % 5)})

rule("rule_gearbox_match", spread(raw=["CVT无级变速", "双离合", "手自一体", "Auto 6", "manual", "自动", None]),
     f"{duck_fold('coalesce(raw, ' + duck('') + ')', V.GEARBOX_MATCH_RULES)} AS gearbox",
     lambda: {"gearbox": vehicle.gearbox_for_match(F.col("raw"))})

rule("rule_drive", spread(raw=["前置四驱", "AWD", "4X4", "两驱 FWD", "2WD", "后驱", None]),
     f"{duck_fold('raw', V.DRIVE_RULES)} AS drive", lambda: {"drive": vehicle.drive(F.col("raw"))})

# --- emission standard -----------------------------------------------------

_STANDARDS = ["国VI", "国V", "国IV", "国III", "国4+OBD", "国4带OBD", "欧4(国3)", "-", None, "化油器 国2", "京5", "国Ⅴ", "国1"]
_EMISSION_SQL = duck_fold(
    f"CASE WHEN regexp_matches(raw, {duck(V.EMISSION_MARK)}) THEN raw ELSE {pick('name', V.EMISSION_IN_NAME)} END",
    V.EMISSION_RULES)
rule("rule_emission", spread(raw=_STANDARDS, name=["某车 国IV 豪华", "某车 豪华", "京V 型", None, "国三型 1.6"]),
     f"{_EMISSION_SQL} AS standard",
     lambda: {"standard": vehicle.emission_standard(F.col("name"), F.col("raw"))})
rule("rule_emission_cn", spread(raw=["国VI(国V)", "未知", "国4+OBD", "国Ⅲ", "国II", None, "欧V"]),
     f"{duck_fold('raw', V.EMISSION_PRODUCTION_RULES)} AS standard",
     lambda: {"standard": vehicle.emission_standard_production(F.col("raw"))})
rule("rule_emission_match", spread(raw=["国四+OBD", "国四OBD", "国五", None]),
     f"{duck_fold('coalesce(raw, ' + duck('') + ')', [(V.EMISSION_MATCH_NOISE, '')])} AS standard",
     lambda: {"standard": vehicle.emission_for_match(F.col("raw"))})

# --- displacement, years, status -------------------------------------------

_LITERS = ["1.8L", "1998mL", "-", None, "2.0T", "12.05"]
rule("rule_displacement", spread(raw=_LITERS, name=["2.0T 豪华", "某车 1.5T", "某车", None]),
     f"coalesce({pick('raw', V.DISPLACEMENT)}, {pick('name', V.DISPLACEMENT)}) AS liter, "
     f"CASE WHEN {KEY} % 4 = 1 THEN '-' ELSE coalesce({pick('raw', V.DISPLACEMENT)}, {pick('name', V.DISPLACEMENT)}) END AS catalogue, "
     f"coalesce(regexp_extract(raw, {duck(V.DISPLACEMENT_MATCH)}, 1), '') AS matching",
     lambda: {"liter": vehicle.displacement(F.col("name"), F.col("raw")),
              "catalogue": vehicle.catalogue_displacement(F.col("name"), F.col("raw"), F.col(KEY) % 4),
              "matching": vehicle.displacement_for_match(F.col("raw"))})
rule("rule_first_token", spread(raw=["1.5T 150马力", "2.0L", "", None, " x"]),
     "split_part(raw, ' ', 1) AS token", lambda: {"token": vehicle.first_token(F.col("raw"))})
rule("rule_model_year", spread(raw=["2020款 舒适", "19款", "0", "其它", "2018其他", None, "12019款"]),
     f"CASE WHEN {duck_fold('raw', [(V.MODEL_YEAR_NOISE, '')])} = '0' THEN '' ELSE {duck_fold('raw', [(V.MODEL_YEAR_NOISE, '')])} END AS cleaned, "
     f"coalesce({pick('raw', V.MODEL_YEAR_LONG)}, regexp_extract(raw, {duck(V.MODEL_YEAR_SHORT)}, 1)) AS named",
     lambda: {"cleaned": vehicle.model_year(F.col("raw")), "named": vehicle.model_year_from_name(F.col("raw"))})
rule("rule_power_code", spread(fuel=["纯电动", "油电混合", "插电式混合动力", "增程式", "汽油", None, "3"]),
     f"CASE WHEN fuel LIKE '%纯电%' THEN 1 WHEN fuel LIKE '%油电%' THEN 2 WHEN fuel LIKE '%插电%' THEN 3 "
     f"WHEN fuel LIKE '%增程%' THEN 4 WHEN fuel = '3' THEN 3 ELSE CAST({KEY} % 4 = 0 AS INTEGER) END AS code",
     lambda: {"code": vehicle.power_code(F.col("fuel"), F.col(KEY) % 4 == 0)})
rule("rule_status", spread(raw=["停产在售", "已停售", "即将销售", "未知", None]),
     f"coalesce({pick('raw', V.SALE_STATUS)}, raw) AS status", lambda: {"status": vehicle.sale_status(F.col("raw"))})
rule("rule_car_level", spread(raw=["紧凑型SUV", "中大型车", "MPV", "豪华跑车", "-", None, "微面"]),
     f"coalesce({pick('raw', '(' + V.CAR_LEVELS + ')')}, '无') AS level",
     lambda: {"level": vehicle.car_level(F.col("raw"))})
rule("rule_type_name", spread(series=["X5 ", None, "e级"], model=["2020款  豪华   型", "舒适 ", None]),
     "trim(regexp_replace(trim(concat_ws(' ', series, model)), ' +', ' ', 'g')) AS type_name",
     lambda: {"type_name": text.join_words(F.col("series"), F.col("model"))})

_SERIES = spread(series_name=["X5(进口)", "e级(停售)", "欧尚COSMOS(科尚)", "q3", None],
                 series_group_name=["宝马", "进口宝马", "北京奔驰", "进口进口宝马"])
_GROUP_SQL = (f"regexp_replace(CASE WHEN series_name LIKE '%进口%' THEN '进口' || series_group_name ELSE series_group_name END, "
              f"{duck(V.IMPORT_REPEATS)}, '进口', 'g')")


@query("rule_import_naming", f"""
    WITH src AS ({_SERIES})
    SELECT {KEY}, {_GROUP_SQL} AS series_group_name,
        upper({duck_fold('series_name', [(V.IMPORT_OR_STOPPED_SUFFIX, '')])}) AS series_name,
        CAST({_GROUP_SQL} LIKE '%进口%' AS INTEGER) AS is_import FROM src""")
def rule_import_naming(t):
    return vehicle.import_naming(t.sql(_SERIES))


@query("rule_import_naming_standard", f"""
    WITH src AS ({_SERIES})
    SELECT {KEY}, {_GROUP_SQL} AS series_group_name,
        upper(replace({duck_fold('series_name', [(V.IMPORT_SUFFIX, '')])}, '欧尚COSMOS(科尚)', '欧尚COSMOS-科尚')) AS series_name,
        CASE WHEN {_GROUP_SQL} LIKE '%进口%' THEN '1' ELSE '0' END AS is_import FROM src""")
def rule_import_naming_standard(t):
    return vehicle.import_naming(t.sql(_SERIES), standard=True)


# --- electric drive --------------------------------------------------------

_EV = spread(
    ee_type=["永磁/同步", "前异步/后永磁", None], ee_fast_charging_time=["标配", "0.5", "待查"],
    ee_battery_type=["三元锂电池", "铅酸", "磷酸铁锂", None], ee_pure_electric_range=["510km", "标配", "300公里"],
    ee_battery_quality_assurance=["八年或12万公里", "十五年", "待查", None], ee_fast_charge=["80", "-", "", None],
)


@query("rule_ev_block", f"""
    WITH src AS ({_EV})
    SELECT {KEY}, {duck_fold('ee_type', V.EV_TYPE_RULES)} AS ee_type,
        {duck_fold('ee_fast_charging_time', V.EV_CHARGING_TIME_RULES)} AS ee_fast_charging_time,
        coalesce({pick('ee_battery_type', V.EV_BATTERY_KINDS)} || '电池', '-') AS ee_battery_type,
        {duck_fold('ee_pure_electric_range', V.EV_RANGE_RULES)} AS ee_pure_electric_range,
        {duck_fold('ee_battery_quality_assurance', V.EV_WARRANTY_RULES)} AS ee_battery_quality_assurance,
        CASE WHEN ee_fast_charge <> '-' THEN ee_fast_charge || '%' ELSE ee_fast_charge END AS ee_fast_charge
    FROM src""")
def rule_ev_block(t):
    return vehicle.ev_block(t.sql(_EV))


@query("rule_ev_export", f"""
    WITH src AS ({_EV})
    SELECT {KEY}, coalesce(nullif(ee_type, ''), '-') AS ee_type,
        coalesce(nullif(regexp_replace('%' || ee_fast_charge, '^%', '-'), ''), '-') AS "ee_fast_charge(%)" FROM src""")
def rule_ev_export(t):
    src = t.sql(_EV).select(KEY, "ee_type", F.concat(F.lit("%"), F.col("ee_fast_charge")).alias(V.EV_FAST_CHARGE_PRODUCTION))
    return vehicle.ev_export(src, KEY)


@query("rule_blank_dash", f"""
    WITH src AS ({_EV})
    SELECT {KEY}, coalesce(nullif(ee_type, ''), '-') AS ee_type, coalesce(nullif(ee_fast_charge, ''), '-') AS ee_fast_charge,
           ee_battery_type FROM src""")
def rule_blank_dash(t):
    src = t.sql(_EV).select(KEY, "ee_type", "ee_fast_charge", "ee_battery_type")
    return text.blank_to_dash(src, {KEY, "ee_battery_type"})


# --- equipment -------------------------------------------------------------

_PAIRS = spread(master_air_bag=["主标配\\/副标配", "主标配?\\/副标配", "主标配/副标配", None],
                sub_air_bag=["主标配\\/副标配", "主标配\\/\\副标配", "主标配/副标配"])


@query("rule_pairs", f"""
    WITH src AS ({_PAIRS})
    SELECT {KEY}, regexp_replace(master_air_bag, {duck(chr(92) + '?' + V.PAIR_SEPARATOR + '.*|' + V.PAIR_SEPARATOR + '.*')}, '', 'g') AS master_air_bag,
        regexp_replace(sub_air_bag, {duck('.*' + V.PAIR_SEPARATOR + chr(92) * 2 + '?|.*' + V.PAIR_SEPARATOR)}, '', 'g') AS sub_air_bag
    FROM src""")
def rule_pairs(t):
    return vehicle.split_pairs(t.sql(_PAIRS))


_FLAGS = spread(abs=["标配", "选配", "-", "无", None], cruise=["前标配", "主标配/副标配", "前-", "后无/前选配"], gps=["双", "副选配"])


@query("rule_flags", f"""
    WITH src AS ({_FLAGS})
    SELECT {KEY}, {', '.join(f'{duck_fold(c, V.EQUIPMENT_RULES)} AS {c}' for c in ('abs', 'cruise', 'gps'))} FROM src""")
def rule_flags(t):
    return vehicle.equipment_flags(t.sql(_FLAGS))


# --- listings --------------------------------------------------------------

rule("rule_noise", spread(raw=["武汉(市区)", "长沙（河西）市", "北京市", None, "上海"]),
     f"{duck_fold('raw', [(V.BRACKET_NOISE, '')])} AS plain, {duck_fold('raw', [(V.CITY_SUFFIX, '')])} AS city",
     lambda: {"plain": listing.strip_brackets(F.col("raw")), "city": listing.strip_city_suffix(F.col("raw"))})
rule("rule_color", spread(raw=["深灰色", "其他", "无数据", "象牙白", "冰川蓝", "香槟-色", "――", "白3", None]),
     f"{duck_fold('coalesce(raw, ' + duck('') + ')', V.LISTING_COLOR_RULES)} AS color",
     lambda: {"color": listing.color(F.col("raw"))})
rule("rule_color_catalogue", spread(raw=["红;白;;", "无", "黑;", None, "银;无;"]),
     f"{duck_fold('raw', V.CATALOGUE_COLOR_RULES)} AS color", lambda: {"color": vehicle.catalogue_color(F.col("raw"))})
rule("rule_fee", spread(raw=["不含过户费", "含过户费", "面议", None, ""]),
     "CASE WHEN raw LIKE '%不含%' THEN '0' WHEN raw LIKE '%含%' THEN '1' ELSE coalesce(raw, '') END AS fee",
     lambda: {"fee": listing.transfer_fee(F.col("raw"))})

_DEFAULTS = spread(transfer=["暂无数据", "3次", None, "NA"], annual=["NA", "1", None], insure=["0", None])


@query("rule_listing_defaults", f"""
    WITH src AS ({_DEFAULTS})
    SELECT {KEY}, regexp_replace(coalesce(transfer, ''), {duck(V.TRANSFER_NOISE)}, '', 'g') AS transfer,
        regexp_replace(coalesce(annual, ''), 'NA', '', 'g') AS annual, regexp_replace(coalesce(insure, ''), 'NA', '', 'g') AS insure
    FROM src""")
def rule_listing_defaults(t):
    return listing.text_defaults(t.sql(_DEFAULTS))


# --- places ----------------------------------------------------------------
# Places are nations (as cities) and suppliers (as counties) inside regions (as provinces).

DERIVED["v_district"] = """SELECT r_name AS key_province, n_name AS key_municipal, s_name AS key_county,
    lpad(CAST(r_regionkey + 10 AS STRING), 2, '0') || lpad(CAST(n_nationkey AS STRING), 2, '0') || '00' AS city_code
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
DERIVED["v_region"] = """SELECT r_name AS province, CASE WHEN r_regionkey < 2 THEN 'west' ELSE 'east' END AS regional FROM region"""
DERIVED["v_place"] = """SELECT o_orderkey,
    CASE o_orderkey % 7 WHEN 0 THEN 'NATION_' || CAST(o_custkey % 30 AS STRING) || '市'
        WHEN 1 THEN '襄樊' WHEN 2 THEN NULL WHEN 3 THEN 'near Supplier#' || lpad(CAST(o_custkey AS STRING), 9, '0')
        WHEN 4 THEN 'ASIA NATION_' || CAST(o_custkey % 30 AS STRING) || ' NATION_1' ELSE 'nowhere' END AS location,
    CASE o_orderkey % 5 WHEN 0 THEN 'NATION_' || CAST(o_custkey % 26 AS STRING) || ' road'
        WHEN 1 THEN 'Supplier#' || lpad(CAST(o_custkey % 100 AS STRING), 9, '0') WHEN 2 THEN 'EUROPE' ELSE NULL END AS address
    FROM orders"""


def leftmost(text_col: str, words: str, out: str, table: str = "v_place") -> str:
    """DuckDB: leftmost, then longest word of a one-column table ``words`` in a text, per distinct text."""
    return f"""SELECT {text_col} AS txt, arg_min(w, (strpos({text_col}, w), -length(w))) AS {out}
        FROM (SELECT DISTINCT {text_col} FROM {table}) x, {words} WHERE strpos({text_col}, w) > 0 GROUP BY {text_col}"""


_PLACE_SQL = f"""
    WITH cities AS (SELECT DISTINCT key_municipal AS w FROM v_district),
         counties AS (SELECT DISTINCT key_county AS w FROM v_district),
         county_city AS (SELECT key_county, min(key_municipal) AS city FROM v_district GROUP BY key_county),
         provinces AS (SELECT DISTINCT key_province AS w FROM v_district),
         lc AS ({leftmost('location', 'cities', 'hit')}), lk AS ({leftmost('location', 'counties', 'hit')}),
         lp AS ({leftmost('location', 'provinces', 'hit')}),
         ac AS ({leftmost('address', 'cities', 'hit')}), ak AS ({leftmost('address', 'counties', 'hit')})"""


def _places(t) -> geo.Gazetteer:
    return geo.Gazetteer.load(geo.county_dim(t.v_district, t.v_region))


@query("geo_city", f"""{_PLACE_SQL}
    SELECT o_orderkey, coalesce(lc.hit, county_city.city) AS location FROM v_place
    LEFT JOIN lc ON location = lc.txt LEFT JOIN lk ON location = lk.txt LEFT JOIN county_city ON lk.hit = key_county""")
def geo_city(t):
    return geo.standardise_city(t.v_place.drop("address"), "location", _places(t))


@query("geo_province", f"""{_PLACE_SQL}
    SELECT o_orderkey, location, lp.hit AS province FROM v_place LEFT JOIN lp ON location = lp.txt""")
def geo_province(t):
    return _places(t).add_first(t.v_place.drop("address"), "location", "province", "province")


@query("geo_listing", f"""{_PLACE_SQL}
    SELECT o_orderkey, coalesce(lc.hit, ac.hit) AS location, address FROM v_place
    LEFT JOIN lc ON location = lc.txt LEFT JOIN ac ON address = ac.txt""")
def geo_listing(t):
    return geo.standardise_listing_location(t.v_place, _places(t))


@query("geo_listing_county", f"""{_PLACE_SQL}
    SELECT o_orderkey, coalesce(lc.hit, ac.hit, county_city.city, '') AS location, address FROM v_place
    LEFT JOIN lc ON location = lc.txt LEFT JOIN ac ON address = ac.txt
    LEFT JOIN ak ON address = ak.txt LEFT JOIN county_city ON ak.hit = key_county""")
def geo_listing_county(t):
    return geo.standardise_listing_location(t.v_place, _places(t), county_fallback=True)


@query("geo_city_by_join", f"""{_PLACE_SQL}
    SELECT o_orderkey, coalesce(lc.hit, county_city.city) AS location FROM v_place
    LEFT JOIN lc ON location = lc.txt LEFT JOIN lk ON location = lk.txt LEFT JOIN county_city ON lk.hit = key_county""")
def geo_city_by_join(t):
    # a size limit of zero sends every dictionary down the join path
    places = geo.Gazetteer.load(geo.county_dim(t.v_district, t.v_region), limit=0)
    return geo.standardise_city(t.v_place.drop("address"), "location", places)


