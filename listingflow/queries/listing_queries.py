"""The seven listing jobs: line items are crawled listings, parts their models, nations their cities."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow import schemas as S
from listingflow.operators.snapshots import SnapshotTable
from listingflow.plans import listings
from listingflow.queries.base import DERIVED, cases, duck, duck_fold, query
from listingflow.queries.merge_queries import fresh_folder
from listingflow.queries.rule_queries import leftmost
from listingflow.session import cut_lineage
from listingflow.sources.catalog import Catalog

RUN = "2025-01-01"

_CITY = """CASE l_linenumber % 4 WHEN 0 THEN 'NATION_' || CAST(l_suppkey % 27 AS STRING) || '(西区)' WHEN 1 THEN 'NATION_' || CAST(l_suppkey % 25 AS STRING)
    WHEN 2 THEN '杨凌' ELSE NULL END"""
_ADDRESS = """CASE l_linenumber % 3 WHEN 0 THEN 'Supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0') WHEN 1 THEN 'NATION_' || CAST(l_suppkey % 26 AS STRING) ELSE 'x' END"""
_REG = """CASE l_orderkey % 19 WHEN 0 THEN 'bad' WHEN 1 THEN '' WHEN 2 THEN NULL
    ELSE CAST(CAST(l_shipdate AS DATE) + 8400 - CAST(l_quantity * 60 AS INT) AS STRING) END"""
_EXPIRES = """CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'bad' ELSE CAST(CAST(l_shipdate AS DATE) + 8300 + l_linenumber * 40 AS STRING) END"""
_ADD, _UPDATE = "CAST(l_shipdate AS DATE) + 8390", "CASE l_orderkey % 7 WHEN 0 THEN NULL ELSE CAST(l_shipdate AS DATE) + 8400 END"
_COLOR = cases("l_orderkey", ["深灰色", "其他", "无数据", "象牙白", None, "香槟-色"])
_FEE = cases("l_orderkey", ["不含过户费", "含过户费", "面议", None])
_TRANSFER = cases("l_orderkey", ["暂无数据", "3次", None, "NA"])

DERIVED["l_market"] = f"""SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS car_id, l_partkey AS model_id, l_extendedprice / 3000 AS price,
    l_extendedprice / 3000 AS deal_price, {_CITY} AS location, {_ADDRESS} AS place, {_TRANSFER} AS transfer_number, {_COLOR} AS body_color,
    l_quantity / 8 AS mile, {_FEE} AS is_transfer_fee, {_EXPIRES} AS inspect_date, {_EXPIRES} AS insure_date, {_REG} AS reg_date,
    CASE l_orderkey % 3 WHEN 0 THEN NULL ELSE CAST(l_shipdate AS DATE) + 8395 END AS deal_date, {_ADD} AS add_time, {_UPDATE} AS update_time
    FROM lineitem"""
DERIVED["l_scaled"] = f"""SELECT l_orderkey AS car_id, l_partkey AS model_id, l_extendedprice * 10 / 3 AS quotes, {_ADDRESS} AS location, {_CITY} AS address,
    {_TRANSFER} AS transfer, {_COLOR} AS color, l_quantity * 1250 AS mile, '1' AS state, {_FEE} AS trans_fee, {_EXPIRES} AS annual,
    {_EXPIRES} AS insure, {_REG} AS regDate, {_ADD} AS add_time, {_UPDATE} AS update_time FROM lineitem"""
_STD = "p_brand || 'M' || CAST(p_partkey AS STRING)"
# model mappings; models of size 50 map to a second standard model and must drop out
DERIVED["l_xlat_model"] = f"""SELECT {_STD} AS std_modelid, p_partkey AS platform_id, CAST('2024-01-01' AS DATE) AS update_time FROM part
    UNION ALL SELECT 'x' || {_STD}, p_partkey, CAST('2024-01-01' AS DATE) FROM part WHERE p_size = 50"""
# listing mappings, some of them older than the last run
DERIVED["l_xlat_id"] = f"""SELECT {_STD} AS std_modelid, l_orderkey * 8 + l_linenumber AS platform_id,
    CAST(l_shipdate AS DATE) + 8400 AS update_time FROM lineitem JOIN part ON l_partkey = p_partkey"""
DERIVED["l_xlat_car"] = f"""SELECT {_STD} AS std_modelid, o_orderkey AS platform_id, CAST(o_orderdate AS DATE) + 8400 AS update_time
    FROM orders JOIN part ON o_custkey = p_partkey"""
DERIVED["l_xlat_std"] = f"""SELECT {_STD} AS std_modelid, p_partkey + 700000 AS che300_model_id FROM part
    UNION ALL SELECT 'x' || {_STD}, p_partkey + 700000 FROM part WHERE p_size = 50"""
DERIVED["l_major"] = f"""SELECT p_partkey + 700000 AS model_id, 'B' || p_brand AS std_brandid, 'S' || p_brand AS std_seriesid, p_brand AS brand_name,
    p_type AS series_name, p_name AS model_name, p_retailprice / 50 AS model_price, CAST(2014 + p_size % 8 AS STRING) AS model_year, '自动' AS auto,
    '1.5' AS liter, '国五' AS discharge_standard, '中型车' AS car_level, CAST(p_size % 3 AS STRING) AS is_green, '0' AS is_import FROM part"""
DERIVED["l_country"] = """SELECT 'B' || p_brand AS std_brandid, CASE WHEN p_brand < 'Brand#2' THEN '德国' ELSE '日本' END AS car_country
    FROM part WHERE p_brand <> 'Brand#7'"""
# the wide table before the run: its latest processing day is the mark of each platform
DERIVED["l_wide"] = """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'guazi' WHEN '2-HIGH' THEN 'che58' WHEN '3-MEDIUM' THEN 'rrc' ELSE 'yiche' END AS car_platform,
    o_orderkey * 8 + 1 AS id_data_input, CAST(o_orderdate AS DATE) + 7600 AS date_add FROM orders"""

_XLAT = {name: "l_xlat_model" if spec.mid_column else "l_xlat_id" for name, spec in listings.PLATFORMS.items()}
_XLAT["ttp"] = "l_xlat_car"


def listing_catalog(t) -> Catalog:
    cat = Catalog(t.spark)
    bound = {"listing_wide": "l_wide", "xlat_standard": "l_xlat_std", "catalogue_major": "l_major", "brand_country": "l_country",
             "dim_district": "v_district", "dim_region": "v_region"}
    for name in listings.PLATFORMS:
        bound[f"listing_{name}"] = "l_scaled" if name == "che168" else "l_market"
        bound[f"xlat_{name}"] = _XLAT[name]
    for name, table in bound.items():
        cat.bind(name, lambda table=table: getattr(t, table))
    return cat


def _mark(name: str) -> str:
    return f"coalesce((SELECT max(date_add) FROM l_wide WHERE car_platform = '{name}'), DATE '2000-01-01')"


def listing_sql(name: str) -> str:
    """The job of one platform, stage by stage."""
    spec = listings.PLATFORMS[name]
    scaled = name == "che168"
    if scaled:
        raw = """car_id AS id_data_input, model_id AS platform_key, quotes / 10000 AS quotes, address AS location, location AS address, transfer,
            color, mile / 10000 AS mile, state, trans_fee, annual, insure, "regDate", add_time, update_time"""
    else:
        dates = "inspect_date AS annual, insure_date AS insure" if spec.expiry else "'' AS annual, '' AS insure"
        fee = "''" if name == "ttp" else "is_transfer_fee"
        state = "'1'" if name in ("che58", "ttp") else "'0'"
        price = "deal_price" if name == "ttp" else "price"
        raw = f"""{spec.id_column} AS id_data_input, {spec.mid_column or spec.id_column} AS platform_key, {price} AS quotes, location, place AS address,
            transfer_number AS transfer, body_color AS color, mile, {state} AS state, {fee} AS trans_fee, {dates}, reg_date AS "regDate",
            {'deal_date, ' if name == 'ttp' else ''}add_time, update_time"""
    since = f"WHERE update_time > {_mark(name)}" if spec.mid_column else ""
    mapped_since = "" if spec.mid_column else f"WHERE update_time > {_mark(name)}"
    order = ["add_time", "address", "annual", "color", "deal_date", "insure", "location", "mile", "platform_key", "quotes", "regDate",
             "state", "trans_fee", "transfer"]
    # ties of the same day go to the smallest row in the listing layout's column order
    tie = ", ".join(f'"{c}" ASC NULLS LAST' for c in [*spec.columns, "platform_key"] if c in order)
    added = "coalesce(deal_date, add_time, update_time)" if name == "ttp" else "coalesce(update_time, add_time)"
    location = duck_fold("location", [(V.BRACKET_NOISE, "")]) if spec.strip_brackets else "location"
    for old, new in V.CITY_ALIASES:
        location = f"replace({location}, '{old}', '{new}')"
    fee = ("CASE WHEN trans_fee LIKE '%不含%' THEN '0' WHEN trans_fee LIKE '%含%' THEN '1' ELSE coalesce(trans_fee, '') END"
           if spec.fee_text else "trans_fee")

    def expiry(c: str) -> str:
        if c not in spec.expiry:
            return c
        return (f"CASE WHEN try_cast({c} AS DATE) IS NULL THEN '' WHEN date_diff('day', try_cast({c} AS DATE), {added}) > 0 "
                f"THEN '1' ELSE '0' END")

    place = "coalesce(lc.hit, ac.hit, county_city.city, '')" if spec.county_fallback else "coalesce(lc.hit, ac.hit)"
    clean = lambda c: f"regexp_replace(coalesce({c}, ''), 'NA', '', 'g')"
    color = duck_fold("coalesce(color, '')", V.LISTING_COLOR_RULES)
    return f"""WITH raw AS (SELECT {raw} FROM {'l_scaled' if scaled else 'l_market'} {since}),
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_data_input ORDER BY update_time DESC NULLS LAST, {tie}) AS rn FROM raw)
        WHERE rn = 1),
    dated AS (SELECT * REPLACE ({location} AS location, {fee} AS trans_fee, {expiry('annual')} AS annual, {expiry('insure')} AS insure,
        {added} AS add_time) FROM latest),
    cities AS (SELECT DISTINCT key_municipal AS w FROM v_district), counties AS (SELECT DISTINCT key_county AS w FROM v_district),
    county_city AS (SELECT key_county, min(key_municipal) AS city FROM v_district GROUP BY key_county),
    lc AS ({leftmost('location', 'cities', 'hit', 'dated')}), ac AS ({leftmost('address', 'cities', 'hit', 'dated')}),
    ak AS ({leftmost('address', 'counties', 'hit', 'dated')}),
    placed AS (SELECT d.* REPLACE ({place} AS location) FROM dated d LEFT JOIN lc ON d.location = lc.txt LEFT JOIN ac ON address = ac.txt
        LEFT JOIN ak ON address = ak.txt LEFT JOIN county_city ON ak.hit = key_county),
    pairs AS (SELECT x.std_modelid, platform_id, che300_model_id FROM (SELECT * FROM {_XLAT[name]} {mapped_since}) x
        JOIN l_xlat_std s ON x.std_modelid = s.std_modelid),
    models AS (SELECT * FROM pairs WHERE platform_id IN (SELECT platform_id FROM pairs GROUP BY platform_id HAVING count(*) = 1)),
    district AS (SELECT key_municipal AS city, arg_min(key_province, (regional, key_province)) AS province
        FROM v_district JOIN v_region ON key_province = province GROUP BY key_municipal),
    joined AS (SELECT p.*, m.std_modelid, m.che300_model_id, j.* EXCLUDE (model_id), province, car_country,
            CAST(round(CAST(quotes AS DECIMAL(18, 8)), 2) AS DOUBLE) AS q, CAST(round(CAST(mile AS DECIMAL(18, 8)), 2) AS DOUBLE) AS mi,
            date_trunc('month', try_cast("regDate" AS DATE))::DATE AS reg
        FROM placed p JOIN models m ON platform_key = platform_id JOIN l_major j ON j.model_id = che300_model_id
        JOIN district ON p.location = city JOIN (SELECT DISTINCT * FROM l_country) k ON j.std_brandid = k.std_brandid),
    aged AS (SELECT *, round(date_diff('day', reg, add_time) / 365, 2) AS years FROM joined)
    SELECT '{name}' AS car_platform, id_data_input, che300_model_id AS id_che300, std_modelid, model_year, std_brandid, std_seriesid, is_import,
        is_green, brand_name AS brand, series_name AS series, model_name, {color} AS color, liter, auto, discharge_standard, car_level, location,
        strftime(reg, '%Y-%m') AS "regDate", q AS quotes, model_price, mi AS mile, {clean('state')} AS state, {clean('trans_fee')} AS trans_fee,
        regexp_replace(coalesce(transfer, ''), {duck(V.TRANSFER_NOISE)}, '', 'g') AS transfer, {clean('annual')} AS annual, {clean('insure')} AS insure,
        add_time, update_time, province, car_country, years AS user_years, strftime(add_time, '%Y%m') AS partition_month, DATE '{RUN}' AS date_add
    FROM aged WHERE q / model_price > 0.05 AND q / model_price < 1.5 AND (years < 1 OR q / model_price < 1)
      AND reg > DATE '2000-01-01' AND reg < DATE '{RUN}'"""


for _name in listings.PLATFORMS:
    @query(f"job_listing_{_name}", listing_sql(_name))
    def _listing(t, name=_name):
        return listings.wide_rows(listing_catalog(t), name, RUN)


@query("job_listing_superseded", f"""
    WITH pairs AS (SELECT platform_id FROM l_xlat_id x JOIN l_xlat_std s ON x.std_modelid = s.std_modelid WHERE update_time > {_mark('che58')}),
    mapped AS (SELECT platform_id FROM pairs GROUP BY platform_id HAVING count(*) = 1),
    cars AS (SELECT car_id FROM l_market WHERE id IN (SELECT platform_id FROM mapped)),
    dup AS (SELECT car_id FROM l_market WHERE car_id IN (SELECT car_id FROM cars) GROUP BY car_id HAVING count(*) > 1)
    SELECT DISTINCT id FROM l_market WHERE car_id IN (SELECT car_id FROM dup) AND id NOT IN (SELECT platform_id FROM mapped)""")
def job_listing_superseded(t):
    return listings.superseded(listing_catalog(t), "che58")


@query("job_listing_mapping", f"""
    WITH pairs AS (SELECT x.std_modelid, platform_id AS platform_key, che300_model_id FROM l_xlat_id x
        JOIN l_xlat_std s ON x.std_modelid = s.std_modelid WHERE update_time > {_mark('rrc')})
    SELECT * FROM pairs WHERE platform_key IN (SELECT platform_key FROM pairs GROUP BY platform_key HAVING count(*) = 1)""")
def job_listing_mapping(t):
    cat, spec = listing_catalog(t), listings.PLATFORMS["rrc"]
    return listings.mapping(cat, spec, listings.last_run(cat, spec)).select("std_modelid", "platform_key", F.col("che300_model_id"))


@query("job_listing_commit", f"""
    SELECT * REPLACE (coalesce(partition_month, 'unknown') AS partition_month) FROM (
        SELECT * REPLACE (CASE WHEN id_data_input % 2 = 0 THEN quotes + 1 ELSE quotes END AS quotes,
            CASE WHEN id_data_input % 2 = 0 AND id_data_input % 3 = 0 THEN '209901' WHEN id_data_input % 2 = 0 AND id_data_input % 7 = 0 THEN NULL
                WHEN id_data_input % 5 = 0 THEN NULL ELSE partition_month END AS partition_month)
        FROM ({listing_sql("guazi")}) WHERE NOT (id_data_input % 2 = 1 AND id_data_input % 11 = 0))""")
def job_listing_commit(t):
    """Write, change, move and delete, read back: listings without a month, in moved months and in emptied ones."""
    table = listings.wide_table(t.spark, f"{fresh_folder(t.spark)}/wide")
    number, month = F.col("id_data_input"), F.col("partition_month")
    rows = cut_lineage(listings.wide_rows(listing_catalog(t), "guazi", RUN))
    first = rows.withColumn("partition_month", F.when(number % 5 != 0, month))
    listings.commit_wide(table, "guazi", first)
    changed = first.where(number % 2 == 0).withColumns({
        "quotes": F.col("quotes") + 1,
        "partition_month": F.when(number % 3 == 0, "209901").when(number % 7 != 0, month)})
    gone = first.where((number % 2 == 1) & (number % 11 == 0)).select(number.alias("id"))
    # repeated rows are one listing in either write
    listings.commit_wide(table, "guazi", changed.unionByName(changed.limit(3)), gone)
    return table.read()


class Stopped(Exception):
    """A run that ends between two tables."""


class StoppingSink:
    """A table whose writes stop the run."""

    def __init__(self, table):
        self.table = table

    def take(self, change, target):
        raise Stopped

    def read(self):
        return self.table.read()


@query("job_listing_resumed", f"""
    WITH pairs AS (SELECT platform_id FROM l_xlat_id x JOIN l_xlat_std s ON x.std_modelid = s.std_modelid WHERE update_time > {_mark('che58')}),
    mapped AS (SELECT platform_id FROM pairs GROUP BY platform_id HAVING count(*) = 1),
    cars AS (SELECT car_id FROM l_market WHERE id IN (SELECT platform_id FROM mapped)),
    dup AS (SELECT car_id FROM l_market WHERE car_id IN (SELECT car_id FROM cars) GROUP BY car_id HAVING count(*) > 1)
    SELECT id, count(*) AS crawls FROM l_market WHERE id IN (SELECT platform_id FROM mapped) OR car_id IS NULL
        OR car_id NOT IN (SELECT car_id FROM dup) GROUP BY id""")
def job_listing_resumed(t):
    """What a source holds after a run that stopped between its two tables and the run after it."""
    cat, folder = listing_catalog(t), fresh_folder(t.spark)
    source = SnapshotTable(t.spark, f"{folder}/source")
    source.commit(cat.read("listing_che58"))
    cat.bind("listing_che58", source.read)
    with contextlib.suppress(Stopped):
        listings.run(cat, "che58", RUN, f"{folder}/wide", StoppingSink(source))
    listings.run(cat, "che58", RUN, f"{folder}/wide", source)
    return source.read().groupBy("id").agg(F.count(F.lit(1)).alias("crawls"))
