"""Scans, filters, joins, aggregates, windows and set operations on the driver's tables."""

from __future__ import annotations

from functools import reduce

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.functions import geo, listing
from listingflow.functions.text import to_long
from listingflow.operators import dedupe, ids, quality, relational
from listingflow.operators.match import merge_history
from listingflow.operators.skew import lookup_join
from listingflow.queries.base import cases, query
from listingflow.sources.align import align, empty_like, project, rename_positional
from listingflow.sources.catalog import Catalog
from listingflow.sources.predicates import half_open, quantile_bounds
from listingflow.sources.id_list import parse_lines
from listingflow.streaming import incremental

RUN_DATE = "2024-01-31"

# --- scans and layouts -----------------------------------------------------

_LISTING = T.StructType([
    T.StructField("id_data_input", T.LongType()), T.StructField("quotes", T.DoubleType()),
    T.StructField("state", T.StringType()), T.StructField("annual", T.StringType()),
    T.StructField("sold", T.DateType()), T.StructField("insure", T.DateType()),
])


@query("scan_project", """
    SELECT l_orderkey AS id_data_input, l_extendedprice AS quotes, '0' AS state, '' AS annual,
           CAST(l_shipdate AS DATE) AS sold, CAST(NULL AS DATE) AS insure
    FROM lineitem""")
def scan_project(t):
    src = project(t.lineitem, {
        "id_data_input": "l_orderkey", "quotes": "l_extendedprice", "state": F.lit("0"),
        "annual": F.lit(""), "sold": F.col("l_shipdate").cast("date"), "unwanted": "l_tax",
    })
    named = rename_positional(src, [*src.columns[:-1], "dropped"])
    return align(align(named, _LISTING, "intersect"), _LISTING, "pad")


@query("scan_query", """
    SELECT DISTINCT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def scan_query(t):
    cat = Catalog(t.spark).bind_frame("places", t.nation).bind_path("regions", f"{t.folder}/region.parquet")
    return cat.query(
        "SELECT DISTINCT n_name, r_name FROM {n} JOIN {r} ON n_regionkey = r_regionkey",
        n="places", r="regions")


@query("diff_against_missing", """
    SELECT c_custkey, c_name, 'no target' AS side FROM customer
    UNION ALL SELECT c_custkey, c_name, 'empty target' AS side FROM customer""")
def diff_against_missing(t):
    cat = Catalog(t.spark).bind_path("target", f"{t.folder}/no_such_table.parquet")
    src = t.customer.select("c_custkey", "c_name")
    target = cat.read_or_empty("target", src.schema)
    first = relational.missing_from(src, target, ["c_custkey"]).withColumn("side", F.lit("no target"))
    second = relational.missing_from(src, empty_like(src), ["c_custkey"]).withColumn("side", F.lit("empty target"))
    return first.unionByName(second).unionByName(empty_like(first))


@query("id_list_filter", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT c_custkey FROM customer)
       OR o_orderkey IN (SELECT c_custkey + 100000 FROM customer)""")
def id_list_filter(t):
    # each customer gives one line of id text with a comment, a comma and junk
    lines = t.customer.select(F.concat(
        F.lit("﻿ "), F.col("c_custkey").cast("string"), F.lit(", "),
        (F.col("c_custkey") + 100000).cast("string"), F.lit("  abc # "), F.col("c_name"),
    ).alias("value"))
    wanted = parse_lines(lines, key="o_orderkey")
    return relational.semi_filter(t.orders, wanted, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


def _by_conditions(t, spelled: int):
    """Orders through a source that takes conditions: one scan for each, as a partitioned database read has."""
    cat = Catalog(t.spark).bind_conditional("orders", lambda conditions: reduce(DataFrame.unionByName, [t.orders.where(c) for c in conditions]))
    wanted = t.customer.select(F.explode(F.array("c_custkey", F.col("c_custkey") * 3 + 100)).alias("id"))
    return cat.restricted(wanted, {"orders": "o_orderkey"}, most=spelled).read("orders").select("o_orderkey", "o_totalprice")


_BY_IDS = """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT c_custkey FROM customer)
    OR o_orderkey IN (SELECT c_custkey * 3 + 100 FROM customer)"""


@query("id_list_spelled", _BY_IDS)
def id_list_spelled(t):
    return _by_conditions(t, 10**6)


@query("id_list_ranges", _BY_IDS)
def id_list_ranges(t):
    return _by_conditions(t, 10)


@query("scan_split_quantiles", """
    SELECT CAST(o_custkey AS BIGINT) AS k, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM (
        SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey * o_custkey END AS o_custkey, o_orderdate FROM orders) GROUP BY 1, 2""")
def scan_split_quantiles(t):
    """A table of uneven keys, some of them unknown, read in parts cut at quantiles and each again at months."""
    orders = t.orders.select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey") * F.col("o_custkey")).cast("long").alias("k"),
                             F.col("o_orderdate").cast("date").alias("d"))
    by_key = half_open("k", quantile_bounds(orders, "k", 4))
    by_day = half_open("d", quantile_bounds(orders, "d", 3))
    parts = [orders.where(a).where(b) for a in by_key for b in by_day]
    return reduce(DataFrame.unionByName, parts).groupBy("k", "d").agg(F.count(F.lit(1)).alias("n"))


# --- filters ---------------------------------------------------------------

@query("incremental_since", """
    SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'""")
def incremental_since(t):
    ok = incremental.since_instant(F.col("ts"), RUN_DATE, 7, inclusive=True)
    return t.events.where(ok).select("event_id", "event_type", "value")


@query("incremental_after_day", """
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS add_time
    FROM events WHERE strftime(ts, '%Y-%m-%d') > '2024-01-10'""")
def incremental_after_day(t):
    ok = incremental.after_day(F.col("ts"), incremental.days_back(RUN_DATE, 21))
    return t.events.where(ok).select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("add_time"))


@query("incremental_month_anchor", """
    SELECT o_orderkey, 'from 20th' AS span FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1998-02-20'
    UNION ALL
    SELECT o_orderkey, 'on 15th' AS span FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-03-15'
    UNION ALL
    SELECT o_orderkey, 'month' AS span FROM orders WHERE o_orderdate > TIMESTAMP '1998-03-01 00:00:00'""")
def incremental_month_anchor(t):
    run = "1998-03-05"
    day = F.col("o_orderdate")
    parts = [
        ("from 20th", incremental.after_day(day, incremental.month_anchor(run, 8, 20))),
        ("on 15th", day.cast("date") == F.lit(incremental.month_anchor(run, 0, 15))),
        ("month", day > F.lit(incremental.month_anchor(run))),
    ]
    # one scan: each order lists the spans it belongs to
    spans = F.array_compact(F.array(*[F.when(ok, F.lit(name)) for name, ok in parts]))
    return t.orders.select("o_orderkey", F.explode(spans).alias("span"))


@query("high_water_mark", """
    SELECT event_id, 'known' AS kind FROM events WHERE ts > CAST(
        (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type = 'signup' AND value > 95) AS TIMESTAMP)
    UNION ALL SELECT event_id, 'default' AS kind FROM events WHERE ts > TIMESTAMP '2000-01-01 00:00:00'
    UNION ALL SELECT event_id, 'full' AS kind FROM events""")
def high_water_mark(t):
    e = t.events
    known = incremental.high_water_mark(e, "ts", (F.col("event_type") == "signup") & (F.col("value") > 95))
    none = incremental.high_water_mark(e, "ts", F.col("event_type") == "no such type")
    pick = e.select("event_id", "ts")
    return (
        incremental.newer_than_mark(pick, "ts", known).select("event_id", F.lit("known").alias("kind"))
        .unionByName(incremental.newer_than_mark(pick, "ts", none).select("event_id", F.lit("default").alias("kind")))
        .unionByName(e.select("event_id", F.lit("full").alias("kind")))
    )


@query("threshold_split", """
    SELECT c_custkey, CASE WHEN c_acctbal <= 5000 THEN NULL ELSE 'c_acctbal above 5000' END AS reason
    FROM customer""")
def threshold_split(t):
    kept, refused = quality.split_on_threshold(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 5000)
    none = F.lit(None).cast("string").alias("reason")
    return kept.select("c_custkey", none).unionByName(refused.select("c_custkey", "reason"))


@query("reject_reasons", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'open' WHEN o_totalprice <= 50000 THEN 'cheap'
           WHEN o_orderdate < TIMESTAMP '1996-01-01 00:00:00' THEN 'old' END AS reason
    FROM orders""")
def reject_reasons(t):
    return quality.explain_rejects(t.orders, {
        "open": F.col("o_orderstatus") != "P",
        "cheap": F.col("o_totalprice") > 50000,
        "old": F.col("o_orderdate") >= F.lit(dt.date(1996, 1, 1)),
    }).select("o_orderkey", "reason")


@query("eligible_rows", f"""
    WITH o AS (SELECT o_orderkey, o_totalprice, o_orderpriority,
          {cases('o_orderkey', ['在售', '停售', '即将销售'])} AS status,
          {cases('o_orderkey', ['2018', None, '2020', '2021x', '2019'])} AS year,
          {cases('o_orderkey', ['-', '中型车', '大型车', '无'])} AS level FROM orders)
    SELECT o_orderkey, status, level, year FROM o
    WHERE status <> '即将销售' AND year IS NOT NULL AND o_totalprice <> 0 AND level <> '-'
      AND o_orderpriority NOT IN ('5-LOW', '1-URGENT') AND try_cast(year AS INTEGER) >= 2019 AND level <> '无'""")
def eligible_rows(t):
    o = t.sql(f"""SELECT o_orderkey, o_totalprice, o_orderpriority,
          {cases('o_orderkey', ['在售', '停售', '即将销售'])} AS status,
          {cases('o_orderkey', ['2018', None, '2020', '2021x', '2019'])} AS year,
          {cases('o_orderkey', ['-', '中型车', '大型车', '无'])} AS level FROM orders""")
    return o.where(
        quality.eligible(F.col("status"), F.col("year"), F.col("o_totalprice"), F.col("level"))
        & ~F.col("o_orderpriority").isin("5-LOW", "1-URGENT")
        & (F.col("year").try_cast("int") >= 2019) & (F.col("level") != "无")
    ).select("o_orderkey", "status", "level", "year")


@query("price_gap", """
    WITH p AS (SELECT l_orderkey, l_linenumber, l_extendedprice, round(l_extendedprice / l_quantity, 2) AS paid,
                      p_retailprice AS guide FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey, l_linenumber, l_extendedprice, guide FROM p
    WHERE guide <> 0 AND paid <> 0 AND abs(guide - paid) / paid <= 3 AND abs(guide - paid) / guide <= 2""")
def price_gap(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    paid = F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2)
    return rows.where(quality.price_gap_ok(F.col("p_retailprice"), paid)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.col("p_retailprice").alias("guide"))


@query("listing_sanity", """
    WITH p AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_extendedprice / 50 AS quote, p_retailprice AS guide,
                      round(date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-06-30') / 365, 2) AS age,
                      CAST(l_shipdate AS DATE) AS reg
               FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey, l_linenumber, l_extendedprice, age, reg FROM p
    WHERE quote / guide > 0.05 AND quote / guide < 1.5 AND (age < 1 OR quote / guide < 1)
      AND reg > DATE '2000-01-01' AND reg < DATE '2001-06-30'""")
def listing_sanity(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_extendedprice") / 50).alias("quote"),
        F.col("p_retailprice").alias("guide"), F.col("l_shipdate").cast("date").alias("reg"))
    rows = rows.withColumn("age", F.round(F.datediff(F.lit("2001-06-30").cast("date"), F.col("reg")) / 365, 2))
    ok = quality.listing_ok(F.col("quote"), F.col("guide"), F.col("age"), F.col("reg"), "2001-06-30")
    return rows.where(ok).select("l_orderkey", "l_linenumber", "l_extendedprice", "age", "reg")


_OLD_PRICE = """CASE p_partkey % 4 WHEN 0 THEN CAST(p_retailprice AS STRING) WHEN 1 THEN 'n/a'
                WHEN 2 THEN CAST(p_retailprice + 1 AS STRING) ELSE CAST(p_retailprice AS STRING) || '0' END"""


@query("changed_values", f"""
    WITH o AS (SELECT p_partkey, p_retailprice AS price_new, {_OLD_PRICE} AS price_old FROM part)
    SELECT p_partkey, price_new, price_old FROM o
    WHERE coalesce(price_new <> try_cast(price_old AS DOUBLE), true)""")
def changed_values(t):
    new = t.part.select("p_partkey", F.col("p_retailprice").alias("price"))
    old = t.sql(f"SELECT p_partkey, {_OLD_PRICE} AS price FROM part")
    return relational.changed_rows(new, old, "p_partkey", "price")


_SHIFTED = f"""SELECT p_partkey, {cases('p_partkey', ['1.5T', '4650', None, '2.0L', '12a'])} AS emission,
    {cases('p_partkey', ['汽油', '205/55 R16', None])} AS fuel FROM part"""


@query("shifted_rows", f"""
    WITH s AS ({_SHIFTED}) SELECT * FROM s
    WHERE regexp_matches(coalesce(emission, ''), '^[0-9]+$') OR regexp_matches(coalesce(fuel, ''), 'R[0-9]')""")
def shifted_rows(t):
    return quality.shifted_rows(t.sql(_SHIFTED))


@query("id_coverage", """
    SELECT count(*) AS requested, count(c_custkey) AS found FROM (SELECT DISTINCT user_id FROM events)
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON user_id = c_custkey""")
def id_coverage(t):
    found = t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return quality.coverage(t.events, found, "user_id")


# --- joins -----------------------------------------------------------------

@query("listing_slice", """
    WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events)
    SELECT event_id, c_custkey, n_name, r_name, value, strftime(ts, '%Y%m') AS partition_month
    FROM e JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE rn = 1 AND value / nullif(c_acctbal / 100, 0) > 0.05 AND value / nullif(c_acctbal / 100, 0) < 1.5""")
def listing_slice(t):
    latest = dedupe.latest_by(t.events.drop("props"), ["user_id"], "ts", [F.col("event_id")])
    ratio = F.try_divide(F.col("value"), F.col("c_acctbal") / 100)
    return (
        latest.join(t.customer, F.col("user_id") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .where((ratio > 0.05) & (ratio < 1.5))
        .select("event_id", "c_custkey", "n_name", "r_name", "value",
                F.date_format("ts", "yyyyMM").alias("partition_month"))
    )


@query("missing_from_target", """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey * 2 = c_custkey)""")
def missing_from_target(t):
    """All orders, their customer shifted, so that some customers are missing."""
    known = t.orders.select((F.col("o_custkey") * 2).alias("o_custkey"))
    return relational.missing_ids(t.customer.select("c_custkey", "c_name"), known, "c_custkey", "o_custkey")


_JUNK_KEYS = """SELECT o_orderkey, o_totalprice, CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'x' || CAST(o_custkey AS STRING)
    WHEN 2 THEN CAST(o_custkey AS STRING) || '.0' WHEN 3 THEN ' ' || CAST(o_custkey AS STRING) || ' '
    ELSE CAST(o_custkey AS STRING) END AS cust_text FROM orders"""


@query("join_normalised_keys", f"""
    WITH o AS ({_JUNK_KEYS})
    SELECT o_orderkey, o_totalprice, c_custkey AS cust_text, c_name FROM o
    JOIN customer ON try_cast(regexp_replace(trim(cust_text), '\\.[0-9]*$', '') AS BIGINT) = c_custkey""")
def join_normalised_keys(t):
    customers = t.customer.select("c_custkey", "c_name")
    return relational.join_normalised(t.sql(_JUNK_KEYS), customers, "cust_text", "c_custkey")


@query("left_optional", """
    SELECT c_custkey, c_name, n, total FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n, round(sum(CAST(o_totalprice AS DECIMAL(18, 2))), 2)::DOUBLE AS total
        FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""")
def left_optional(t):
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return t.customer.select("c_custkey", "c_name").join(sums, "c_custkey", "left")


@query("multi_key_join", """
    SELECT l_orderkey, l_linenumber, l_extendedprice, a.l_partkey, a.l_suppkey, n, dearest
    FROM lineitem a JOIN (SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS n, max(l_extendedprice) AS dearest
        FROM lineitem GROUP BY ALL) b
      ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag""")
def multi_key_join(t):
    fields = ["l_partkey", "l_suppkey", "l_returnflag"]
    li = t.lineitem
    stats = li.groupBy(*fields).agg(F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("dearest"))
    rows = li.select("l_orderkey", "l_linenumber", "l_extendedprice", *fields)
    return lookup_join(rows, stats, fields, "inner").drop("l_returnflag")


@query("override_from_lookup", """
    WITH s AS (SELECT s_nationkey + 5 AS s_nationkey, min(s_name) AS top, max(s_acctbal) AS best FROM supplier
               GROUP BY s_nationkey)
    SELECT c_custkey, CASE WHEN top IS NOT NULL THEN top ELSE c_name END AS c_name,
           CASE WHEN top IS NOT NULL THEN best ELSE c_acctbal END AS c_acctbal, c_nationkey
    FROM customer LEFT JOIN s ON c_nationkey = s_nationkey""")
def override_from_lookup(t):
    # shifted, so that some nations have no entry
    lookup = t.supplier.groupBy((F.col("s_nationkey") + 5).alias("c_nationkey")).agg(
        F.min("s_name").alias("top"), F.max("s_acctbal").alias("best"))
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    return relational.override_from(rows, lookup, "c_nationkey", {"c_name": "top", "c_acctbal": "best"})


@query("dictionary_map", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS code
    FROM orders""")
def dictionary_map(t):
    codes = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return t.orders.select("o_orderkey", relational.map_values(F.col("o_orderpriority"), codes).alias("code"))


_DISTRICT = """SELECT r_name AS key_province, n_name AS key_municipal, s_name AS key_county,
    lpad(CAST(r_regionkey + 10 AS STRING), 2, '0') || lpad(CAST(n_nationkey AS STRING), 2, '0')
    || lpad(CAST(s_suppkey AS STRING), 6, '0') AS city_code
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_REGIONAL = """SELECT r_name AS province, CASE WHEN r_regionkey < 2 THEN 'west' ELSE 'east' END AS regional FROM region"""


@query("district_dim", f"""
    WITH d AS ({_DISTRICT}), g AS ({_REGIONAL})
    SELECT DISTINCT regional, province, key_municipal AS city FROM d JOIN g ON key_province = province""")
def district_dim(t):
    return geo.district_dim(t.sql(_DISTRICT), t.sql(_REGIONAL))


@query("city_code_dim", f"""
    WITH d AS ({_DISTRICT})
    SELECT substr(city_code, 1, 2) AS province_id, substr(city_code, 1, 4) AS city_id, key_province AS province,
           min(key_municipal) AS city FROM d GROUP BY ALL""")
def city_code_dim(t):
    return geo.city_code_dim(t.sql(_DISTRICT))


@query("wide_table_four_way", """
    SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate::DATE AS ordered, c_name, c_mktsegment, p_name, p_brand
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN part ON l_partkey = p_partkey WHERE c_mktsegment <> 'MACHINERY'""")
def wide_table_four_way(t):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.where("c_mktsegment <> 'MACHINERY'"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("o_orderdate").cast("date").alias("ordered"),
                "c_name", "c_mktsegment", "p_name", "p_brand")
    )


@query("max_year_rows", """
    SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders a
    WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders b WHERE b.o_custkey = a.o_custkey)""")
def max_year_rows(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    return dedupe.rows_at_max(rows, ["o_custkey"], "y")


# --- aggregates ------------------------------------------------------------

@query("only_unique_keys", """
    WITH o AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, o_totalprice FROM orders)
    SELECT o_custkey, month, o_orderkey, o_totalprice FROM o
    WHERE (o_custkey, month) IN (SELECT (o_custkey, month) FROM o GROUP BY o_custkey, month HAVING count(*) = 1)""")
def only_unique_keys(t):
    rows = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", "o_totalprice")
    return dedupe.only_unique(rows, ["o_custkey", "month"])


@query("change_counts", """
    SELECT c_mktsegment, count(*) AS total, count(k) AS reused, count(*) - count(k) AS "new"
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) ON c_custkey = k
    GROUP BY c_mktsegment ORDER BY c_mktsegment""")
def change_counts(t):
    known = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return quality.change_counts(t.customer, known, "c_custkey", "c_mktsegment").orderBy("c_mktsegment")


@query("duplicate_keys", """
    SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t):
    return dedupe.duplicate_keys(t.events, ["user_id", "event_type"])


@query("max_suffix", """
    SELECT p_type, max(CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT)) AS max_suffix FROM part GROUP BY p_type""")
def max_suffix(t):
    return ids.max_suffix(t.part, "p_type", "p_brand")


@query("id_parts", """
    SELECT p_partkey, regexp_replace(p_brand, '[a-zA-Z]', '', 'g') AS digits,
           CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS n,
           p_brand || 'S' || CAST(p_size AS VARCHAR) AS code FROM part""")
def id_parts(t):
    return t.part.select(
        "p_partkey", F.regexp_replace("p_brand", "[a-zA-Z]", "").alias("digits"),
        to_long(F.regexp_extract("p_brand", r"(\d+)$", 1)).alias("n"),
        F.concat(F.col("p_brand"), F.lit("S"), F.col("p_size").cast("string")).alias("code"))


_PAIRS = """SELECT c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 3000 THEN 'low' ELSE 'high' END AS level,
    CAST(year(o_orderdate) AS INT) AS y FROM customer JOIN orders ON c_custkey = o_custkey"""


@query("representative_pair", f"""
    WITH p AS ({_PAIRS}), n AS (
      SELECT c_nationkey, c_mktsegment, level, count(*) AS n FROM p a
      WHERE y = (SELECT max(y) FROM p b WHERE b.c_nationkey = a.c_nationkey) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment, level) AS most,
                    row_number() OVER (PARTITION BY c_nationkey ORDER BY n, c_mktsegment, level) AS least FROM n)
    SELECT c_nationkey, c_mktsegment, level, 'most' AS pick FROM r WHERE most = 1
    UNION ALL SELECT c_nationkey, c_mktsegment, level, 'least' AS pick FROM r WHERE least = 1""")
def representative_pair(t):
    rows = t.sql(_PAIRS)
    picks = [
        dedupe.representative_pair(rows, "c_nationkey", "y", ["c_mktsegment", "level"], pick)
        .withColumn("pick", F.lit(pick)) for pick in ("most", "least")
    ]
    return picks[0].unionByName(picks[1])


@query("any_value_per_group", """
    SELECT user_id, v.event_type AS event_type, v.value AS value FROM (
      SELECT user_id, min(struct_pack(event_type := event_type, value := value)) AS v FROM events GROUP BY user_id)""")
def any_value_per_group(t):
    return t.events.groupBy("user_id").agg(F.min(F.struct("event_type", "value")).alias("v")).select(
        "user_id", "v.event_type", "v.value")


# --- windows ---------------------------------------------------------------

@query("latest_by", """
    SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1""")
def latest_by(t):
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return dedupe.latest_by(rows, ["user_id", "event_type"], "ts", [F.col("event_id")]).drop("ts")


@query("one_per_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def one_per_key(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return dedupe.one_per_key(rows, ["l_orderkey"])


@query("dense_codes", """
    SELECT p_type, p_name, dense_rank() OVER (PARTITION BY p_type ORDER BY p_name) AS code
    FROM (SELECT DISTINCT p_type, p_name FROM part)""")
def dense_codes(t):
    return ids.rank_within(t.part.select("p_type", "p_name").distinct(), ["p_type"], ["p_name"], "code")


@query("group_size_and_min", """
    SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS group_size,
           CAST(event_id = min(event_id) OVER (PARTITION BY user_id) AS INTEGER) AS is_min FROM events""")
def group_size_and_min(t):
    return dedupe.group_size_and_min(t.events.select("event_id", "user_id"), ["user_id"], "event_id")


# --- sets ------------------------------------------------------------------

@query("set_remaining", """
    SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey * 2 FROM lineitem)""")
def set_remaining(t):
    used = t.lineitem.select((F.col("l_partkey") * 2).alias("p_partkey")).distinct()
    return relational.missing_from(t.part.select("p_partkey", "p_name"), used, ["p_partkey"])


@query("set_union_distinct", """
    SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'
    UNION SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F'
    UNION SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity < 5""")
def set_union_distinct(t):
    li = t.lineitem
    keys = ["l_partkey", "l_suppkey"]
    parts = [li.where(c).select(*keys) for c in ("l_returnflag = 'A'", "l_linestatus = 'F'", "l_quantity < 5")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@query("merge_history", """
    WITH h AS (SELECT o_custkey * 2 AS o_custkey, CAST(min(o_orderkey) AS VARCHAR) AS id, 1 AS kind FROM orders
               GROUP BY o_custkey),
         f AS (SELECT o_custkey, CAST(max(o_orderkey) AS VARCHAR) AS id, 2 AS kind FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS id_std, CASE WHEN h.id IS NOT NULL THEN h.id ELSE f.id END AS id,
           CASE WHEN h.id IS NOT NULL THEN h.kind ELSE f.kind END AS kind
    FROM customer LEFT JOIN h ON c_custkey = h.o_custkey LEFT JOIN f ON c_custkey = f.o_custkey""")
def merge_history_query(t):
    base = t.customer.select(F.col("c_custkey").alias("id_std"))
    orders = t.orders.withColumnRenamed("o_custkey", "id_std")
    old = orders.groupBy((F.col("id_std") * 2).alias("id_std")).agg(
        F.min("o_orderkey").cast("string").alias("id"), F.lit(1).alias("kind"))
    new = orders.groupBy("id_std").agg(F.max("o_orderkey").cast("string").alias("id"), F.lit(2).alias("kind"))
    return merge_history(base, old, new, ["id", "kind"])


# --- dates and numbers -----------------------------------------------------

@query("date_rules", """
    WITH d AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) AS added,
        CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'bad' WHEN 3 THEN '1999-01-15' ELSE '2001-01-15' END AS expires,
        CASE l_orderkey % 3 WHEN 0 THEN NULL ELSE CAST(l_shipdate AS DATE) - 40 END AS updated FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice,
        CASE WHEN try_cast(expires AS DATE) IS NULL THEN '' WHEN date_diff('day', try_cast(expires AS DATE), added) > 0 THEN '1' ELSE '0' END AS expired,
        coalesce(updated, added) AS listed, strftime(added, '%Y%m') AS partition_month,
        round(date_diff('day', date_trunc('month', added - 900)::DATE, added) / 365, 2) AS age,
        try_cast(strftime(added, '%Y-%m') || '-01' AS DATE) AS month_start, strftime(added, '%Y-%m-%d') AS ymd
    FROM d""")
def date_rules(t):
    d = t.sql("""SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) AS added,
        CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'bad' WHEN 3 THEN '1999-01-15' ELSE '2001-01-15' END AS expires,
        CASE l_orderkey % 3 WHEN 0 THEN NULL ELSE CAST(l_shipdate AS DATE) - 40 END AS updated FROM lineitem""")
    added = F.col("added")
    return d.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        listing.expiry_flag(added, F.col("expires")).alias("expired"),
        listing.listing_day(F.col("updated"), added).alias("listed"),
        listing.partition_month(added).alias("partition_month"),
        listing.age_years(added, listing.reg_month(F.date_sub(added, 900))).alias("age"),
        listing.month_start(F.date_format(added, "yyyy-MM")).alias("month_start"),
        F.date_format(added, "yyyy-MM-dd").alias("ymd"))


@query("numeric_rules", """
    SELECT l_orderkey, l_linenumber, l_extendedprice,
        CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)) / 10000, 2) AS DOUBLE) AS price,
        CASE WHEN CASE WHEN l_quantity > 10 THEN l_quantity END >= l_discount * 100
             THEN CASE WHEN l_quantity > 10 THEN l_quantity END ELSE l_discount * 100 END AS miles,
        substr(lpad(CAST(l_partkey AS VARCHAR), 8, '0'), 1, 4) AS region_code
    FROM lineitem""")
def numeric_rules(t):
    appended = F.when(F.col("l_quantity") > 10, F.col("l_quantity"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.round(F.col("l_extendedprice") / 10000, 2).alias("price"),
        listing.larger_mileage(appended, F.col("l_discount") * 100).alias("miles"),
        F.substring(F.lpad(F.col("l_partkey").cast("string"), 8, "0"), 1, 4).alias("region_code"))


