"""Cross-platform matching of parts, as standard models, with shifted copies of themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.operators import match
from listingflow.queries.base import DERIVED, cases, query

_GEAR = cases("p_size", ["CVT", "手自一体", "双离合", "手动", None])
# Standard models: parts; brand, series, year and price repeat across parts.
DERIVED["x_std"] = f"""SELECT p_partkey AS car_id, p_brand AS brand_name, p_type AS series_name, p_name AS model_name,
    CAST(round(10 + (p_size % 7) * 1.3, 1) AS STRING) AS model_price, CAST(2015 + p_size % 6 AS STRING) AS model_year,
    CAST(1 + p_size % 3 AS STRING) || '.5L' AS liter, {_GEAR} AS car_auto,
    {cases('p_size', ['国四', '国五+OBD', '国六'])} AS discharge_standard FROM part"""
# Platform models: the same parts with some fields changed, blanked or in another spelling.
DERIVED["x_plat"] = f"""SELECT p_partkey + 500000 AS car_id, lower(p_brand) AS brand_name, p_type AS series_name, p_name AS model_name,
    CASE p_partkey % 6 WHEN 0 THEN '99.9' WHEN 1 THEN 'n/a' ELSE CAST(round(10 + (p_size % 7) * 1.3, 1) AS STRING) END AS model_price,
    CASE p_partkey % 11 WHEN 0 THEN 'bad' ELSE CAST(2015 + p_size % 6 AS STRING) END AS model_year,
    CASE p_partkey % 5 WHEN 0 THEN NULL ELSE CAST(1 + p_size % 3 AS STRING) || '.5T' END AS liter,
    CASE p_partkey % 7 WHEN 0 THEN '其他' ELSE {_GEAR} END AS car_auto,
    CASE p_partkey % 3 WHEN 0 THEN '国三' ELSE {cases('p_size', ['国四', '国五', '国六'])} END AS discharge_standard FROM part"""


# Both lists with a text that may name the drive.
_DRIVES = ["四驱版", "AWD", "两驱", "x 2WD", "", None]
DERIVED["x_std_drive"] = f"SELECT *, {cases('p_size', _DRIVES).replace('p_size', 'car_id')} AS drive_text FROM x_std"
DERIVED["x_plat_drive"] = f"SELECT *, {cases('p_size', _DRIVES).replace('p_size', '(car_id - 500000)')} AS drive_text FROM x_plat"


def features_sql(table: str, drive: str = "''") -> str:
    gear = "coalesce(car_auto, '')"
    for pattern, word in V.GEARBOX_MATCH_RULES:
        gear = f"regexp_replace({gear}, '{pattern}', '{word}', 'g')"
    return f"""SELECT CAST(car_id AS VARCHAR) AS car_id, upper(coalesce(brand_name, '')) AS car_name,
        upper(coalesce(series_name, '')) AS car_series1,
        CAST(coalesce(try_cast(model_year AS DOUBLE), 0) AS INTEGER) AS car_year,
        round_even(coalesce(try_cast(model_price AS DOUBLE), 0), 1) AS car_price,
        coalesce(regexp_extract(coalesce(liter, ''), '([0-9]+\\.?[0-9]*)', 1), '') AS car_liter_wu,
        {gear} AS car_auto, {drive} AS car_drive,
        regexp_replace(coalesce(discharge_standard, ''), '\\+OBD|OBD', '', 'g') AS car_discharge FROM {table}"""


@query("match_features", f"SELECT * FROM ({features_sql('x_plat')}) UNION ALL SELECT * FROM ({features_sql('x_std')})")
def match_features(t):
    return match.features(t.x_plat).unionByName(match.features(t.x_std))


def _rounds_sql(platform: str = "x_plat", standard: str = "x_std", drive: str = "''") -> str:
    """The round-by-round form: each round joins what is still open."""
    parts = [f"p AS ({features_sql(platform, drive)}), s AS ({features_sql(standard, drive)})"]
    for i, fields in enumerate(V.MATCH_ROUNDS):
        on = " AND ".join(f"p.{f} = s.{f}" for f in fields)
        done = " ".join(f"AND p.car_id NOT IN (SELECT platform_id FROM r{j})" for j in range(i))
        parts.append(f"""r{i} AS (SELECT p.car_id AS platform_id, count(*) AS candidates, min(s.car_id) AS id FROM p JOIN s ON {on}
            WHERE true {done} GROUP BY p.car_id)""")
    union = " UNION ALL ".join(f"SELECT *, CAST({i} AS INTEGER) AS round FROM r{i}" for i in range(len(V.MATCH_ROUNDS)))
    parts.append(f"m AS ({union})")
    # candidate pairs of each platform model's own round, where the prices agree
    ons = " OR ".join(
        f"(m.round = {i} AND {' AND '.join(f'p.{f} = s.{f}' for f in fields)})" for i, fields in enumerate(V.MATCH_ROUNDS))
    parts.append(f"""pairs AS (SELECT m.platform_id, s.car_id AS id, p.car_auto = s.car_auto AS same_gear, m.candidates
        FROM m JOIN p ON p.car_id = m.platform_id JOIN s ON p.car_year = s.car_year AND p.car_name = s.car_name
          AND p.car_series1 = s.car_series1
        WHERE ({ons}) AND round(abs(p.car_price - s.car_price), 1) = 0)""")
    parts.append("""geared AS (SELECT platform_id, min(id) AS id FROM pairs WHERE candidates > 1 AND same_gear
        GROUP BY platform_id HAVING count(*) = 1)""")
    parts.append("""lone AS (SELECT platform_id, min(id) AS id FROM pairs WHERE platform_id NOT IN (SELECT platform_id FROM geared)
        GROUP BY platform_id HAVING count(*) = 1)""")
    parts.append("""f AS (SELECT * FROM geared UNION ALL SELECT * FROM lone)""")
    return ", ".join(parts)


@query("cascade_match", f"""WITH {_rounds_sql()}
    SELECT m.platform_id, round, candidates, CASE WHEN candidates = 1 THEN 'right' ELSE 'repeat' END AS match_des,
        CASE WHEN candidates = 1 THEN m.id END AS id_std FROM m""")
def cascade_match(t):
    return match.cascade(match.features(t.x_plat), match.features(t.x_std)).drop("final_id")


@query("cascade_post_filter", f"""WITH {_rounds_sql()}
    SELECT m.platform_id, m.id AS id_std FROM m JOIN p ON p.car_id = m.platform_id JOIN s ON s.car_id = m.id
    WHERE candidates = 1 AND round(abs(p.car_price - s.car_price), 1) = 0""")
def cascade_post_filter(t):
    found = match.cascade(match.features(t.x_plat), match.features(t.x_std))
    return found.where("match_des = 'right' AND final_id IS NOT NULL").select("platform_id", F.col("final_id").alias("id_std"))


@query("cascade_resolve", f"""WITH {_rounds_sql()}
    SELECT f.platform_id, f.id AS id_std FROM f JOIN m ON f.platform_id = m.platform_id WHERE candidates > 1""")
def cascade_resolve(t):
    found = match.cascade(match.features(t.x_plat), match.features(t.x_std))
    return found.where("match_des = 'repeat' AND final_id IS NOT NULL").select("platform_id", F.col("final_id").alias("id_std"))


_DRIVE_SQL = """CASE WHEN regexp_matches(coalesce(drive_text, ''), '四驱|AWD|4WD|4X4|4x4') THEN '四驱'
        WHEN regexp_matches(coalesce(drive_text, ''), '两驱|FWD|RWD|2WD') THEN '两驱' ELSE '' END"""
_PRICED, _GEARED = (*V.MATCH_FIELDS[:4], "car_price"), (*V.MATCH_ROUNDS[4], "car_auto")
# what separates the candidates of a round, in order of trial, when drives are compared
_BY_DRIVE = {
    1: [(*V.MATCH_ROUNDS[1], "car_drive")], 3: [(*_PRICED, "car_drive"), _PRICED], 4: [_GEARED, (*V.MATCH_ROUNDS[4], "car_drive")]}


def _lone_sql() -> str:
    """Platform models of one candidate under a set of fields, and the coalesce of a round's sets."""
    parts, picks = [], []
    for i, sets in _BY_DRIVE.items():
        for k, fields in enumerate(sets):
            on = " AND ".join(f"p.{f} = s.{f}" for f in fields)
            parts.append(f"""o{i}{k} AS (SELECT p.car_id AS platform_id, min(s.car_id) AS id FROM p JOIN s ON {on}
                GROUP BY p.car_id HAVING count(*) = 1)""")
        picks.append(f"WHEN {i} THEN coalesce({', '.join(f'o{i}{k}.id' for k in range(len(sets)))})")
    joins = " ".join(f"LEFT JOIN o{i}{k} ON o{i}{k}.platform_id = m.platform_id" for i, sets in _BY_DRIVE.items() for k in range(len(sets)))
    return f"""{', '.join(parts)}
        SELECT m.platform_id, m.round, candidates, CASE WHEN candidates > 1 THEN CASE m.round {' '.join(picks)} END
            WHEN round(abs(p.car_price - s.car_price), 1) = 0 THEN m.id END AS final_id
        FROM m JOIN p ON p.car_id = m.platform_id JOIN s ON s.car_id = m.id {joins}"""


@query("cascade_drive", f"WITH {_rounds_sql('x_plat_drive', 'x_std_drive', _DRIVE_SQL)}, {_lone_sql()}")
def cascade_drive(t):
    """The cascade with the drive among the fields, read from a text."""
    sides = [match.features(df, True, "drive_text") for df in (t.x_plat_drive, t.x_std_drive)]
    return match.cascade(*sides, use_drive=True).select("platform_id", "round", "candidates", "final_id")


@query("fold_platforms", f"""WITH {_rounds_sql()}, one AS (SELECT id, min(platform_id) AS platform_id FROM f GROUP BY id),
    two AS (SELECT CAST(l_partkey * 3 AS VARCHAR) AS id, CAST(min(l_suppkey) AS VARCHAR) AS platform_id FROM lineitem
            GROUP BY l_partkey)
    SELECT CAST(car_id AS VARCHAR) AS id_std, coalesce(one.platform_id, '0') AS id_a,
        CASE WHEN one.id IS NULL THEN 0 ELSE 1 END AS match_type_a, CASE WHEN one.id IS NULL THEN 0 ELSE 1 END AS is_only_a,
        coalesce(two.platform_id, '0') AS id_b, CASE WHEN two.id IS NULL THEN 0 ELSE 2 END AS match_type_b, '0' AS id_c
    FROM x_std LEFT JOIN one ON one.id = CAST(car_id AS VARCHAR) LEFT JOIN two ON two.id = CAST(car_id AS VARCHAR)""")
def fold_platforms(t):
    first = match.settled_matches(match.cascade(match.features(t.x_plat), match.features(t.x_std)))
    second = t.lineitem.groupBy(
        (F.col("l_partkey") * 3).cast("string").alias("id_std")).agg(F.min("l_suppkey").cast("string").alias("id_b"))
    none = t.spark.createDataFrame([], "id_std string, id_c string")
    return match.fold_platforms(
        t.x_std.select(F.col("car_id").cast("string").alias("id_std")),
        {"a": first.toDF("id_std", "id_a", "match_type_a", "is_only_a"),
         "b": second.withColumn("match_type_b", F.lit(2)), "c": none})
