"""Ids, matching, dedupe and sources against brute force on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.operators import dedupe, ids, match, quality, relational
from listingflow.sources.align import align, rename_positional
from listingflow.sources.catalog import Catalog, TableMissing
from listingflow.sources.id_list import inline_ids, read_id_list
from listingflow.sources.jdbc import JdbcSink, JdbcSource, jdbc_options, merge_statements


def test_allocate(spark):
    known = spark.createDataFrame([("A", "A1"), ("A", "A7")], "g string, code string")
    new = spark.createDataFrame([(1, "A", "p"), (2, "A", "q"), (3, "A", "q"), (4, "B", "r"), (5, None, "s")], "i int, g string, name string")
    got = {r.i: r.code for r in ids.allocate(new, known, "g", "name", "code").collect()}
    assert got == {1: "A8", 2: "A9", 3: "A9", 4: "B1"}


def test_rank_within_equals_dense_rank_whatever_the_layout(spark):
    rnd = random.Random(3)
    # one group holds most of the rows
    rows = list({("hot" if rnd.random() < 0.7 else rnd.choice("abc"), f"n{rnd.randrange(4000):04d}") for _ in range(3000)})
    want = {}
    for g in {r[0] for r in rows}:
        for i, n in enumerate(sorted(n for gg, n in rows if gg == g), 1):
            want[g, n] = i
    df = spark.createDataFrame(rows, "g string, n string")
    for parts in (1, 7):
        got = {(r.g, r.n): r["rank"] for r in ids.rank_within(df.repartition(parts), ["g"], ["n"]).collect()}
        assert got == want


def brute_cascade(plat, std, use_drive):
    """Round by round over pairs, then price check and separation of repeats."""
    open_ids, rounds = {p["car_id"] for p in plat}, {}
    for i, fields in enumerate(V.MATCH_ROUNDS):
        found = {}
        for p, s in itertools.product(plat, std):
            if p["car_id"] in open_ids and all(p[f] == s[f] for f in fields):
                found.setdefault(p["car_id"], []).append(s)
        rounds.update({k: (i, v) for k, v in found.items()})
        open_ids -= set(found)
    out = {}
    by_id = {p["car_id"]: p for p in plat}
    for k, (i, cands) in rounds.items():
        p = by_id[k]
        same = [s for s in cands if round(abs(p["car_year"] - s["car_year"]) + abs(p["car_price"] - s["car_price"]), 1) == 0]
        final = None
        if len(cands) == 1:
            final = same[0]["car_id"] if same else None
        else:
            for pick in ([s for s in same if s["car_auto"] == p["car_auto"]],
                         [s for s in same if s["car_drive"] == p["car_drive"]], same):
                if len(pick) == 1:
                    final = pick[0]["car_id"]
                    break
        out[k] = (i, len(cands), final)
    return out


@pytest.mark.parametrize("use_drive", [False, True])
def test_cascade_equals_round_by_round(spark, use_drive):
    rnd = random.Random(11)

    def car(i):
        return (i, rnd.choice(["a", "b"]), rnd.choice(["s", "t"]), rnd.choice(["m AWD", "m 2WD", "m"]), rnd.choice(["9.96", "10.0", "11", "x"]),
                rnd.choice(["2019", "2020"]), rnd.choice(["1.5L", "2.0T", None]), rnd.choice(["手动", "CVT", None]), rnd.choice(["国五", "国六"]))

    schema = ("car_id long, brand_name string, series_name string, model_name string, model_price string, "
              "model_year string, liter string, car_auto string, discharge_standard string")
    plat = match.features(spark.createDataFrame([car(i) for i in range(160)], schema), use_drive)
    std = match.features(spark.createDataFrame([car(1000 + i) for i in range(60)], schema), use_drive)
    want = brute_cascade([r.asDict() for r in plat.collect()], [r.asDict() for r in std.collect()], use_drive)
    got = {r.platform_id: (r["round"], r.candidates, r.final_id) for r in match.cascade(plat, std, use_drive).collect()}
    assert got == want
    assert {i for i, _, _ in got.values()} >= {0, 1, 2, 3}


def test_only_unique_drops_repeats_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert [tuple(r) for r in dedupe.only_unique(df, ["k"]).collect()] == [(1, "a")]


def test_latest_puts_unknown_times_last(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, "2024", "t"), (2, None, "b"), (2, None, "a")], "k int, ts string, v string")
    assert {(r.k, r.v) for r in dedupe.latest_by(df, ["k"], "ts").collect()} == {(1, "t"), (2, "a")}


def test_representative_pair(spark):
    df = spark.createDataFrame(
        [(1, 2019, "old", 1)] * 5 + [(1, 2020, "b", 1)] * 2 + [(1, 2020, "a", 0)], "s int, y int, lv string, g int")
    assert dedupe.representative_pair(df, "s", "y", ["lv", "g"]).first().lv == "b"
    assert dedupe.representative_pair(df, "s", "y", ["lv", "g"], "least").first().lv == "a"


def test_changed_rows_counts_unreadable_numbers(spark):
    new = spark.createDataFrame([(1, "10"), (2, "10"), (3, "x"), (4, "5.0")], "k int, p string")
    old = spark.createDataFrame([(1, "10.00"), (2, "11"), (3, "x"), (4, "5")], "k int, p string")
    assert {r.k for r in relational.changed_rows(new, old, "k", "p").collect()} == {2, 3}


def test_threshold_guard(spark):
    df = spark.createDataFrame([(1,), (V.MANUAL_ID_THRESHOLD + 1,)], "id long")
    kept, refused = quality.split_on_threshold(df, "id")
    assert [r.id for r in kept.collect()] == [1] and refused.count() == 1
    with pytest.raises(ValueError):
        quality.require_some(kept.limit(0), "ids")


def test_id_lists(spark, tmp_path):
    f = tmp_path / "ids.csv"
    f.write_text("﻿autohome_id\n123\n45,67 # note 9\n\nabc\n123\n# 5\n", encoding="utf-8")
    assert sorted(r.id for r in read_id_list(spark, str(f), skip_header=True).collect()) == [45, 67, 123]
    f.write_text("﻿123\n45\n", encoding="utf-8")
    assert sorted(r.id for r in read_id_list(spark, str(f)).collect()) == [45, 123]
    assert sorted(r.id for r in inline_ids(spark, "3, 1,\n3").collect()) == [1, 3]
    with pytest.raises(ValueError):
        inline_ids(spark, "3,x")


def test_align_and_rename(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("ee(%)", T.StringType())])
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    assert align(df, schema).dtypes == [("a", "bigint"), ("ee(%)", "string")]
    assert align(df, schema, "intersect").columns == ["a"]
    assert rename_positional(df, ["p", "max_n-m"]).columns == ["p", "max_n-m"]
    assert rename_positional(df, ["p"]).columns == ["a", "z"]


def test_catalog_missing_tables(spark, tmp_path):
    cat = Catalog(spark).bind_path("gone", str(tmp_path / "none")).bind_table("no", "no_such_table")
    for name in ("gone", "no", "unbound"):
        with pytest.raises(TableMissing):
            cat.read(name)
    assert cat.read_or_empty("gone", spark.range(1).schema).columns == ["id"]
    df = spark.createDataFrame([(1,)], "theirs int")
    assert Catalog(spark).bind_frame("t", df, {"theirs": "ours"}).read("t").columns == ["ours"]
    bad = Catalog(spark).bind("b", lambda: df.select("nope"))
    with pytest.raises(Exception, match="nope"):
        bad.read_or_empty("b", df.schema)


def test_jdbc_text():
    src = JdbcSource("h", 3306, "d", "u", "p")
    assert "zeroDateTimeBehavior=convertToNull" in src.jdbc_url() and "Asia/Shanghai" in src.jdbc_url()
    assert "useCursorFetch=true" in src.jdbc_url()
    assert "secret" not in repr(JdbcSource(password="secret"))
    assert jdbc_options(src, dbtable="t", numPartitions=4)["numPartitions"] == "4"
    assert merge_statements("t", "s", ["id", "ee(%)"], "upsert") == [
        "INSERT INTO `t` (`id`, `ee(%)`) SELECT `id`, `ee(%)` FROM `s` "
        "ON DUPLICATE KEY UPDATE `id`=VALUES(`id`), `ee(%)`=VALUES(`ee(%)`)"]
    assert merge_statements("t", "s", ["id"], "insert_ignore") == ["INSERT IGNORE INTO `t` (`id`) SELECT `id` FROM `s`"]
    assert merge_statements("t", "s", ["id"], "replace") == ["REPLACE INTO `t` (`id`) SELECT `id` FROM `s`"]
    assert merge_statements("t", "s", ["id", "name", "v"], "keep_id", ["name"]) == [
        "INSERT INTO `t` (`name`, `v`) SELECT `name`, `v` FROM `s` ON DUPLICATE KEY UPDATE `v`=VALUES(`v`)"]
    assert merge_statements("t", "s", ["id", "name"], "insert_numbered", ["name"]) == ["INSERT IGNORE INTO `t` (`name`) SELECT `name` FROM `s`"]
    assert merge_statements("t", "s", ["a", "b", "v"], "update", ["a", "b"], ["v"]) == [
        "UPDATE `t` t JOIN `s` s ON t.`a` = s.`a` AND t.`b` = s.`b` SET t.`v` = s.`v`"]
    assert merge_statements("t", "s", ["a"], "delete", ["a"]) == ["DELETE t FROM `t` t JOIN `s` s ON t.`a` = s.`a`"]
    assert merge_statements("t", "s", ["a"], "truncate") == ["RENAME TABLE `t` TO `s_old`, `s` TO `t`", "DROP TABLE `s_old`"]
    for mode, keys in (("update", ()), ("delete", ()), ("other", ("a",))):
        with pytest.raises(ValueError):
            merge_statements("t", "s", ["a"], mode, keys)


def test_a_database_sink_stages_one_row_per_key_for_every_mode(spark):
    from listingflow.plans.base import Change

    sink = JdbcSink(spark, JdbcSource(), "t")
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    for mode in ("insert_ignore", "update", "delete", "truncate"):
        change = Change("t", twice, ("k",), mode, ("v",))
        statements = sink.plan(change, "s")
        assert statements[0] == "CREATE TABLE `s` LIKE `t`" and statements[-1] == "DROP TABLE IF EXISTS `s`" and len(statements) >= 3
        rows = sorted(tuple(r) for r in sink.staged_rows(change).collect())
        assert rows == ([(1,), (2,)] if mode == "delete" else [(1, "a"), (2, "c")])
    with pytest.raises(Exception, match="duplicate merge key"):
        sink.staged_rows(Change("t", twice, ("k",))).collect()
    with pytest.raises(ValueError):
        sink.plan(Change("t", twice, ("k",), "update", ("v",), when=F.col("v") > "a"), "s")


def test_conditions_of_a_split_hold_every_row_once(spark):
    import datetime as dt

    from listingflow.sources import predicates as P

    keys = [None, None, -5, 0, 0, 1, 1, 1, 2, 10**12, 10**12 + 1, 7]
    df = spark.createDataFrame([(k, dt.date(2024, 1, 1) + dt.timedelta(days=abs(k or 0) % 400), f"it's {k}") for k in keys], "k long, d date, s string")
    stamped = df.withColumn("t", F.col("d").cast("timestamp_ntz"))
    for column in ("k", "d", "t"):
        for parts in (1, 2, 3, 50):
            conditions = P.half_open(column, P.quantile_bounds(stamped, column, parts))
            assert sum(stamped.where(c).count() for c in conditions) == len(keys), (column, parts, conditions)
    assert P.half_open("a`b", []) == ["1 = 1"] and P.half_open("k", [], nulls=False) == ["`k` IS NOT NULL"]
    assert P.half_open("k", [3, 1]) == ["(`k` < 1 OR `k` IS NULL)", "`k` >= 1 AND `k` < 3", "`k` >= 3"]
    months = P.month_bounds(dt.date(2023, 11, 20), dt.date(2024, 2, 1))
    assert months == [dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    assert sum(df.where(c).count() for c in P.half_open("d", months)) == len(keys)
    assert df.where(P.in_lists("s", ["it's 7", "x"])[0]).count() == 1
    assert P.in_lists("k", [5, 3, 3, 9], chunk=2) == ["`k` IN (3, 5)", "`k` IN (9)"] and P.literal(dt.date(2024, 1, 2)) == "'2024-01-02'"
    for bad in (True, "back\\slash"):
        with pytest.raises(ValueError):
            P.literal(bad)


def test_chosen_ids_reach_a_source_that_takes_conditions(spark):
    from listingflow.sources import predicates as P
    from listingflow.sources.catalog import Catalog

    ids = spark.createDataFrame([(i,) for i in [5, 5, 1000, None, *range(40, 60)]], "id long")
    assert P.id_conditions(ids, "id", "k", most=100)[0].startswith("`k` IN (5, 40, 41")
    wide = P.id_conditions(ids, "id", "k", most=3, ranges=4)
    rows = spark.range(2000).withColumnRenamed("id", "k")
    assert 1 < len(wide) <= 4 and sorted(r.k for c in wide for r in rows.where(c).collect()) == list(range(5, 1001))
    assert P.id_conditions(ids.limit(0), "id", "k") == ["1 = 0"]
    asked = []

    def read(conditions):
        asked.append(conditions)
        return rows.withColumnRenamed("k", "physical").where(" OR ".join(f"({c})" for c in conditions))

    cat = Catalog(spark).bind_conditional("t", read, {"physical": "k"}).bind_frame("plain", rows)
    for most in (3, 100):
        small = cat.restricted(ids, {"t": "k", "plain": "k", "unbound": "k"}, most=most)
        want = sorted({r.id for r in ids.collect() if r.id is not None})
        assert sorted(r.k for r in small.read("t").collect()) == want == sorted(r.k for r in small.read("plain").collect())
        assert all("`physical`" in c for c in asked[-1])
    assert cat.read("t").count() == 2000 and asked[-1] == ["1 = 1"]


def test_a_prefix_index_explodes_one_row_for_each_place(spark):
    from listingflow.functions import geo

    words = spark.createDataFrame([("北京",), ("北京市",), ("北",), ("海",), ("",), (None,)], "w string")
    texts = spark.createDataFrame([("在北京市",), ("x海北京",), ("",), (None,), ("none",), ("x" * 3000 + "海",)], "t string")
    found = geo.first_word_by_join(texts, "t", "hit", words, "w")
    got = {r.t: r.hit for r in found.collect()}
    assert got == {"在北京市": "北京市", "x海北京": "海", "": None, None: None, "none": None, "x" * 3000 + "海": "海"}
    long = spark.createDataFrame([("abc",), ("abcd",), ("bcd",)], "w string")
    some = spark.createDataFrame([("zabcde",), ("ab",), ("xbcd",)], "t string")
    assert {r.t: r.hit for r in geo.first_word_by_join(some, "t", "hit", long, "w").collect()} == {"zabcde": "abcd", "ab": None, "xbcd": "bcd"}
    plan = str(found._jdf.queryExecution().optimizedPlan().toString())
    assert plan.count("Generate") == 1


def test_words_that_begin_alike_do_not_all_meet_a_place(spark):
    from listingflow.functions import geo

    # one beginning, several lengths, words within words
    names = [f"Supplier#{i}" for i in range(2000)] + ["Supplier", "Sup"]
    texts = [f"near Supplier#{i}x" for i in range(0, 4000, 7)] + ["Suppl", "xSupplier#", "Su", "SuSup", None, ""]
    words = spark.createDataFrame([(n,) for n in names], "w string")
    found = geo.first_word_by_join(spark.createDataFrame([(t, 1) for t in texts], "t string, other int"), "t", "hit", words, "w")

    def brute(text):
        hits = [(text.find(n), -len(n), n) for n in names if n in text]
        return min(hits)[2] if hits else None

    assert found.columns == ["t", "other", "hit"]
    assert {r.t: r.hit for r in found.collect()} == {t: brute(t) if t else None for t in texts}
    # whole words meet by equality: no join has a comparison beside its keys
    plan = str(found._jdf.queryExecution().optimizedPlan().toString())
    assert "StartsWith" not in plan and "startswith" not in plan


def test_explain_rejects_names_the_first_broken_rule(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    got = quality.explain_rejects(df, {"no value": F.col("v").isNotNull(), "is y": F.col("v") != "y"})
    assert {r.k: r.reason for r in got.collect()} == {1: None, 2: "no value", 3: "is y"}


def test_places_are_the_same_at_every_dictionary_limit(spark):
    from listingflow.functions import geo

    counties = spark.createDataFrame(
        [("r", "p", None, "AA"), ("r", "p", "C1", "BB"), ("r", "p", "", "DD"), ("r", "p", "C2", "DD")],
        "regional string, province string, city string, key_county string")
    texts = spark.createDataFrame([("AA BB",), ("BB AA",), ("DD",), ("C2 BB",), ("AA",), (None,), ("x",)], "place string")
    want = None
    for limit in (0, 1, 2, 5000):
        found = texts.withColumn("text", geo.F.col("place"))
        got = geo.standardise_city(found, "place", geo.Gazetteer.load(counties, limit)).collect()
        got = sorted((str(r.text), r.place) for r in got)
        want = want or got
        assert got == want
    assert dict(want)["AA BB"] is None and dict(want)["BB AA"] == "C1"


def test_dropped_id_tokens_are_reported(spark):
    from listingflow.sources import id_list

    lines = spark.createDataFrame([("1, x2 3",), ("x2 # note",), ("",), (None,)], "value string")
    assert sorted(r.id for r in id_list.parse_lines(lines).collect()) == [1, 3]
    assert [(r.token, r.cnt) for r in id_list.dropped_tokens(lines).collect()] == [("x2", 2)]
