"""What the plans look like, and that skew handling changes no result."""

import contextlib

import pytest
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.operators import dedupe, match, merge
from listingflow.operators.skew import broadcast_lookup_join, lookup_join
from listingflow.queries import registry
from conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_latest_keeps_one_row_per_key_before_the_shuffle(tables):
    plan = plan_of(dedupe.latest_by(tables.events, ["user_id"], "ts", [F.col("event_id")]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_only_unique_needs_one_shuffle_and_no_join(tables):
    plan = plan_of(dedupe.only_unique(tables.orders, ["o_custkey"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(registry()["incremental_since"].run(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan and "props" not in plan.split("ReadSchema")[1]
    after = plan_of(registry()["incremental_after_day"].run(spark, SF))
    assert "GreaterThanOrEqual(ts" in after


def skewed(spark):
    rows = spark.range(40_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 500).alias("k"),
        F.repeat(F.lit("x"), 40).alias("pad"))
    lookup = spark.range(500).select(F.col("id").alias("k"), F.lit("n").alias("name")).groupBy("k").agg(F.max("name").alias("name"))
    return rows, lookup


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


def test_hot_lookup_key_is_split_at_run_time(spark):
    rows, lookup = skewed(spark)
    with settings(spark, **SPLIT, **{"spark.sql.shuffle.partitions": "8"}):
        joined = lookup_join(rows, lookup, ["k"], "left")
        assert joined.count() == 40_000
        assert joined.where("name IS NULL").count() == 13_333
        joined = lookup_join(rows, lookup, ["k"], "left")
        joined.collect()
        assert "skew=true" in plan_of(joined)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_and_broadcast_lookups_agree(spark, how):
    rows, lookup = skewed(spark)
    want = rows.join(lookup, "k", how).agg(F.count("*"), F.count("name"), F.sum("id")).first()
    for got in (lookup_join(rows, lookup, ["k"], how, salts=8), lookup_join(rows, lookup, ["k"], how),
                broadcast_lookup_join(rows, lookup, ["k"], how), broadcast_lookup_join(rows, lookup, ["k"], how, max_rows=10),
                    broadcast_lookup_join(rows, lookup, ["k"], how, max_bytes=10)):
        assert got.agg(F.count("*"), F.count("name"), F.sum("id")).first() == want
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):
        assert "explode" in plan_of(lookup_join(rows, lookup, ["k"], how))


def test_group_size_on_a_hot_key(spark):
    rows, _ = skewed(spark)
    got = dedupe.group_size_and_min(rows.where("k IS NOT NULL"), ["k"], "id")
    zeros = sum(1 for i in range(40_000) if i % 3 == 0 or (i % 3 == 2 and i % 500 == 0))
    assert got.where("k = 0").agg(F.min("group_size"), F.count("*"), F.sum("is_min")).first() == (zeros, zeros, 1)


def test_upsert_shuffles_each_side_once(spark, tables):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(merge.upsert(tables.m_target, tables.m_source, ["k"]))
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_cascade_deals_the_standard_list_and_broadcasts_no_probes(spark):
    def models(n, name):
        return match.features(spark.range(0, n, 1, 1).select(
            F.col("id").alias("car_id"), F.concat(F.lit(name), F.col("id") % 3).alias("brand_name"), F.lit(2020).alias("model_year")))

    plat, std = models(30, "a"), models(12, "a")
    found = match.cascade(plat, std)
    plan = plan_of(found)
    # one scan task becomes several before each model is a row for each key set, and small files tell nothing of their probes
    assert "REPARTITION_BY_NUM" in plan and "BroadcastHashJoin" not in plan
    assert {(r["round"], r.candidates, r.match_des) for r in found.collect()} == {(0, 4, "repeat")} and found.count() == 30
    tasks = match._dealt(models(4000, "b"), []).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 8 and max(r["count"] for r in tasks) < 1000


def test_a_wider_cluster_deals_the_standard_list_to_more_tasks(spark):
    def tasks():
        models = spark.range(0, 9000, 1, 1).select(
            F.col("id").cast("string").alias("car_id"), *[(F.col("id") % 50).alias(f) for f in V.MATCH_FIELDS])
        return match._dealt(models, []).groupBy(F.spark_partition_id()).count().count()

    few = match.CORE_TASKS * spark.sparkContext.defaultParallelism
    assert tasks() <= few  # a narrow setting does not narrow it
    with settings(spark, **{"spark.sql.shuffle.partitions": str(4 * few)}):
        assert tasks() > 2 * few


def test_a_platform_list_is_dealt_before_each_model_is_a_row_for_each_key_set(spark):
    def models(n, name):
        return match.features(spark.range(0, n, 1, 1).select(
            F.col("id").alias("car_id"), F.lit(name).alias("brand_name"), F.lit("s").alias("series_name"), F.lit(2020).alias("model_year")))

    # one scan task and one brand and series: what is exploded still comes from many tasks
    sets = match._key_sets(False)
    probes = match._platform_probes(models(4000, "a"), sets, [])
    tasks = [r["count"] for r in probes.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 4000 * len(sets) and max(tasks) < sum(tasks) / 8
    found = match.cascade(models(4000, "a"), models(3, "a"))
    assert plan_of(found).count("REPARTITION_BY_NUM") == 2
    assert found.groupBy("round", "candidates", "match_des").count().collect() == [(0, 3, "repeat", 4000)]


CASCADES = ["cascade_post_filter", "cascade_resolve", "fold_platforms"]


@pytest.mark.parametrize("name", CASCADES)
def test_both_lists_of_a_cascade_are_dealt(spark, name):
    assert plan_of(registry()[name].run(spark, SF)).count("REPARTITION_BY_NUM") == 2


SAMPLE = ["listing_slice", "geo_listing_county", "cascade_match", "job_listing_guazi", "job_listing_rrc", "job_config_wide",
          "job_paid_prices_b", "merge_upsert", "multi_key_join", "high_water_mark"]


@pytest.mark.parametrize("name", SAMPLE)
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    plan = plan_of(registry()[name].run(spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, REPARTITION"):
        assert bad not in plan


def test_a_text_that_many_rows_share_is_not_looked_up_in_one_task(spark):
    from listingflow.functions import geo

    # few bytes for each row: run-time splitting by size does not see them
    text = F.when(F.col("id") % 4 == 0, "nowhere").when(F.col("id") % 4 == 1, None).when(F.col("id") % 4 == 2, "in Aa").otherwise(
        F.concat(F.lit("t"), F.col("id") % 300, F.lit(" Bbb")))
    rows = spark.range(0, 40_000, 1, 4).select("id", text.alias("t"))
    words = spark.createDataFrame([("Aa",), ("Bbb",)], "w string")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                            "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = geo.first_word_by_join(rows, "t", "hit", words, "w").withColumn("task", F.spark_partition_id())
        tasks = [r["count"] for r in found.groupBy("task").count().collect()]
        got = {(r.t[-3:] if r.t else None, r.hit): r["count"] for r in found.groupBy("hit", F.substring("t", -3, 3).alias("t")).count().collect()}
    assert sum(tasks) == 40_000 and max(tasks) < 5_000
    assert got == {("ere", None): 10_000, (None, None): 10_000, (" Aa", "Aa"): 10_000, ("Bbb", "Bbb"): 10_000}
