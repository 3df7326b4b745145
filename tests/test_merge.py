"""Merge semantics and properties."""

import time

import pytest
from pyspark.sql import functions as F

from listingflow.operators import merge
from listingflow.operators.snapshots import SnapshotTable, overwrite_partitions, touched_partitions


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")


def test_upsert_keeps_and_replace_resets_unlisted_columns(spark, target):
    src = spark.createDataFrame([(1, "b"), (3, None)], "k int, v string")
    assert rows(merge.upsert(target, src, ["k"], {"w": "-"})) == [(1, "b", "x"), (2, "b", "y"), (3, None, "-")]
    assert rows(merge.replace_rows(target, src, ["k"], {"w": "-"})) == [(1, "b", "-"), (2, "b", "y"), (3, None, "-")]


def test_null_source_value_is_a_real_update(spark, target):
    src = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(merge.upsert(target, src, ["k"])) == [(1, None, "x"), (2, "b", "y")]


def test_merges_are_idempotent_and_order_free(spark, target):
    src = spark.createDataFrame([(i, f"n{i}") for i in range(2, 9)], "k int, v string")
    for op in (merge.upsert, merge.replace_rows, merge.insert_ignore):
        once = op(target, src, ["k"])
        assert rows(op(once, src, ["k"])) == rows(once)
        assert rows(op(target.repartition(3), src.repartition(5), ["k"])) == rows(once)


def test_duplicate_source_keys(spark, target):
    src = spark.createDataFrame([(1, "z"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="duplicate merge key"):
        merge.upsert(target, src, ["k"]).collect()
    first = merge.upsert(target, src, ["k"], on_duplicate="first", order=[F.col("v").desc()])
    assert (1, "z", "x") in rows(first)
    assert (3, "c", None) in rows(merge.insert_ignore(
        target, src.withColumn("k", F.lit(3)), ["k"], order=[F.col("v")]))


def test_update_from_takes_smallest_row_and_respects_condition(spark, target):
    src = spark.createDataFrame([(1, "q"), (1, "p"), (2, "r"), (9, "s")], "k int, v string")
    assert rows(merge.update_from(target, src, ["k"], ["v"])) == [(1, "p", "x"), (2, "r", "y")]
    assert rows(merge.update_from(target, src, ["k"], ["v"], when=F.col("w") == "y")) == [(1, "a", "x"), (2, "r", "y")]


def test_delete_and_truncate(spark, target):
    assert rows(merge.delete_matching(target, target.where("k = 1"), ["k"])) == [(2, "b", "y")]
    src = spark.createDataFrame([(1, "z"), (1, "c")], "k int, v string")
    assert rows(merge.truncate_load(src, ["k"])) == [(1, "c")]


def test_keep_id(spark):
    target = spark.createDataFrame([(7, 100, "old", "x"), (9, 200, "old", "y")], "id long, nat long, v string, w string")
    src = spark.createDataFrame([(200, "new"), (50, "n1"), (70, "n2")], "nat long, v string")
    got = merge.upsert_keep_id(target, src, "nat")
    assert rows(got) == [(10, 50, "n1", None), (11, 70, "n2", None), (7, 100, "old", "x"), (9, 200, "new", None)]
    assert rows(merge.upsert_keep_id(got, src, "nat"), "id", "nat") == rows(got, "id", "nat")
    ignored = merge.insert_ignore_numbered(target, src, "nat")
    assert rows(ignored) == [(10, 50, "n1", None), (11, 70, "n2", None), (7, 100, "old", "x"), (9, 200, "old", "y")]


def test_snapshot_survives_a_failed_write(spark, tmp_path, target):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.commit(target)
    broken = target.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="boom"):
        store.commit(broken)
    assert rows(store.read()) == rows(target)
    store.commit(merge.upsert(store.read(), spark.createDataFrame([(2, "c")], "k int, v string"), ["k"]))
    assert (2, "c", "y") in rows(store.read())


def test_partition_overwrite_moves_rows_and_drops_empty_partitions(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.createDataFrame([(1, "a", "p"), (2, "b", "q"), (3, "c", "r")], "k int, v string, part string").write.partitionBy("part").parquet(path)
    target = spark.read.parquet(path).select("k", "v", "part")
    changes = spark.createDataFrame([(1, "A", "q"), (4, "d", "s")], "k int, v string, part string")
    touched = touched_partitions(target, changes, ["k"], ["part"])
    assert rows(touched) == [("p",), ("q",), ("s",)]
    inside = target.join(touched, "part", "left_semi").select("k", "v", "part")
    overwrite_partitions(spark, path, merge.upsert(inside, changes, ["k"]), touched, ["part"])
    assert rows(spark.read.parquet(path), "k", "v", "part") == [(1, "A", "q"), (2, "b", "q"), (3, "c", "r"), (4, "d", "s")]
    assert not (tmp_path / "wide" / "part=p").exists()


def test_replaced_and_abandoned_snapshots_expire(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    for n in range(3):
        store.commit(spark.range(n + 1))
    (tmp_path / "t" / "snapshot-00000002" / "_SUCCESS").unlink()  # a write that was given up
    assert store.expire(grace_ms=3_600_000) == [] and store.read().count() == 3
    later = int(time.time() * 1000) + 60_000
    assert [p[-1] for p in store.expire(0, later)] == ["1", "2"]
    assert store.read().count() == 3 and store.expire(0, later) == []
