"""Tables behind a manifest: untouched folders, versions, conflicts, expiry, one evaluation of a change."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.operators import merge
from listingflow.operators.store import BUCKET, BucketTable, Conflict, ManifestTable, buckets_for, drop_staged, staged
from listingflow.plans.base import Change, commit
from listingflow.sources.catalog import Catalog

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("w", T.StringType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def data(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root, "data").rglob("part-*")}


@pytest.fixture
def table(spark, tmp_path):
    t = BucketTable.of(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=8)
    t.load(spark.createDataFrame([(i, f"v{i}", "x") for i in range(200)], SCHEMA))
    return t


def test_untouched_buckets_keep_their_files_and_are_not_scanned(spark, table):
    before, old = data(table.root), table.manifest()
    change = Change("t", spark.createDataFrame([(3, "new"), (900, "n")], "k int, v string"), ("k",), defaults={"w": "-"})
    touched = table.touched(change.rows)
    assert 1 <= len(touched) <= 2
    plan = table.read(touched)
    scanned = {f.split("/data/")[1].rsplit("/", 1)[0] for f in plan.inputFiles()}
    assert scanned == {old.folders[c] for c in touched}
    new = table.merge(change)
    assert {c: f for c, f in new.folders.items() if c not in touched} == {c: f for c, f in old.folders.items() if c not in touched}
    assert before.items() <= data(table.root).items()
    got = {r.k: (r.v, r.w) for r in table.read().collect()}
    assert got[3] == ("new", "x") and got[900] == ("n", "-") and got[4] == ("v4", "x") and len(got) == 201
    assert sum(new.rows.values()) == 201


@pytest.mark.parametrize("mode", ["upsert", "replace", "insert_ignore", "update", "delete", "truncate"])
def test_every_mode_agrees_with_the_merge_of_the_whole_table(spark, table, mode):
    rng = random.Random(mode)
    source = spark.createDataFrame([(k, rng.choice(["a", None])) for k in rng.sample(range(300), 60)], "k int, v string")
    change = Change("t", source, ("k",), mode, columns=("v",), defaults={"w": "-"})
    whole = table.read()
    want = rows((change.apply(whole) if mode != "truncate" else source.withColumn("w", F.lit(None))).select("k", "v", "w"))
    if mode == "truncate":
        change = Change("t", source.withColumn("w", F.lit(None).cast("string")), ("k",), mode)
    table.merge(change)
    assert rows(table.read()) == want


def test_a_change_by_other_columns_reaches_every_bucket(spark, table):
    table.merge(Change("t", spark.createDataFrame([("x",)], "w string"), ("w",), "delete"))
    assert table.read().count() == 0 and table.manifest().folders == {}


def test_numbers_go_on_from_the_largest_of_the_whole_table(spark, tmp_path):
    schema = T.StructType.fromDDL("id long, name string, v string")
    t = BucketTable.of(spark, str(tmp_path / "t"), schema, ["name"], buckets=4, surrogate="id")
    t.load(spark.createDataFrame([(i + 1, f"n{i}", "old") for i in range(30)], schema))
    t.merge(Change("t", spark.createDataFrame([("n4", "new"), ("m1", "new"), ("m0", "new")], "name string, v string"), ("name",), "keep_id"))
    t.merge(Change("t", spark.createDataFrame([("m1", "no"), ("m2", "new")], "name string, v string"), ("name",), "insert_numbered"))
    got = {r.name: (r.id, r.v) for r in t.read().collect()}
    assert got["n4"] == (5, "new") and got["m0"] == (31, "new") and got["m1"] == (32, "new") and got["m2"] == (33, "new")
    assert t.manifest().marks == {"id": 33} and len(got) == 33


def test_an_empty_change_writes_nothing_and_null_keys_have_a_bucket(spark, table):
    assert table.merge(Change("t", spark.createDataFrame([], "k long, v string"), ("k",))) is None
    assert table.versions() == [1]
    table.merge(Change("t", spark.createDataFrame([(None, "nothing")], "k long, v string"), ("k",)))
    assert [(r.v, r.w) for r in table.read().where("k IS NULL").collect()] == [("nothing", None)]


def test_a_reader_sees_one_version_whole_and_the_second_writer_starts_again(spark, table):
    old = table.manifest()
    reader = table.read()
    upsert = lambda k: Change("t", spark.createDataFrame([(k, "w")], "k long, v string"), ("k",))
    table.merge(upsert(1000))
    assert reader.count() == 200  # planned before, read after
    some = table.read().limit(1)
    with pytest.raises(Conflict):
        table.replace(some.withColumn(BUCKET, table.bucket(some)), [("0",)], old)
    assert table.read().count() == 201
    # a writer that finds its version taken merges into what the other one wrote
    stale = [old]
    real = BucketTable.manifest
    try:
        BucketTable.manifest = lambda self, version=None: stale.pop() if stale and version is None else real(self, version)
        table.merge(upsert(1001))
    finally:
        BucketTable.manifest = real
    assert {1000, 1001} <= {r.k for r in table.read().collect()} and table.versions() == [1, 2, 3]


def test_a_write_that_stops_before_the_switch_leaves_the_old_table(spark, table, monkeypatch):
    monkeypatch.setattr(BucketTable, "publish", lambda self, new: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        table.merge(Change("t", spark.createDataFrame([(1, "half")], "k long, v string"), ("k",)))
    monkeypatch.undo()
    assert rows(table.read()) == rows(spark.createDataFrame([(i, f"v{i}", "x") for i in range(200)], SCHEMA))
    left = len(data(table.root))
    time.sleep(0.01)
    table.expire(grace_ms=0, now_ms=int(time.time() * 1000) + 60_000)
    assert len(data(table.root)) < left and table.read().count() == 200


def test_old_versions_expire_after_the_grace_period_only(spark, table):
    for n in range(3):
        table.merge(Change("t", spark.createDataFrame([(n, f"r{n}")], "k long, v string"), ("k",)))
    assert table.expire(grace_ms=3_600_000) == [] and table.read(version=1).count() == 200
    now = rows(table.read())
    gone = table.expire(grace_ms=0, now_ms=int(time.time() * 1000) + 60_000)
    assert len([g for g in gone if g.startswith("manifests/")]) == 3 and table.versions() == [4]
    assert rows(table.read()) == now
    assert {f.rsplit("/", 1)[0].removeprefix("data/") for f in data(table.root)} == set(table.manifest().folders.values())


def test_partitions_with_nulls_and_odd_names_are_replaced_and_removed(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, p string, q int")
    t = ManifestTable(spark, str(tmp_path / "t"), schema, ("p", "q"))
    first = [(1, "a/b", 1), (2, None, 1), (3, "c d=%", None), (4, "plain", 7)]
    t.replace(spark.createDataFrame(first, schema), None, None)
    assert rows(t.read()) == sorted(first, key=str)
    assert rows(t.read([("a/b", "1"), (None, "1")])) == [(1, "a/b", 1), (2, None, 1)]
    t.replace(spark.createDataFrame([(5, "c d=%", None)], schema), [(None, "1"), ("c d=%", None)], t.manifest())
    assert rows(t.read()) == sorted([(1, "a/b", 1), (5, "c d=%", None), (4, "plain", 7)], key=str)
    assert set(t.manifest().folders) == {("a/b", "1"), ("c d=%", None), ("plain", "7")}


def test_an_empty_table_has_its_columns(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path / "t"), SCHEMA, ("w",))
    assert t.manifest() is None and t.read().schema == SCHEMA and t.read().count() == 0
    assert t.expire(0) == []


def test_a_commit_evaluates_its_rows_once(spark, table):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(k):
        seen.add(1)
        return k

    source = spark.range(50).select(counted(F.col("id")).alias("k"), F.lit("c").alias("v"))
    commit(Catalog(spark), [Change("t", source, ("k",))], {"t": table})
    assert seen.value == 50
    assert table.read().where("v = 'c'").count() == 50


def test_staged_rows_are_observed_as_they_are_written_and_go(spark):
    copy, seen = staged(spark.range(10), "x", F.max("id").alias("top"))
    assert seen == {"n": 10, "top": 9} and copy.count() == 10
    folder = Path(copy.inputFiles()[0].removeprefix("file://")).parent
    drop_staged(copy)
    assert not folder.exists()


def test_merges_in_any_order_of_buckets_agree(spark, tmp_path):
    for n in (1, 3, 32):
        t = BucketTable.of(spark, str(tmp_path / f"t{n}"), SCHEMA, ["k"], buckets=n)
        t.load(spark.createDataFrame([(i, "a", "x") for i in range(50)], SCHEMA))
        src = spark.createDataFrame([(i, "b") for i in range(40, 60)], "k long, v string")
        t.merge(Change("t", src, ("k",)))
        assert rows(t.read()) == rows(merge.upsert(spark.createDataFrame([(i, "a", "x") for i in range(50)], SCHEMA), src, ["k"]))
    assert buckets_for(0) == 1 and buckets_for((256 << 20) + 1) == 2
