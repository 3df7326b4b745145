"""Keyed merges: customers as target, a changed overlapping set as source; every merge reads both whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from listingflow.operators import ids, merge
from listingflow.operators.relational import differs, missing_from
from listingflow.operators.snapshots import SnapshotTable, overwrite_partitions, touched_partitions, write_preview
from listingflow.operators.store import BucketTable, ManifestTable
from listingflow.plans.base import Change, commit
from listingflow.sources.catalog import Catalog
from listingflow.queries.base import DERIVED, query
from listingflow.session import checkpoint_dir

# target and source hold all customers; a quarter and a third of the keys lie where the other side has none
DERIVED["m_target"] = """SELECT c_custkey + CASE c_custkey % 4 WHEN 0 THEN 100000000 ELSE 0 END AS k, c_name AS name, c_acctbal AS bal,
    c_mktsegment AS seg, c_nationkey AS nation FROM customer"""
DERIVED["m_source"] = """SELECT c_custkey + CASE c_custkey % 3 WHEN 0 THEN 200000000 ELSE 0 END AS k,
    CASE WHEN c_acctbal < 6000 THEN NULL ELSE 'new ' || c_name END AS name, c_acctbal + 1 AS bal FROM customer"""
DERIVED["m_batch"] = """SELECT o_custkey AS k, o_orderpriority AS name, o_totalprice AS bal FROM orders"""

_BOTH = "FROM m_target t FULL JOIN m_source s ON t.k = s.k"


@query("merge_upsert", f"""
    SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.name ELSE t.name END AS name,
        CASE WHEN s.k IS NOT NULL THEN s.bal ELSE t.bal END AS bal,
        CASE WHEN t.k IS NOT NULL THEN t.seg ELSE '-' END AS seg, t.nation {_BOTH}""")
def merge_upsert(t):
    return merge.upsert(t.m_target, t.m_source, ["k"], {"seg": "-"})


@query("merge_replace", f"""
    SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.name ELSE t.name END AS name,
        CASE WHEN s.k IS NOT NULL THEN s.bal ELSE t.bal END AS bal,
        CASE WHEN s.k IS NOT NULL THEN '-' ELSE t.seg END AS seg,
        CASE WHEN s.k IS NOT NULL THEN NULL ELSE t.nation END AS nation {_BOTH}""")
def merge_replace(t):
    return merge.replace_rows(t.m_target, t.m_source, ["k"], {"seg": "-"})


@query("merge_insert_ignore", """
    WITH b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY bal, name) AS rn FROM m_batch)
    SELECT coalesce(t.k, s.k) AS k, CASE WHEN t.k IS NOT NULL THEN t.name ELSE s.name END AS name,
        CASE WHEN t.k IS NOT NULL THEN t.bal ELSE s.bal END AS bal,
        CASE WHEN t.k IS NOT NULL THEN t.seg ELSE '-' END AS seg, t.nation
    FROM m_target t FULL JOIN (SELECT * FROM b WHERE rn = 1) s ON t.k = s.k""")
def merge_insert_ignore(t):
    return merge.insert_ignore(t.m_target, t.m_batch, ["k"], {"seg": "-"}, [F.col("bal"), F.col("name")])


@query("merge_truncate", """
    SELECT k, name, bal FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY name, bal) AS rn FROM m_batch) WHERE rn = 1""")
def merge_truncate(t):
    return merge.truncate_load(t.m_batch, ["k"])


@query("merge_update_from", """
    WITH b AS (SELECT k, min(struct_pack(name := name, bal := bal)) AS v FROM m_batch GROUP BY k)
    SELECT t.k, CASE WHEN v IS NOT NULL AND t.bal > 3000 THEN v.name ELSE t.name END AS name,
        CASE WHEN v IS NOT NULL AND t.bal > 3000 THEN v.bal ELSE t.bal END AS bal, seg, nation
    FROM m_target t LEFT JOIN b ON t.k = b.k""")
def merge_update_from(t):
    return merge.update_from(t.m_target, t.m_batch, ["k"], ["name", "bal"], when=F.col("bal") > 3000)


@query("merge_point_update", """
    SELECT t.k, t.name, CASE WHEN s.k IS NOT NULL AND coalesce(try_cast(s.txt AS DOUBLE) <> t.bal, true)
        THEN try_cast(s.txt AS DOUBLE) ELSE t.bal END AS bal, seg, nation
    FROM m_target t LEFT JOIN (SELECT k, CASE WHEN name IS NULL THEN 'n/a' ELSE CAST(bal AS VARCHAR) END AS txt FROM m_source) s
      ON t.k = s.k""")
def merge_point_update(t):
    target = t.m_target
    new = t.m_source.select("k", F.when(F.col("name").isNull(), "n/a").otherwise(F.col("bal").cast("string")).alias("txt"))
    changed = new.join(target.select("k", F.col("bal").alias("old")), "k").where(differs(F.col("txt"), F.col("old")))
    return merge.update_from(target, changed.select("k", F.col("txt").try_cast("double").alias("bal")), ["k"], ["bal"])


@query("merge_delete", """
    SELECT * FROM m_target WHERE k NOT IN (SELECT k FROM m_source WHERE name IS NULL)""")
def merge_delete(t):
    return merge.delete_matching(t.m_target, t.m_source.where("name IS NULL"), ["k"])


DERIVED["m_ided"] = """SELECT k + 1000 AS id, k, name, bal FROM m_target"""


@query("merge_keep_id", """
    WITH top AS (SELECT max(id) AS m FROM m_ided),
    s AS (SELECT m_source.k, m_source.name, m_source.bal, m_ided.id FROM m_source LEFT JOIN m_ided ON m_source.k = m_ided.k),
    n AS (SELECT k, row_number() OVER (ORDER BY k) AS r FROM s WHERE id IS NULL)
    SELECT coalesce(s.id, m + r) AS id, s.k, s.name, s.bal FROM s LEFT JOIN n ON s.k = n.k, top
    UNION ALL SELECT id, k, name, bal FROM m_ided WHERE k NOT IN (SELECT k FROM m_source)""")
def merge_keep_id(t):
    return merge.upsert_keep_id(t.m_ided, t.m_source, "k")


@query("merge_attach_id", """
    SELECT m_source.k, m_source.name, m_source.bal, m_ided.id FROM m_source LEFT JOIN m_ided ON m_source.k = m_ided.k""")
def merge_attach_id(t):
    return merge.attach_surrogate(t.m_source, t.m_ided, "k")


def fresh_folder(spark) -> str:
    """A new folder next to the session's checkpoints, which every executor reaches."""
    return f"{checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"


@query("merge_snapshot_roundtrip", """
    WITH s AS (SELECT k, name, bal FROM m_source)
    SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.name ELSE t.name END AS name,
        CASE WHEN s.k IS NOT NULL THEN s.bal ELSE t.bal END AS bal, t.seg, t.nation
    FROM m_target t FULL JOIN s ON t.k = s.k""")
def merge_snapshot_roundtrip(t):
    store = SnapshotTable(t.spark, f"{fresh_folder(t.spark)}/table")
    store.commit(t.m_target)
    store.commit(merge.upsert(store.read(), t.m_source, ["k"]))
    return store.read()


@query("merge_partitions", """
    WITH s AS (SELECT k, name, bal, CASE WHEN bal > 8000 THEN 'BUILDING' ELSE 'MOVED' END AS seg, nation
               FROM m_target WHERE seg IN ('FURNITURE', 'BUILDING'))
    SELECT k, name, bal + 1 AS bal, nation, seg FROM s
    UNION ALL SELECT k, name, bal, nation, seg FROM m_target WHERE seg NOT IN ('FURNITURE', 'BUILDING')""")
def merge_partitions(t):
    path = f"{fresh_folder(t.spark)}/table"
    cols = ["k", "name", "bal", "nation", "seg"]
    t.m_target.select(*cols).write.partitionBy("seg").parquet(path)
    target = t.spark.read.parquet(path)
    changes = t.m_target.where("seg IN ('FURNITURE', 'BUILDING')").select(
        "k", "name", (F.col("bal") + 1).alias("bal"), "nation",
        F.when(F.col("bal") > 8000, "BUILDING").otherwise("MOVED").alias("seg"))
    touched = touched_partitions(target, changes, ["k"], ["seg"])
    inside = target.join(touched, "seg", "left_semi").select(*cols)
    merged = merge.upsert(inside, changes, ["k"])
    overwrite_partitions(t.spark, path, merged, touched, ["seg"])
    return t.spark.read.parquet(path)


@query("merge_buckets", f"""
    WITH u AS (SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.name ELSE t.name END AS name,
        CASE WHEN s.k IS NOT NULL THEN s.bal ELSE t.bal END AS bal,
        CASE WHEN t.k IS NOT NULL THEN t.seg ELSE '-' END AS seg, t.nation {_BOTH}),
    b AS (SELECT k, min(struct_pack(name := name, bal := bal)) AS v FROM m_batch GROUP BY k),
    i AS (SELECT k, name, bal, seg, nation FROM u UNION ALL
        SELECT k, v.name, v.bal, '-' AS seg, NULL AS nation FROM b WHERE k NOT IN (SELECT k FROM u)),
    p AS (SELECT i.k, i.name, CASE WHEN b.k IS NOT NULL AND i.seg = '-' THEN b.v.bal ELSE i.bal END AS bal, i.seg, i.nation
        FROM i LEFT JOIN b ON i.k = b.k)
    SELECT * FROM p WHERE k NOT IN (SELECT k FROM m_source WHERE name IS NULL)""")
def merge_buckets(t):
    """Four merges in a row into a table of buckets by key."""
    store = BucketTable.of(t.spark, f"{fresh_folder(t.spark)}/table", t.m_target.schema, ["k"], buckets=8)
    store.load(t.m_target)
    batch = t.m_batch.select(F.col("k").cast("long"), "name", "bal")
    for change in (
        Change("m", t.m_source, ("k",), "upsert", defaults={"seg": "-"}),
        Change("m", batch, ("k",), "insert_ignore", order=(F.col("name"), F.col("bal")), defaults={"seg": "-"}),
        Change("m", batch.groupBy("k").agg(F.min(F.struct("name", "bal"))["bal"].alias("bal")), ("k",), "update", ("bal",), when=F.col("seg") == "-"),
        Change("m", t.m_source.where("name IS NULL"), ("k",), "delete"),
    ):
        store.merge(change)
    return store.read()


@query("merge_buckets_numbered", """
    WITH top AS (SELECT max(id) AS m FROM m_ided),
    s AS (SELECT m_source.k, m_source.name, m_source.bal, m_ided.id FROM m_source LEFT JOIN m_ided ON m_source.k = m_ided.k),
    n AS (SELECT k, row_number() OVER (ORDER BY k) AS r FROM s WHERE id IS NULL)
    SELECT coalesce(s.id, m + r) AS id, s.k, s.name, s.bal FROM s LEFT JOIN n ON s.k = n.k, top
    UNION ALL SELECT id, k, name, bal FROM m_ided WHERE k NOT IN (SELECT k FROM m_source)""")
def merge_buckets_numbered(t):
    """Ids that stay and go on, in a table of buckets whose largest id the manifest keeps."""
    store = BucketTable.of(t.spark, f"{fresh_folder(t.spark)}/table", t.m_ided.schema, ["k"], buckets=8, surrogate="id")
    store.load(t.m_ided)
    commit(Catalog(t.spark), [Change("m", t.m_source, ("k",), "keep_id")], {"m": store})
    return store.read()


@query("merge_manifest", """
    WITH s AS (SELECT k, name, bal, CASE WHEN bal > 8000 THEN 'BUILDING' ELSE 'MOVED' END AS seg, nation
               FROM m_target WHERE seg IN ('FURNITURE', 'BUILDING'))
    SELECT k, name, bal + 1 AS bal, nation, seg FROM s
    UNION ALL SELECT k, name, bal, nation, seg FROM m_target WHERE seg NOT IN ('FURNITURE', 'BUILDING')""")
def merge_manifest(t):
    """Partitions replaced by a new version; the old one stays whole for its readers until it expires."""
    cols = ["k", "name", "bal", "nation", "seg"]
    rows = t.m_target.select(*cols)
    table = ManifestTable(t.spark, f"{fresh_folder(t.spark)}/table", rows.schema, ("seg",))
    table.replace(rows, None, None)
    changes = rows.where("seg IN ('FURNITURE', 'BUILDING')").select(
        "k", "name", (F.col("bal") + 1).alias("bal"), "nation",
        F.when(F.col("bal") > 8000, "BUILDING").otherwise("MOVED").alias("seg"))
    touched = [(r.seg,) for r in touched_partitions(table.read(), changes, ["k"], ["seg"]).collect()]
    table.replace(merge.upsert(table.read(touched), changes, ["k"]), touched, table.manifest())
    table.expire(grace_ms=0)
    return table.read()


@query("dry_run_preview", """
    SELECT CAST(k AS VARCHAR) AS k, 'new' AS kind FROM m_source WHERE k NOT IN (SELECT k FROM m_target)
    UNION ALL
    SELECT CAST(s.k AS VARCHAR) AS k, 'changed' AS kind FROM m_source s JOIN m_target t ON s.k = t.k WHERE s.bal <> t.bal""")
def dry_run_preview(t):
    target, source = t.m_target, t.m_source
    new = missing_from(source, target, ["k"]).select("k", F.lit("new").alias("kind"))
    moved = source.join(target.select("k", F.col("bal").alias("old")), "k").where(differs(F.col("bal"), F.col("old")))
    folder = f"{fresh_folder(t.spark)}/preview"
    write_preview(new.unionByName(moved.select("k", F.lit("changed").alias("kind"))), folder)
    return t.spark.read.schema("k string, kind string").option("header", True).csv(folder)


# every part is new; a type has the codes of all its parts, but for one type that has none yet
DERIVED["a_new"] = "SELECT p_partkey, p_type, p_name FROM part"
DERIVED["a_known"] = """SELECT CASE p_type WHEN 'PROMO' THEN 'OTHER' ELSE p_type END AS p_type,
    p_type || 'S' || CAST(p_size AS STRING) AS code FROM part"""


@query("allocate_ids", """
    WITH top AS (SELECT p_type, max(CAST(regexp_extract(code, '([0-9]+)$', 1) AS BIGINT)) AS m FROM a_known GROUP BY p_type)
    SELECT p_partkey, a.p_type, p_name, a.p_type || 'S' || CAST(coalesce(m, 0)
        + dense_rank() OVER (PARTITION BY a.p_type ORDER BY p_name) AS VARCHAR) AS code
    FROM a_new a LEFT JOIN top ON a.p_type = top.p_type""")
def allocate_ids(t):
    return ids.allocate(t.a_new, t.a_known, "p_type", "p_name", "code", "S")
