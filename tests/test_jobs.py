"""Whole jobs: plan, preview, commit, run again."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow import schemas as S
from listingflow.operators.journal import Journal
from listingflow.operators.snapshots import SnapshotTable
from listingflow.plans import base, catalogue_ids, catalogue_to_ods, listings, ods_to_production, platform_match, resync, side_data
from listingflow.queries.job_queries import CATALOGUE_RUN, SIDE_RUN, match_catalog, place_catalog, standard_catalog, vehicle_catalog
from listingflow.queries.listing_queries import RUN, listing_catalog
from listingflow.session import cut_lineage
from listingflow.sources.catalog import Catalog


class Stores(dict):
    def __init__(self, spark, root):
        super().__init__()
        self.spark, self.root = spark, root

    def __missing__(self, name):
        self[name] = SnapshotTable(self.spark, f"{self.root}/{name}")
        return self[name]


def content(df):
    return sorted(map(tuple, df.select(*[F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]).collect()), key=str)


SOURCES = ("src_model_master", "src_model_detail", "src_model_ev", "src_color")


@pytest.fixture(scope="module")
def stored_sources(tables, tmp_path_factory):
    """The vehicle source tables as files, so that no test derives them again."""
    root, full = tmp_path_factory.mktemp("sources"), vehicle_catalog(tables)
    for name in SOURCES:
        full.read(name).write.parquet(str(root / name))
    return root


def source_only(spark, root):
    cat = Catalog(spark)
    for name in SOURCES:
        cat.bind_path(name, str(root / name))
    return cat


def test_catalogue_and_production_from_nothing(spark, stored_sources, tmp_path):
    cat, stores = source_only(spark, stored_sources), Stores(spark, str(tmp_path))
    # a run date that takes in every source row
    base.run_steps(cat, catalogue_to_ods.steps("2024-01-02"), stores, catalogue_to_ods.SCHEMAS)
    names = list(catalogue_to_ods.SCHEMAS)
    before = {n: content(cat.read(n)) for n in names}
    assert all(before.values())
    for n, schema in catalogue_to_ods.SCHEMAS.items():
        keys = S.keys_of(schema)
        assert cat.read(n).groupBy(*keys).count().where("count > 1").isEmpty()
        assert [(f.name, f.dataType) for f in cat.read(n).schema.fields] == [(f.name, f.dataType) for f in schema.fields]
    # the same run again changes nothing
    base.commit(cat, catalogue_to_ods.plan(cat, "2024-01-02"), stores, catalogue_to_ods.SCHEMAS)
    assert {n: content(cat.read(n)) for n in names} == before

    base.run_steps(cat, ods_to_production.steps(), stores, ods_to_production.SCHEMAS)
    config = cat.read("prod_config")
    n = config.count()
    assert n == cat.read("ods_model_master").join(
        cat.read("ods_model_detail"), F.col("model_id") == F.col("autohome_id"), "left_semi").count()
    # ids count up from 1 without gaps, in the order of the natural key
    ids = [r.id for r in config.orderBy("autohome_id").select("id").collect()]
    assert ids == list(range(1, n + 1))
    assert cat.read("prod_config_ev").join(config, "id", "left_anti").isEmpty()
    assert not cat.read("prod_config_ev").isEmpty()


def test_resync_overwrites_in_place_and_refuses_hand_made_ids(spark, stored_sources, tmp_path):
    cat, stores = source_only(spark, stored_sources), Stores(spark, str(tmp_path))
    base.run_steps(cat, catalogue_to_ods.steps("2024-01-02"), stores, resync.SCHEMAS)
    base.run_steps(cat, ods_to_production.steps(), stores, resync.SCHEMAS)
    old = {r.autohome_id: (r.id, r.is_selling) for r in cat.read("prod_config").collect()}
    chosen = sorted(old)[:3]
    # the crawl was repaired: chosen models have another status now, others too but are not asked for
    fixed = cat.read("src_model_master").withColumn("status", F.lit("停售"))
    cat.bind_frame("src_model_master", fixed)
    ids = spark.createDataFrame([(i,) for i in [*chosen, V.MANUAL_ID_THRESHOLD + 5, 10**8]], "id long")
    plan = resync.prepare(cat, ids)
    assert [r.id for r in plan.refused.collect()] == [V.MANUAL_ID_THRESHOLD + 5]
    assert [tuple(r) for r in plan.unusable.collect()] == [(10**8, "unknown model")]
    # the dry run already shows stage two on repaired rows, and writes nothing
    changes = plan.plan(cat)
    config = [c for c in changes if c.table == "prod_config"]
    # the last change reads the copies of planned tables, none of the first stage's sources
    read = {f.split("/")[-2].rsplit("-", 1)[0] for f in changes[-1].rows.inputFiles()}
    assert read == {"planned-table"}
    folders = base.preview(config, str(tmp_path / "preview"))
    shown = spark.read.option("header", True).csv(folders[0])
    assert {r.is_selling for r in shown.collect()} == {"停售"} and shown.count() == 3
    assert {r.autohome_id: (r.id, r.is_selling) for r in cat.read("prod_config").collect()} == old
    plan.run(cat, stores)
    new = {r.autohome_id: (r.id, r.is_selling) for r in cat.read("prod_config").collect()}
    assert new == {k: (v[0], "停售" if k in chosen else v[1]) for k, v in old.items()}
    with pytest.raises(ValueError):
        resync.prepare(cat, ids.where(F.col("id") > V.MANUAL_ID_THRESHOLD))


def test_standard_ids_are_stable_and_unique(spark, tables, tmp_path):
    cat, stores = standard_catalog(tables), Stores(spark, str(tmp_path))
    cat.bind_frame("catalogue_major", catalogue_ids.wide_rows(cat))
    known = {r.model_id: r.std_modelid for r in cat.read("std_model").collect()}
    base.run_steps(cat, catalogue_ids.steps(), stores)
    after = {r.model_id: r.std_modelid for r in cat.read("std_model").collect()}
    assert known.items() <= after.items()
    assert len(set(after.values())) == len(after)
    assert cat.read("std_series").where("car_level = '无'").isEmpty()
    assert cat.read("catalogue_major").count() == len(after)
    # a second run finds nothing new
    assert all(step(cat).rows.isEmpty() for step in catalogue_ids.steps()[:4])


@pytest.mark.parametrize("platform", ["che58", "yiche"])
def test_listing_run_is_idempotent(spark, tables, platform):
    cat = listing_catalog(tables)
    cat.bind_frame("listing_wide", spark.createDataFrame([], S.LISTING_WIDE))
    rows = listings.wide_rows(cat, platform, RUN)
    assert not rows.isEmpty()
    assert rows.columns == list(V.LISTING_COLUMNS)
    change = listings.plan(cat, platform, RUN)[-1]
    once = change.apply(cat.read("listing_wide"))
    assert content(change.apply(once)) == content(once)


def test_wide_table_rewrites_only_touched_months(spark, tables, tmp_path):
    cat, path = listing_catalog(tables), str(tmp_path / "wide")
    cat.bind_frame("listing_wide", spark.createDataFrame([], S.LISTING_WIDE))
    rows = listings.wide_rows(cat, "che58", RUN)
    listings.commit_wide(listings.wide_table(spark, path), "che58", rows)
    # other platforms and months that no change touches stay as they are
    other = rows.withColumn("car_platform", F.lit("rrc"))
    listings.commit_wide(listings.wide_table(spark, path), "rrc", other)
    months = sorted(r.partition_month for r in rows.select("partition_month").distinct().collect())
    stamp = {f: f.stat().st_mtime_ns for f in (tmp_path / "wide").rglob("*.parquet")}
    moved = rows.where(F.col("partition_month") == months[0]).withColumns(
        {"partition_month": F.lit("209901"), "quotes": F.lit(1.0)})
    last = rows.where(F.col("partition_month") == months[-1]).select(F.col("id_data_input").alias("id"))
    listings.commit_wide(listings.wide_table(spark, path), "che58", moved, last)
    wide = listings.wide_table(spark, path).read()
    mine = wide.where("car_platform = 'che58'")
    assert mine.where("quotes = 1.0").count() == moved.count() == mine.where("partition_month = '209901'").count()
    assert mine.where(F.col("partition_month").isin(months[0], months[-1])).isEmpty()
    assert mine.count() == rows.count() - last.count()
    assert wide.where("car_platform = 'rrc'").count() == rows.count()
    kept = [f for f in stamp if f"={months[0]}" not in str(f) and f"={months[-1]}" not in str(f) or "rrc" in str(f)]
    assert kept and all(f.stat().st_mtime_ns == stamp[f] for f in kept)


def test_superseded_listings_leave_source_and_wide_table(spark, tables):
    cat = listing_catalog(tables)
    changes = listings.plan(cat, "che58", RUN)
    assert [(c.table, c.mode) for c in changes] == [
        ("listing_wide", "delete"), ("listing_che58", "delete"), ("listing_wide", "upsert")]
    source = cat.read("listing_che58")
    gone = changes[1].rows
    assert changes[1].apply(source).count() == source.join(gone, "id", "left_anti").count()


def test_unmatched_platform_and_history_win(spark, tables):
    rows = cut_lineage(platform_match.plan(match_catalog(tables, ["yiche"]))[0].rows)
    assert set(rows.columns) == {f.name for f in S.MATCH_RESULT.fields}
    assert rows.count() == tables.x_std.count()
    kept = tables.y_history.where("match_type_yiche = 1").select("id_che300", F.col("id_yiche").alias("was"))
    assert rows.join(kept, "id_che300").where("id_yiche <> was").isEmpty()
    # a platform without a table keeps what was decided and finds nothing
    souhu = {r.id_che300: r.id_souhu for r in rows.select("id_che300", "id_souhu").collect()}
    past = {r.id_che300: r.id_souhu for r in tables.y_history.where("match_type_souhu = 1").collect()}
    assert {k: v for k, v in souhu.items() if v != "0"} == past


def test_without_history_and_tables_every_gap_is_filled(spark, tables):
    cat = match_catalog(tables, ["czb"])
    alone = Catalog(spark).bind("match_standard", lambda: tables.x_std).bind("catalogue_major", lambda: tables.s_wide)
    rows = platform_match.result_rows(alone, ["czb", "souhu"])
    assert rows.count() == tables.x_std.count() and rows.where("id_czb <> '0' OR match_type_souhu <> 0").isEmpty()
    alone.bind("match_platform_czb", lambda: cat.read("match_platform_czb"))
    assert platform_match.result_rows(alone, ["czb"]).where("match_type_czb = 1").count() > 0


def test_scans_of_history_and_standard_list_do_not_grow_with_platforms(tables):
    def scans(platforms, table):
        marked = getattr(tables, table)
        cat = match_catalog(tables, platforms)
        # a name that only this table has marks its scans
        cat.bind_frame({"y_history": "match_history", "x_std": "match_standard"}[table], tables.spark.createDataFrame(marked.limit(5).collect(), marked.schema))
        return str(platform_match.result_rows(cat, platforms)._jdf.queryExecution().optimizedPlan().toString()).count("LogicalRDD")
    for table in ("y_history", "x_std"):
        assert scans(list(V.MATCH_PLATFORMS), table) == scans(list(V.MATCH_PLATFORMS[:2]), table) > 0


def test_side_jobs_plan_by_name(tables):
    every = {"src_complaint_1": "d_complaint", "src_complaint_2": "d_complaint", "src_complaint_3": "d_complaint",
             "src_complaint_4": "d_complaint", "src_complaint_owner": "d_owner", "src_quote": "d_quote", "src_sales_a": "d_sales",
             "src_sales_b": "d_sales", "src_series_brand": "d_series_brand", "src_review": "d_review", "src_model_master": "j_master",
             "src_dealer_1": "d_dealer", "src_dealer_2": "d_dealer", "src_dealer_3": "d_dealer", "src_paid_a": "d_paid_a", "src_paid_b": "d_paid_b"}
    cat = place_catalog(tables, **every)
    tables_written = [c.table for job in side_data.JOBS.values() for c in job(cat, SIDE_RUN)]
    assert len(tables_written) == len(set(tables_written)) == 14


def test_preview_lists_new_and_moved(tables):
    found = resync.change_preview(vehicle_catalog(tables))
    assert set(found) == {"brand", "series", "config", "price_update"}
    assert not found["price_update"].isEmpty()
    assert CATALOGUE_RUN > "2024"


def test_listings_without_a_month_survive_later_writes(spark, tables, tmp_path):
    cat, path = listing_catalog(tables), str(tmp_path / "wide")
    rows = listings.wide_rows(cat, "guazi", RUN).limit(4).withColumn("n", F.row_number().over(Window.orderBy("id_data_input")))
    rows = cut_lineage(rows)
    month = F.when(F.col("n") > 2, "202401")
    first = rows.where("n <> 2").withColumn("partition_month", month).drop("n")
    later = rows.where("n = 2").withColumn("partition_month", month).drop("n")
    listings.commit_wide(listings.wide_table(spark, path), "guazi", first.unionByName(first))
    listings.commit_wide(listings.wide_table(spark, path), "guazi", later.unionByName(later))
    wide = listings.wide_table(spark, path).read()
    assert sorted(r.id_data_input for r in wide.collect()) == sorted(r.id_data_input for r in rows.collect())
    assert not [p for p in tmp_path.iterdir() if "staged" in p.name]


def test_old_null_partitions_and_odd_names_are_merged_and_emptied(spark, tmp_path):
    from listingflow.operators import merge
    from listingflow.operators.snapshots import overwrite_partitions

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a/b"), (2, None), (3, "c")], "k long, part string").write.partitionBy("part").parquet(path)
    inside = spark.read.schema("k long, part string").parquet(path).where("part IS NULL OR part = 'a/b'")
    moved = spark.createDataFrame([(1, "d"), (2, "d")], "k long, part string")
    touched = spark.createDataFrame([("a/b",), (None,), ("d",)], "part string")
    overwrite_partitions(spark, path, merge.upsert(inside, moved, ["k"]), touched, ["part"])
    got = spark.read.schema("k long, part string").parquet(path).collect()
    assert sorted((r.k, r.part) for r in got) == [(1, "d"), (2, "d"), (3, "c")]


def test_junk_ids_and_prices_are_left_out_and_reported(spark, tables):
    cat = listing_catalog(tables)
    junk = tables.l_market.withColumns({
        "price": F.when(F.col("id") % 50 == 3, "面议").otherwise(F.col("price").cast("string")),
        "mile": F.when(F.col("id") % 50 == 4, "x").otherwise(F.col("mile").cast("string")),
        "car_id": F.when(F.col("id") % 50 == 5, "x1").otherwise(F.col("car_id").cast("string"))})
    cat.bind_frame("listing_guazi", junk)
    assert listings.wide_rows(cat, "guazi", RUN).count() > 0
    reasons = {r.reason for r in listings.unreadable(cat, "guazi").select("reason").distinct().collect()}
    assert reasons == {"car_id is no number", "price is no number", "mile is no number"}


def test_che58_run_deletes_superseded_crawls_from_its_source(spark, tables, tmp_path):
    cat, store = listing_catalog(tables), SnapshotTable(spark, str(tmp_path / "source"))
    store.commit(cat.read("listing_che58"))
    cat.bind("listing_che58", store.read)
    old = {r.id for r in listings.superseded(cat, "che58").collect()}
    before = {r.id for r in store.read().select("id").collect()}
    listings.run(cat, "che58", RUN, str(tmp_path / "wide"), store)
    left = {r.id for r in store.read().select("id").collect()}
    assert old and left == before - old


def test_superseded_crawls_are_found_once_for_both_tables(spark, tables, tmp_path, monkeypatch):
    cat, store = listing_catalog(tables), SnapshotTable(spark, str(tmp_path / "source"))
    store.commit(cat.read("listing_che58"))
    cat.bind("listing_che58", store.read)
    plans = {}

    def look(cat, changes, *rest):
        plans.update({c.table: c.rows._jdf.queryExecution().optimizedPlan().toString() for c in changes if c.mode == "delete"})
        return []

    monkeypatch.setattr(listings, "commit_all", look)
    listings.run(cat, "che58", RUN, str(tmp_path / "wide"), store)
    assert set(plans) == {"listing_wide", "listing_che58"} and all("Join" not in p for p in plans.values())


def test_an_overlong_year_is_no_year(spark):
    from listingflow.operators import match

    long_year = spark.createDataFrame([("1", "99999999999")], "car_id string, model_year string")
    assert match.features(long_year).collect()[0].car_year == 0


def test_a_che58_run_that_stops_between_its_tables_is_finished_by_the_next(spark, tables, tmp_path):
    from listingflow.queries.listing_queries import Stopped, StoppingSink

    cat, store = listing_catalog(tables), SnapshotTable(spark, str(tmp_path / "source"))
    store.commit(cat.read("listing_che58"))
    cat.bind("listing_che58", store.read)
    old = {r.id for r in listings.superseded(cat, "che58").collect()}
    before = {r.id for r in store.read().select("id").collect()}
    path = str(tmp_path / "wide")
    with pytest.raises(Stopped):
        listings.run(cat, "che58", RUN, path, StoppingSink(store))
    journal = Journal(spark, f"{path}/journal")
    assert len(journal.open("listings-che58")) == 1 and not journal.open("listings-rrc")
    assert {r.id for r in store.read().select("id").collect()} == before
    listings.run(cat, "che58", RUN, path, store)
    assert {r.id for r in store.read().select("id").collect()} == before - old and old
    wide = listings.wide_table(spark, path).read()
    assert not journal.open() and wide.count() > 0 and not {r.id_data_input for r in wide.collect()} & old


def test_a_run_that_stops_before_its_entry_is_open_changes_nothing(spark, tables, tmp_path, monkeypatch):
    cat, store = listing_catalog(tables), SnapshotTable(spark, str(tmp_path / "source"))
    store.commit(cat.read("listing_che58"))
    cat.bind("listing_che58", store.read)
    monkeypatch.setattr("listingflow.operators.journal.write_text", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        listings.run(cat, "che58", RUN, str(tmp_path / "wide"), store)
    monkeypatch.undo()
    assert not Journal(spark, str(tmp_path / "wide/journal")).open()
    assert listings.wide_table(spark, str(tmp_path / "wide")).manifest() is None and len(store._numbers()) == 1


def test_a_platform_without_rows_is_refused(spark, tables, tmp_path):
    cat = listing_catalog(tables)
    cat.bind_frame("listing_rrc", cat.read("listing_rrc").limit(0))
    with pytest.raises(ValueError):
        listings.run(cat, "rrc", RUN, str(tmp_path / "wide"))


def test_planned_listings_go_to_the_same_table_by_a_commit(spark, tables, tmp_path):
    from listingflow.plans.base import commit

    cat = listing_catalog(tables)
    table = listings.wide_table(spark, str(tmp_path / "wide"))
    commit(cat, listings.plan(cat, "rrc", RUN), {"listing_wide": listings.WideSink(table, "rrc")}, {"listing_wide": S.LISTING_WIDE})
    first = table.read().count()
    assert first > 0
    listings.run(cat, "rrc", RUN, str(tmp_path / "wide"))  # the layout that a run reads
    assert table.read().count() == first


def test_known_models_leave_both_inputs_before_any_join_or_window(spark, tables):
    """In the optimised plan nothing but scans, filters and projections lies below the two anti joins."""
    rows = ods_to_production.config_rows(vehicle_catalog(tables))
    text = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    anti = [i for i, line in enumerate(text) if "LeftAnti" in line]
    assert len(anti) >= 2
    for i in anti:
        below = []
        for line in text[i + 1:]:
            if depth(line) <= depth(text[i]):
                break
            below.append(line.lstrip(" :+-|").split()[0].split("(")[0])
        assert not {"Window", "Aggregate", "Generate"} & set(below) and "Join" not in below, below
