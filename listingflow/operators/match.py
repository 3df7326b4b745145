"""Matching platform models to standard models by a cascade of exact keys.

Standard rows are counted per key before they meet any platform row, so a key
shared by many standard models is one row, and no pair list is ever built. All
rounds travel in one join: each platform row probes one key per round.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.functions import vehicle
from listingflow.operators.skew import lookup_join, row_salt

# Key sets beside the six rounds that separate several candidates of one round.
_PRICED = (*V.MATCH_FIELDS[:4], "car_price")
_BOXED = (*V.MATCH_ROUNDS[4], "car_auto")
_RESOLVERS = {1: (), 3: (_PRICED,), 4: (_BOXED,)}
_DRIVE_RESOLVERS = {
    1: ((*V.MATCH_ROUNDS[1], "car_drive"),),
    3: ((*_PRICED, "car_drive"), _PRICED),
    4: (_BOXED, (*V.MATCH_ROUNDS[4], "car_drive")),
}


def features(df: DataFrame, use_drive: bool = False, drive_from: str = "model_name", keep: Sequence[str] = ()) -> DataFrame:
    """Comparable, NULL-free match features of one catalogue beside the columns ``keep``; car_id becomes text."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    drive = F.lit("")
    if use_drive:
        found = vehicle.drive(F.regexp_extract(text(drive_from), "四驱|AWD|4WD|4X4|4x4|两驱|FWD|RWD|2WD", 0))
        drive = F.coalesce(found, F.lit(""))
    return df.select(
        *keep,
        F.col("car_id").cast("string").alias("car_id"),
        F.upper(text("brand_name")).alias("car_name"),
        F.upper(text("series_name")).alias("car_series1"),
        F.coalesce(number("model_year").try_cast("int"), F.lit(0)).alias("car_year"),
        F.bround(number("model_price"), 1).alias("car_price"),
        vehicle.displacement_for_match(text("liter")).alias("car_liter_wu"),
        vehicle.gearbox_for_match(text("car_auto")).alias("car_auto"),
        drive.alias("car_drive"),
        vehicle.emission_for_match(text("discharge_standard")).alias("car_discharge"),
    )


def _key_sets(use_drive: bool) -> list[tuple[str, ...]]:
    resolvers = _DRIVE_RESOLVERS if use_drive else _RESOLVERS
    extra = [s for sets in resolvers.values() for s in sets]
    return list(dict.fromkeys([*V.MATCH_ROUNDS, *extra]))


def _probes(sets: Sequence[Sequence[str]]) -> Column:
    """One (set number, field values) struct per key set."""
    def key(number: int, fields: Sequence[str]) -> Column:
        values = [F.col(f).cast("string") if f in fields else F.lit("") for f in V.MATCH_FIELDS]
        return F.struct(F.lit(number).alias("set"), F.array(*values).alias("key"))

    return F.explode(F.array(*[key(i, s) for i, s in enumerate(sets)]))


# Tasks that the standard models of one year, brand and series are dealt to, and the fewest tasks for each core.
GROUP_TASKS, CORE_TASKS = 32, 4


def _dealt(models: DataFrame, by: Sequence[str], together: Sequence[str] = V.MATCH_ROUNDS[-1]) -> DataFrame:
    """The models dealt evenly over more tasks than there are cores, before each becomes a row for each key set.

    A scan task may hold the whole list: counting sorts its rows, and a shuffle
    to many partitions keeps what it writes in memory. For standard models what
    all key sets share leads, so that equal keys are counted before they are
    shuffled; a width that is named is not narrowed again at run time. It is
    the cluster's own shuffle width where that is more: the keys of a task,
    which it holds until they are counted, then stay few for a longer list.
    """
    columns = [*by, "car_id", *V.MATCH_FIELDS]
    spark = models.sparkSession
    width = max(CORE_TASKS * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return models.select(*columns).repartition(width, *by, *together, row_salt(columns, GROUP_TASKS))


def _platform_probes(platform: DataFrame, sets: Sequence[Sequence[str]], by: Sequence[str]) -> DataFrame:
    """A row for each key set of each platform model; the models are dealt by all their values, as nothing of theirs is counted."""
    dealt = _dealt(platform, by, ["car_id", *V.MATCH_FIELDS])
    return dealt.select(*by, "car_id", "car_price", _probes(sets).alias("p")).select(*by, "car_id", "car_price", "p.set", "p.key")


def cascade(
    platform: DataFrame, standard: DataFrame, use_drive: bool = False, salts: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row per platform model that any round matches.

    ``round`` is the first round (0…5) with a candidate, ``candidates`` their
    number, ``match_des`` 'right' for one and 'repeat' for several, ``id_std``
    the single candidate of a right match, and ``final_id`` the standard id
    that survives the price check or the separation of repeats (else NULL).
    Columns ``by`` of both sides (a platform's name) keep several matches in one
    run apart; they lead the result.
    """
    sets = _key_sets(use_drive)
    number = {s: i for i, s in enumerate(sets)}
    by = list(by)
    lookup = (
        _dealt(standard, by).select(*by, "car_id", "car_price", _probes(sets).alias("p"))
        .groupBy(*by, "p.set", "p.key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("car_id").alias("id"), F.min("car_price").alias("price"))
    )
    # the size of a file does not tell that of its probes: they are never the side that is broadcast
    hits = lookup_join(_platform_probes(platform, sets, by).hint("merge"), lookup, [*by, "set", "key"], "inner", salts)
    found = hits.groupBy(*by, "car_id", "car_price").agg(
        *[
            F.max(F.when(F.col("set") == i, F.struct("n", "id", "price"))).alias(f"s{i}")
            for i in range(len(sets))
        ]
    )
    rounds = range(len(V.MATCH_ROUNDS))
    first = F.coalesce(*[
        F.when(F.col(f"s{i}").isNotNull(), F.struct(F.lit(i).alias("round"), f"s{i}.n", f"s{i}.id", f"s{i}.price"))
        for i in rounds
    ])
    found = found.withColumn("m", first).where("m IS NOT NULL")
    single = F.col("m.n") == 1

    # a right match must agree on the price (every round agrees on the year);
    # a repeat is settled by the first key set with one candidate
    settled = F.when(single & (F.col("m.price") == F.col("car_price")), F.col("m.id"))
    for i, options in (_DRIVE_RESOLVERS if use_drive else _RESOLVERS).items():
        picks = [F.when(F.col(f"s{number[o]}.n") == 1, F.col(f"s{number[o]}.id")) for o in options]
        if picks:
            settled = settled.when(~single & (F.col("m.round") == i), F.coalesce(*picks))
    return found.select(
        *by,
        F.col("car_id").alias("platform_id"),
        F.col("m.round").alias("round"),
        F.col("m.n").alias("candidates"),
        F.when(single, "right").otherwise("repeat").alias("match_des"),
        F.when(single, F.col("m.id")).alias("id_std"),
        settled.alias("final_id"),
    )


def settled_matches(cascaded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Matches that survive, one row per standard id (the smallest platform id).

    One platform model has one survivor at most, so the type is always 1 and
    it is always the only one.
    """
    return (
        cascaded.where(F.col("final_id").isNotNull())
        .groupBy(*by, F.col("final_id").alias("id_std"))
        .agg(F.min("platform_id").alias("platform_id"))
        .withColumns({"match_type": F.lit(1), "is_only": F.lit(1)})
    )


def unpivot_history(history: DataFrame, key: str, platforms: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """(platform, key, *names) from a wide history with a column ``<prefix>_<platform>`` for each name; one scan.

    ``names`` maps a column prefix to the type of the long column of that name.
    A platform whose columns the history lacks has no rows.
    """
    there = [p for p in platforms if {f"{n}_{p}" for n in names} <= set(history.columns)]
    if not there:
        kind = dict(history.dtypes)[key]
        ddl = ", ".join(["platform string", f"`{key}` {kind}", *[f"{n} {t}" for n, t in names.items()]])
        return history.sparkSession.createDataFrame([], ddl)
    rows = F.explode(F.array(*[
        F.struct(F.lit(p).alias("platform"), *[F.col(f"`{n}_{p}`").cast(t).alias(n) for n, t in names.items()]) for p in there]))
    return history.select(F.col(f"`{key}`"), rows.alias("_r")).select("_r.platform", key, *[f"_r.{n}" for n in names])


def pivot_platforms(base: DataFrame, found: DataFrame, platforms: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """One wide row per standard id of ``base``, with every platform's columns; gaps are 0. One shuffle.

    ``found`` has (platform, id_std, *names), one row per platform and id; ids that the base lacks are left out.
    """
    flagged = base.select("id_std", F.lit(True).alias("_base")).unionByName(found.withColumn("_base", F.lit(False)), allowMissingColumns=True)
    folded = flagged.groupBy("id_std").agg(
        F.max("_base").alias("_base"),
        *[F.max(F.when(F.col("platform") == p, F.struct(*names))).alias(f"_{p}") for p in platforms])
    return folded.where("_base").select("id_std", *[
        F.coalesce(F.col(f"_{p}.{n}"), F.lit("0" if t == "string" else 0).cast(t)).alias(f"{n}_{p}")
        for p in platforms for n, t in names.items()])


def merge_history(base: DataFrame, history: DataFrame, fresh: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every standard id with its earlier match, or the new one where it had none; joined by id.

    ``base`` has (id_std); ``history`` and ``fresh`` have (id_std, *names).
    """
    id_col = names[0]
    old = history.select("id_std", F.struct(*names).alias("_old"))
    new = fresh.select("id_std", F.struct(*names).alias("_new"))
    joined = base.select("id_std").join(old, "id_std", "left").join(new, "id_std", "left")
    keep = F.col(f"_old.{id_col}").isNotNull()
    return joined.select(
        "id_std",
        *[F.when(keep, F.col(f"_old.{n}")).otherwise(F.col(f"_new.{n}")).alias(n) for n in names],
    )


def fold_platforms(base: DataFrame, results: Mapping[str, DataFrame]) -> DataFrame:
    """One wide row per standard id: every platform's columns joined on the id, gaps filled with 0.

    All sides are keyed by the id, so the chain shuffles the base once.
    """
    folded = reduce(lambda left, right: left.join(right, "id_std", "left"), results.values(), base.select("id_std"))
    return folded.select(
        "id_std",
        *[
            F.coalesce(F.col(f"`{n}`"), F.lit("0" if t == "string" else 0).cast(t)).alias(n)
            for n, t in folded.dtypes if n != "id_std"
        ],
    ).distinct()
