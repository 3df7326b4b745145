"""Joins of large row sets with lookups that have one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SALTS = 16


def row_salt(columns: Sequence[str], salts: int) -> Column:
    """A number that depends on the row's values only, so a retried task gives the same one."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(salts)).cast("int")


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", salts: int | None = None
) -> DataFrame:
    """Join rows to a lookup with one row per key; a hot (or NULL) key does not end in one task.

    The lookup comes from an aggregation by the same key, and a join on just
    that key would reuse its partitioning, which adaptive skew handling cannot
    split. A hash of the key joins the key list on both sides: both are then
    shuffled for the join, so at run time Spark splits an oversized partition,
    or broadcasts the lookup when it turns out small. Where adaptive skew
    handling is off, rows are salted from their own values and the lookup is
    repeated once per salt.
    """
    keys = list(keys)
    if salts is None:
        salts = 1 if _adaptive(rows) else DEFAULT_SALTS
    if salts <= 1:
        spread = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
        joined = rows.withColumn("_spread", spread).join(
            lookup.withColumn("_spread", spread), ["_spread", *keys], how)
        return joined.drop("_spread")
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", row_salt(rows.columns, salts))
    return salted.join(repeated, ["_salt", *keys], how).drop("_salt")


def _adaptive(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return all(
        conf.get(k).lower() == "true" for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


# Frequent keys that are dealt out, and the shares that the rows of each are dealt into.
HOT_KEYS, HOT_SHARES = 1_000, 256


def dealt_lookup_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], counted: DataFrame) -> DataFrame:
    """Left `lookup_join` whose most frequent keys, and NULL ones, do not end in one task however small their rows are.

    Spark splits a partition by its bytes, and many equal rows take few.
    ``counted`` has the keys of the rows and their number ``_n``. The rows of
    the HOT_KEYS most frequent keys are dealt over HOT_SHARES from their own
    values and the lookup rows of these keys are repeated; a row with a NULL key
    meets no lookup row and is dealt likewise. With adaptive execution off, all
    rows are salted as in `lookup_join`.
    """
    keys = list(keys)
    if not _adaptive(rows):
        return lookup_join(rows, lookup, keys)
    most = counted.orderBy(F.desc("_n"), *keys).limit(HOT_KEYS).select(*keys, F.lit(True).alias("_hot"))
    hot = F.coalesce(F.col("_hot"), F.lit(False))
    own = [c for c, kind in rows.dtypes if "map<" not in kind]
    stray = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    dealt = rows.join(F.broadcast(most), keys, "left").withColumn(
        "_share", F.when(hot | stray, row_salt(own, HOT_SHARES)).otherwise(0)).drop("_hot")
    # one row for a usual key, one row of each share for a frequent one
    shares = lookup.sparkSession.range(HOT_SHARES + 1).select(
        (F.col("id") > 0).alias("_hot"), F.greatest(F.col("id") - 1, F.lit(0)).cast("int").alias("_share"))
    repeated = lookup.join(F.broadcast(most), keys, "left").withColumn("_hot", hot).join(F.broadcast(shares), "_hot").drop("_hot")
    return dealt.join(repeated, ["_share", *keys], "left").drop("_share")


# A lookup is broadcast on request only after its rows and bytes were counted up to these bounds.
MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 100_000, 64 << 20


def broadcast_lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """`lookup_join` that leaves the rows where they are when the lookup is counted to be small.

    A row counts the bytes of its texts and 16 for each column. No more than
    ``max_rows`` + 1 rows are counted.
    """
    width = F.lit(16 * len(lookup.columns)).cast("long")
    for name, kind in lookup.dtypes:
        if kind not in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
    size = lookup.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).head()
    if size["n"] <= max_rows and size["bytes"] <= max_bytes:
        return rows.join(F.broadcast(lookup), list(keys), how)
    return lookup_join(rows, lookup, keys, how)
