"""Gap-free numbering and stable text ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.operators.skew import lookup_join
from listingflow.session import cut_lineage


def max_suffix(df: DataFrame, group: str, code: str, pattern: str = r"(\d+)$") -> DataFrame:
    """Largest trailing number of a code per group."""
    number = F.regexp_extract(F.col(code), pattern, 1).try_cast("bigint")
    return df.groupBy(group).agg(F.max(number).alias("max_suffix"))


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Number distinct (group, order) rows 1, 2, … inside each group without gathering any group.

    Rows are range-sorted over all tasks by (group, order) and written to the
    shared checkpoint folder together with their position, so numbers cannot
    move when a task is repeated. A group then spans neighbouring ranges; what
    precedes a range inside its group is a sum over one row per (group, range).
    """
    spark = df.sparkSession
    keys = [*group, *order]
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = (
        df.repartitionByRange(width, *[F.col(f"`{c}`") for c in keys])
        .sortWithinPartitions(*[F.col(f"`{c}`") for c in keys])
        .withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )
    placed = cut_lineage(placed)
    sizes = placed.groupBy(*group, "_range").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_start")
    )
    # one row per (group, range): at most the number of ranges in any group
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = placed.join(offsets, [*group, "_range"])
    number = F.col("_before") + F.col("_at") - F.col("_start") + 1
    return joined.withColumn(name, number.cast("bigint")).drop("_range", "_at", "_start", "_before")


def allocate(
    new: DataFrame, existing: DataFrame, group: str, by: str, code: str, mark: str = "",
    digits: str = r"(\d+)$", out: str | None = None,
) -> DataFrame:
    """Give each new row the id group ‖ mark ‖ (largest suffix + rank of its name in the group).

    ``existing`` has (group, code). Equal names of a group share an id; a row
    without a group gets no id and is dropped.
    """
    out = out or code
    new = new.where(F.col(group).isNotNull() & F.col(by).isNotNull())
    names = rank_within(new.select(group, by).distinct(), [group], [by], "_rank")
    start = max_suffix(existing, group, code, digits)
    coded = names.join(start, group, "left").select(
        group, by,
        F.concat(
            F.col(group), F.lit(mark),
            (F.coalesce("max_suffix", F.lit(0)) + F.col("_rank")).cast("string"),
        ).alias("_code"),
    )
    joined = lookup_join(new.drop(out), coded, [group, by], "inner")
    return joined.withColumnRenamed("_code", out)


def number_new(df: DataFrame, order: str, start: Column | int, out: str) -> DataFrame:
    """Number all rows start + 1, start + 2, … in the order of a unique column."""
    ranked = rank_within(df.withColumn("_all", F.lit(0)), ["_all"], [order], "_rank")
    base = F.lit(start) if isinstance(start, int) else start
    return ranked.withColumn(out, (base + F.col("_rank")).cast("bigint")).drop("_all", "_rank")
