"""Two-pass external shuffle into shards.

Pass one scatters whole records uniformly into memory-sized buckets by a seeded
hash of the record. Pass two shuffles each bucket (Fisher-Yates, the seeded
``shuffle`` of arrays) and lays the buckets end to end, so the whole is one
uniform permutation of the rows. Shards are equal runs of it: their row counts
differ by one at most, and a bucket is written without another exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.shared import stored

#: Buckets whose counts are summed together before the sums themselves are accumulated.
RUN = 4096


def _hashable(df: DataFrame) -> list[str]:
    return [f"`{f.name}`" for f in df.schema.fields if "map" not in f.dataType.simpleString()
            and "variant" not in f.dataType.simpleString()]


def _starts(counts: DataFrame) -> DataFrame:
    """(bucket, n) with the number of rows in all earlier buckets; no task sees all buckets."""
    runs = counts.groupBy(F.expr(f"bucket div {RUN}").alias("run")).agg(F.sum("n").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("run", before.alias("earlier"))
    inside = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("run", F.expr(f"bucket div {RUN}")).join(runs, "run")
        .select("bucket", (F.col("earlier") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start"))
    )


def external_shuffle(
    records: DataFrame, size: Column | str, shards: int = 8, seed: int = 20240229,
    bucket_bytes: int = 16 << 20, bucket_rows: int = 1 << 16,
) -> DataFrame:
    """All rows with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``size`` gives the bytes of a record; buckets hold about ``bucket_bytes``
    and at most about ``bucket_rows``. The permutation is a function of the
    rows, the seed and the bucket sizes. Shards hold ⌊N/S⌋ or ⌈N/S⌉ rows.

    Nulls in any column hash like values; null sizes count nothing. Equal rows
    are kept, each with its own slot; a bucket that equal rows overfill (they
    share a hash) is cut into several by row position. No rows give no rows.
    Columns named ``shard`` or ``slot`` are replaced.
    """
    records = records.drop("shard", "slot")
    names = records.columns
    size = F.col(size) if isinstance(size, str) else size
    h = F.xxhash64(F.lit(seed), *_hashable(records))
    total = records.agg(F.sum(size.cast("long")).alias("bytes"), F.count(F.lit(1)).alias("rows")).head()
    rows = total["rows"]
    buckets = max(1, math.ceil((total["bytes"] or 0) / bucket_bytes), math.ceil(rows / bucket_rows))
    # one row: the record as it is, its hash and its bucket
    keyed = records.select(F.struct(*[f"`{n}`" for n in names]).alias("rec"), h.alias("h"))
    keyed = keyed.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    counts = stored(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "shuffle-counts")
    # Uniform hashes stay near the mean; only equal rows go far beyond it.
    bound = 4 * math.ceil(rows / buckets) + 1024
    hot = counts.where(F.col("n") > bound)
    if not hot.isEmpty():
        cuts = hot.select("bucket", F.ceil(F.col("n") / bound).alias("cuts"))
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("cuts"))
        keyed = stored(
            keyed.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(64)))
            .join(cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63)).cast("array<bigint>"))),
                  ["bucket", "salt"], "left").drop("salt")
            .withColumn("bucket", F.when(F.col("cuts").isNull(), F.col("bucket"))
                        .otherwise(F.lit(buckets) + F.col("bucket") * (1 << 20) + part)).drop("cuts"), "shuffle-cut")
        counts = stored(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "shuffle-counts")
    starts = _starts(counts).select(F.lit(None).cast(keyed.schema["rec"].dataType).alias("rec"),
                                    F.lit(None).cast("long").alias("h"), "bucket", "start")
    # Pass one. A bucket's first position travels with its records, so no join is needed.
    scattered = (
        keyed.withColumn("start", F.lit(None).cast("long")).unionByName(starts)
        .repartition(buckets, "bucket").sortWithinPartitions("bucket", "h")
    )
    # Pass two: buckets of a task in order, so that the seeded shuffle repeats itself exactly.
    lists = (
        scattered.groupBy("bucket").agg(F.collect_list("rec").alias("recs"), F.max("start").alias("start"))
        .sortWithinPartitions("bucket").select("start", F.shuffle("recs", F.lit(seed)).alias("recs"))
    )
    placed = lists.select("start", F.posexplode("recs").alias("at", "rec"))
    place = F.col("start") + F.col("at")
    shard = F.expr(f"(start + at) * {shards} div {max(rows, 1)}")
    first = F.expr(f"(((start + at) * {shards} div {max(rows, 1)}) * {rows} + {shards - 1}) div {shards}")
    return placed.select(
        *[F.col("rec").getField(n).alias(n) for n in names], shard.cast("int").alias("shard"),
        (place - first).cast("long").alias("slot"),
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write the rows of ``external_shuffle`` into one folder per shard; rows of a file are in slot order."""
    shuffled.write.partitionBy("shard").parquet(path)


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def document_records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32): UTF-8 bytes of the text (null: none) plus 1, and the text's CRC (null: null)."""
    return docs.select("doc_id", text_bytes("text").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
