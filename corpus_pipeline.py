"""A corpus pipeline: each stage calls one operator on all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns documents, all columns kept,
whatever their names; the last one returns whole rows with their shard and place
(columns of these two names are replaced). Null texts count as empty, texts of
any length are read whole, null and repeated ids are rows like others, and no
documents give none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import decontam, mixing, quality, sharding, simhash
from listingflow.llm.queries import KEEP_QUALITY
from listingflow.llm.shared import fold, free_name, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A source is used at most this often.
REPEATS = 2.0


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; without labels none is."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 5) != 0)
    model = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    score = free_name(docs, "_score")
    return quality.score(docs, model, out=score).where(F.col(score) >= KEEP_QUALITY).drop(score)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the smallest id's: four-word shingles, four bits. Texts without words are one group."""
    return simhash.one_of_each(docs, words=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, short ones included; null and empty texts contain none."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more: sources as flat as a limit of REPEATS lets them be, none left unused in part, blank ones used once."""
    tokens = free_name(docs, "_tokens")
    counted = docs.withColumn(tokens, mixing.tokens_of(F.col("text")))
    return mixing.mix(counted, tokens=tokens, repeats=REPEATS).select(*[f"`{c}`" for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole rows in eight shards of shuffled order."""
    return sharding.external_shuffle(docs, sharding.text_bytes("text"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("SimHash near-dedup", dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("sharding", shard),
]

# The first stage is a trained model and the second hashes with XXH64; DuckDB SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on the documents of a folder; what each keeps is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
