"""What several operators need: the shared folder, stored steps, fold numbers, contract words."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.session import checkpoint_dir

# Fixed value: what the contracts count as white space.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: lineage ends there and lost executors do no harm."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def words_of(text: Column) -> Column:
    """Words of a text; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANK + "+")
    return F.filter(parts, lambda w: w != "")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path; where they can't reach it, ship it with --py-files."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])


def sized(df: DataFrame, name: str, most: int) -> DataFrame:
    """A stored step, marked for broadcast if it has at most ``most`` rows; beyond that joins shuffle it."""
    df = stored(df, name)
    return F.broadcast(df) if df.count() <= most else df


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores more as keep it from clashing with a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(df: DataFrame, *names: str) -> DataFrame:
    """The same rows; later filters on the named columns no longer move below their computation.

    A filter that moved there would spell the columns out, and arrays inside
    functions of their own elements would be made anew for every element.
    """
    packed = F.explode(F.array(F.struct(*[f"`{n}`" for n in names]))).alias("_settled")
    rest = [f"`{c}`" for c in df.columns if c not in names]
    return df.select(*rest, packed).select(*[F.col("_settled")[c].alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])
