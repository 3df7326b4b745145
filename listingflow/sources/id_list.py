"""Lists of ids from files or inline text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _tokens(df: DataFrame, line: str) -> DataFrame:
    text = F.regexp_replace(F.regexp_replace(F.col(line), "\ufeff", ""), "#.*", "")
    token = F.explode(F.split(F.trim(F.regexp_replace(text, r"[,\s]+", " ")), " "))
    return df.select(token.alias("_token"))


def dropped_tokens(df: DataFrame, line: str = "value") -> DataFrame:
    """The tokens of the lines that are no whole numbers, with their count: what ``parse_lines`` leaves out."""
    bad = _tokens(df, line).where((F.col("_token") != "") & F.col("_token").try_cast("bigint").isNull())
    return bad.groupBy(F.col("_token").alias("token")).agg(F.count(F.lit(1)).alias("cnt"))


def parse_lines(df: DataFrame, line: str = "value", key: str = "id") -> DataFrame:
    """Distinct whole numbers in text lines; '#' starts a comment, commas or blanks separate."""
    return _tokens(df, line).select(F.col("_token").try_cast("bigint").alias(key)).dropna().distinct()


def read_id_list(spark: SparkSession, path: str, skip_header: bool = False, key: str = "id") -> DataFrame:
    """Ids of a file; lines that are no integers are dropped."""
    lines = spark.read.csv(path, schema="value string", sep="\u0001", quote="", header=skip_header)
    return parse_lines(lines, "value", key)


def inline_ids(spark: SparkSession, text: str, key: str = "id") -> DataFrame:
    """Ids typed by hand, comma separated; anything but an integer is an error."""
    tokens = [t.strip() for t in text.replace("\n", ",").split(",") if t.strip()]
    bad = [t for t in tokens if not t.lstrip("+-").isdigit()]
    if bad:
        raise ValueError(f"not an integer id: {bad[0]!r}")
    ids = list(dict.fromkeys(int(t) for t in tokens))
    return spark.createDataFrame([(i,) for i in ids], f"{key} bigint")


