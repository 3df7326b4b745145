"""Text building blocks: ordered replacement rules, blanks, numeric keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.fixed_values import UNKNOWN


def fold_rules(col: Column, rules: Iterable[Sequence[str]]) -> Column:
    """Apply (pattern, replacement) rules in order, as one nested expression."""
    return reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), rules, col.cast("string"))


def first_match(col: Column, pattern: str, group: int = 1) -> Column:
    """The first match, or NULL when there is none (or the text is NULL)."""
    return F.nullif(F.regexp_extract(col.cast("string"), pattern, group), F.lit(""))


def blank_to_dash(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """NULL or empty becomes '-' in every column not excluded; one projection."""
    kept = set(exclude)
    return df.select(
        *[
            F.col(f"`{c}`") if c in kept else dash(F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )


def dash(col: Column) -> Column:
    text = col.cast("string")
    return F.when(text.isNull() | (text == ""), UNKNOWN).otherwise(text)


def fill_text(df: DataFrame, value: str = UNKNOWN) -> DataFrame:
    """Fill NULLs of text columns only."""
    return df.select(
        *[
            F.coalesce(F.col(f"`{n}`"), F.lit(value)).alias(n) if t == "string" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def to_long(col: Column) -> Column:
    """Whole number from text or number; a decimal tail is cut, junk is NULL."""
    return F.regexp_replace(F.trim(col.cast("string")), r"\.\d*$", "").try_cast("bigint")


def long_key(df: DataFrame, name: str) -> Column:
    """`to_long` without the detour over text when the column is an integer already."""
    kind = dict(df.dtypes)[name]
    col = F.col(f"`{name}`")
    return col.cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else to_long(col)


def id_key(col: Column) -> Column:
    """Identifier as clean integer text."""
    return to_long(col).cast("string")


def join_words(*cols: Column) -> Column:
    """Words joined by one blank, NULLs skipped, runs of blanks collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(F.trim(F.concat_ws(" ", *cols)), r" +", " "))


def fold_rules_over(
    df: DataFrame, columns: Sequence[str], rules: Sequence[Sequence[str]], plain: Mapping[str, str] | None = None
) -> DataFrame:
    """The same rules on many text columns, as one expression over their array.

    Dozens of copies of a rule chain would outgrow one generated method; the
    array keeps a single copy. ``plain`` gives the known results of frequent
    values, which then skip the patterns.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df

    def one(c: Column) -> Column:
        shortcut = None
        for value, result in (plain or {}).items():
            shortcut = (F if shortcut is None else shortcut).when(c == value, result)
        folded = fold_rules(c, rules)
        return folded if shortcut is None else shortcut.otherwise(folded)

    values = F.transform(F.array(*[F.col(f"`{c}`").cast("string") for c in columns]), one)
    out = df.withColumn("_folded", values)
    return out.withColumns({c: F.col("_folded")[i] for i, c in enumerate(columns)}).drop("_folded")
