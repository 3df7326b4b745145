"""Fitting frames onto target layouts, by name."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("listingflow")


def align(df: DataFrame, schema: T.StructType, mode: str = "pad", skip: Sequence[str] = ()) -> DataFrame:
    """'pad': every target column, absent ones as typed NULLs; 'intersect': only those both have."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def pick(field: T.StructField) -> Column:
        if field.name in have:
            col = F.col(f"`{field.name}`")
            return col if have[field.name] == field.dataType else col.cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    if mode not in ("pad", "intersect"):
        raise ValueError(f"mode: {mode!r}")
    fields = [f for f in schema.fields if f.name not in skip and (mode == "pad" or f.name in have)]
    return df.select(*[pick(f) for f in fields])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position when the counts agree, else warn and leave the frame alone."""
    if len(df.columns) != len(names):
        log.warning("column count %d, expected %d: %s", len(df.columns), len(names), df.columns)
        return df
    return df.toDF(*names)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.limit(0)


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select target names from source column names, or from expressions."""
    return df.select(
        *[(F.col(f"`{s}`") if isinstance(s, str) else s).alias(t) for t, s in columns.items()]
    )
