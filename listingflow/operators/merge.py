"""Keyed merges, computed as one join of target and source.

Each function returns the target as it is after the merge. A source NULL is a
real value, so row presence is carried by flags, never read from columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.operators.dedupe import one_per_key
from listingflow.operators.ids import number_new
from listingflow.operators.relational import missing_from


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing at run time when a key occurs twice.

    Groups by the key, which is also the partitioning the merge join needs.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(f"`{c}`").alias(c) for c in others]
    )
    # the check sits in a filter, so column pruning cannot drop it
    text = F.concat_ws(",", *[F.col(f"`{k}`").cast("string") for k in keys])
    ok = F.when(F.col("_n") == 1, True).otherwise(
        F.raise_error(F.concat(F.lit("duplicate merge key: "), text)).cast("boolean")
    )
    return counted.where(ok).select(*df.columns)


def one_source_row(
    source: DataFrame, keys: Sequence[str], on_duplicate: str, order: Sequence[Column] | None
) -> DataFrame:
    if on_duplicate == "error":
        return require_unique(source, keys)
    if on_duplicate == "first":
        return one_per_key(source, keys, order)
    if on_duplicate == "trusted":
        return source
    raise ValueError(f"on_duplicate: {on_duplicate!r}")


def _kinds(target: DataFrame) -> dict[str, str]:
    return dict(target.dtypes)


def _row(df: DataFrame, names: Sequence[str], target: DataFrame, defaults: Mapping[str, object]) -> Column:
    """One struct of target columns in target types; columns ``df`` lacks get their default."""
    kinds = _kinds(target)

    def value(c: str) -> Column:
        col = F.col(f"`{c}`") if c in df.columns else F.lit(defaults.get(c))
        return col.cast(kinds[c]).alias(c)

    # the marker keeps the struct from being empty
    return F.struct(F.lit(1).alias("_here"), *[value(c) for c in names])


def _keyed(df: DataFrame, keys: Sequence[str], target: DataFrame, **rows: Column) -> DataFrame:
    kinds = _kinds(target)
    return df.select(
        *[F.col(f"`{k}`").cast(kinds[k]).alias(k) for k in keys], *[c.alias(n) for n, c in rows.items()])


def _spell_out(joined: DataFrame, keys: Sequence[str], target: DataFrame, parts: Mapping[str, Sequence[str]]) -> DataFrame:
    """The target's columns from the keys and from structs that hold the others."""
    home = {c: part for part, names in parts.items() for c in names}
    return joined.select(*[
        F.col(f"`{c}`") if c in keys else F.col(home[c]).getField(c).alias(c) for c in target.columns
    ])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    on_duplicate: str = "error", order: Sequence[Column] | None = None,
) -> DataFrame:
    """Insert new keys; of existing rows change only the columns the source has."""
    defaults = defaults or {}
    given = [c for c in target.columns if c not in keys and c in source.columns]
    rest = [c for c in target.columns if c not in keys and c not in source.columns]
    source = one_source_row(source, keys, on_duplicate, order)
    old = _keyed(target, keys, target, _old=_row(target, given, target, {}), _rest=_row(target, rest, target, {}))
    new = _keyed(source, keys, target, _new=_row(source, given, target, {}))
    fresh = _row(source.select(*keys), rest, target, defaults)
    joined = old.join(new, list(keys), "full").withColumns(
        {"_given": F.coalesce("_new", "_old"), "_others": F.coalesce(F.col("_rest"), fresh)})
    return _spell_out(joined, keys, target, {"_given": given, "_others": rest})


def _whole_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], defaults: Mapping[str, object], source_wins: bool
) -> DataFrame:
    names = [c for c in target.columns if c not in keys]
    old = _keyed(target, keys, target, _old=_row(target, names, target, {}))
    new = _keyed(source, keys, target, _new=_row(source, names, target, defaults))
    order = ("_new", "_old") if source_wins else ("_old", "_new")
    joined = old.join(new, list(keys), "full").withColumn("_row", F.coalesce(*order))
    return _spell_out(joined, keys, target, {"_row": names})


def replace_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    on_duplicate: str = "error", order: Sequence[Column] | None = None,
) -> DataFrame:
    """Replace whole rows: columns the source lacks go back to their defaults."""
    return _whole_rows(target, one_source_row(source, keys, on_duplicate, order), keys, defaults or {}, True)


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str],
    defaults: Mapping[str, object] | None = None, order: Sequence[Column] | None = None,
) -> DataFrame:
    """Add rows whose key the target lacks; the first row (by order) of a key wins."""
    return _whole_rows(target, one_per_key(source, keys, order), keys, defaults or {}, False)


def truncate_load(source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The target's whole new content: one row per key of the source."""
    return one_per_key(source, keys, order)


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
    when: Column | None = None, order: Sequence[Column] | None = None,
) -> DataFrame:
    """Set columns of matching target rows; ``when`` (on target columns) narrows the rows touched.

    The source gives one row per key: the first by order, by default the
    smallest values.
    """
    picked = one_per_key(source.select(*keys, *columns), keys, order)
    picked = _keyed(picked, keys, target, _new=_row(picked, columns, target, {}))
    joined = target.join(picked, list(keys), "left")
    hit = F.col("_new").isNotNull() if when is None else F.col("_new").isNotNull() & when
    return joined.withColumns(
        {c: F.when(hit, F.col("_new").getField(c)).otherwise(F.col(f"`{c}`")) for c in columns}
    ).select(*[F.col(f"`{c}`") for c in target.columns])


def delete_matching(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows whose key is in ``doomed``."""
    return target.join(doomed.select(*keys), list(keys), "left_anti")


def attach_surrogate(source: DataFrame, target: DataFrame, natural: str, surrogate: str = "id") -> DataFrame:
    """Add the surrogate id the target already has for a natural key, NULL for a new row."""
    known = target.groupBy(natural).agg(F.min(surrogate).alias(surrogate))
    return source.drop(surrogate).join(known, natural, "left")


def with_surrogates(
    source: DataFrame, target: DataFrame, natural: str, surrogate: str = "id", on_duplicate: str = "first",
    start: int | None = None,
) -> DataFrame:
    """Source rows with surrogate ids: known rows keep theirs, new rows get the next numbers.

    ``start`` is the largest number given so far; without it the target tells.
    """
    source = one_source_row(source.drop(surrogate), [natural], on_duplicate, None)
    tagged = attach_surrogate(source, target, natural, surrogate)
    # a global aggregate: one row
    start = F.lit(start).cast("bigint") if start is not None else target.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint").alias("_start")).scalar()
    fresh = number_new(
        tagged.where(F.col(surrogate).isNull()).select(natural), natural, start, "_new"
    )
    return (
        tagged.join(fresh, natural, "left")
        .withColumn(surrogate, F.coalesce(F.col(surrogate).cast("bigint"), F.col("_new")))
        .drop("_new")
    )


def upsert_keep_id(
    target: DataFrame, source: DataFrame, natural: str, surrogate: str = "id",
    defaults: Mapping[str, object] | None = None, on_duplicate: str = "first", start: int | None = None,
) -> DataFrame:
    """Overwrite rows by natural key without moving their surrogate id; new rows get the next ids."""
    return replace_rows(
        target, with_surrogates(source, target, natural, surrogate, on_duplicate, start), [surrogate],
        defaults, on_duplicate="trusted",
    )


def insert_ignore_numbered(
    target: DataFrame, source: DataFrame, natural: str, surrogate: str = "id",
    defaults: Mapping[str, object] | None = None, on_duplicate: str = "first", start: int | None = None,
) -> DataFrame:
    """Insert-ignore by natural key into a table whose surrogate id counts up."""
    absent = missing_from(source, target, [natural])
    numbered = with_surrogates(absent, target, natural, surrogate, on_duplicate, start)
    defaults = defaults or {}
    rows = numbered.select(*[
        (F.col(f"`{c}`") if c in numbered.columns else F.lit(defaults.get(c))).cast(t).alias(c)
        for c, t in target.dtypes
    ])
    return target.unionByName(rows)
