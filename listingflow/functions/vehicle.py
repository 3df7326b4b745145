"""Vehicle attribute standardisation as Catalyst expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.functions.text import dash, first_match, fold_rules, fold_rules_over


def gearbox(col: Column) -> Column:
    """自动双离合 / 自动 / 手动, else '-'; NULL stays NULL."""
    hit = F.regexp_extract(fold_rules(col, V.GEARBOX_RULES), f"({V.GEARBOX_KINDS})", 1)
    return F.when(hit == "", V.UNKNOWN).otherwise(hit)


def catalogue_gearbox(model_name: Column, raw: Column, power: Column) -> Column:
    """Gearbox read from name and raw text together; pure electric cars are 电动."""
    named = gearbox(F.concat(model_name, raw.cast("string")))
    return F.when(power == 1, V.ELECTRIC_GEARBOX).otherwise(named)


def gearbox_for_match(col: Column) -> Column:
    return fold_rules(F.coalesce(col.cast("string"), F.lit("")), V.GEARBOX_MATCH_RULES)


def drive(col: Column) -> Column:
    return fold_rules(col, V.DRIVE_RULES)


def emission_standard(model_name: Column, raw: Column) -> Column:
    """Standard from the raw text when it names one, else from the model name, else NULL."""
    raw = raw.cast("string")
    source = F.when(raw.rlike(V.EMISSION_MARK), raw).otherwise(
        first_match(model_name, V.EMISSION_IN_NAME)
    )
    return fold_rules(source, V.EMISSION_RULES)


def emission_standard_production(col: Column) -> Column:
    return fold_rules(col, V.EMISSION_PRODUCTION_RULES)


def emission_for_match(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), V.EMISSION_MATCH_NOISE, "")


def displacement(model_name: Column, raw: Column) -> Column:
    return F.coalesce(first_match(raw, V.DISPLACEMENT), first_match(model_name, V.DISPLACEMENT))


def catalogue_displacement(model_name: Column, raw: Column, power: Column) -> Column:
    return F.when(power == 1, V.UNKNOWN).otherwise(displacement(model_name, raw))


def displacement_for_match(col: Column) -> Column:
    return F.coalesce(F.regexp_extract(col.cast("string"), V.DISPLACEMENT_MATCH, 1), F.lit(""))


def first_token(col: Column) -> Column:
    return F.split(col.cast("string"), " ").getItem(0)


def model_year(col: Column) -> Column:
    text = F.regexp_replace(col.cast("string"), V.MODEL_YEAR_NOISE, "")
    return F.when(text == "0", "").otherwise(text)


def model_year_from_name(col: Column) -> Column:
    return F.coalesce(
        first_match(col, V.MODEL_YEAR_LONG), F.regexp_extract(col, V.MODEL_YEAR_SHORT, 1)
    )


def power_code(fuel: Column, has_ev_row: Column) -> Column:
    """1 electric, 2 hybrid, 3 plug-in, 4 range extender, else 1 if an EV row exists, else 0."""
    fuel = fuel.cast("string")
    word, code = V.POWER_CODES[0]
    chain = F.when(fuel.contains(word), code)
    for word, code in V.POWER_CODES[1:]:
        chain = chain.when(fuel.contains(word), code)
    # a fuel text that already is a code counts as that code
    chain = chain.when(fuel.isin("1", "2", "3", "4"), fuel.try_cast("int"))
    return chain.otherwise(has_ev_row.cast("int"))


def sale_status(col: Column) -> Column:
    return F.coalesce(first_match(col, V.SALE_STATUS), col.cast("string"))


def car_level(col: Column) -> Column:
    return F.coalesce(first_match(col, f"({V.CAR_LEVELS})"), F.lit(V.NONE_TEXT))


def import_group(series_name: Column, group_name: Column) -> Column:
    """Manufacturer name, prefixed by 进口 when the series says so, repeats collapsed."""
    marked = F.when(
        series_name.contains(V.IMPORT_MARK), F.concat(F.lit(V.IMPORT_MARK), group_name)
    ).otherwise(group_name)
    return F.regexp_replace(marked, V.IMPORT_REPEATS, V.IMPORT_MARK)


def import_series(series_name: Column, stopped: bool = True) -> Column:
    """Series name without the import (and stopped-sale) suffix, upper case."""
    suffix = V.IMPORT_OR_STOPPED_SUFFIX if stopped else V.IMPORT_SUFFIX
    return F.upper(F.regexp_replace(series_name, suffix, ""))


def import_naming(df: DataFrame, standard: bool = False) -> DataFrame:
    """Set series_group_name, series_name and is_import together.

    ``standard`` gives the standard-catalogue variant: stopped-sale suffixes
    stay, one name is fixed by hand, and the flag is text.
    """
    group = import_group(F.col("series_name"), F.col("series_group_name"))
    name = F.col("series_name")
    if standard:
        # the suffix goes first, then the fix, then upper case
        name = F.regexp_replace(name, V.IMPORT_SUFFIX, "")
        name = F.upper(F.replace(name, F.lit(V.SERIES_NAME_FIX[0]), F.lit(V.SERIES_NAME_FIX[1])))
        flag = F.when(group.contains(V.IMPORT_MARK), "1").otherwise("0")
    else:
        name = import_series(name)
        flag = group.contains(V.IMPORT_MARK).cast("int")
    return df.withColumns({"series_group_name": group, "series_name": name, "is_import": flag})


def ev_block(df: DataFrame) -> DataFrame:
    """Standardise the electric-drive parameter columns that are present."""
    have = set(df.columns)
    out: dict[str, Column] = {}

    def rule(name: str, make) -> None:
        if name in have:
            out[name] = make(F.col(name).cast("string"))

    rule("ee_type", lambda c: fold_rules(c, V.EV_TYPE_RULES))
    for name in ("ee_fast_charging_time", "ee_slow_charging_time"):
        rule(name, lambda c: fold_rules(c, V.EV_CHARGING_TIME_RULES))
    rule(
        "ee_battery_type",
        lambda c: F.coalesce(
            F.concat(first_match(c, V.EV_BATTERY_KINDS), F.lit(V.EV_BATTERY_SUFFIX)),
            F.lit(V.UNKNOWN),
        ),
    )
    for name in [c for c in df.columns if c.endswith("range")]:
        rule(name, lambda c: fold_rules(c, V.EV_RANGE_RULES))
    rule("ee_battery_quality_assurance", lambda c: fold_rules(c, V.EV_WARRANTY_RULES))
    rule(
        "ee_fast_charge",
        lambda c: F.when(c != V.UNKNOWN, F.concat(c, F.lit("%"))).otherwise(c),
    )
    return df.withColumns(out) if out else df


def ev_export(df: DataFrame, key: str) -> DataFrame:
    """EV columns as production stores them: a bare '%' and blanks or NULLs become '-'."""
    def clean(name: str) -> Column:
        col = F.col(f"`{name}`").cast("string")
        if name == V.EV_FAST_CHARGE_PRODUCTION:
            col = F.regexp_replace(col, "^%", V.UNKNOWN)
        return dash(col).alias(name)

    return df.select(*[F.col(f"`{c}`") if c == key else clean(c) for c in df.columns])


def split_pairs(df: DataFrame, separator: str = V.PAIR_SEPARATOR) -> DataFrame:
    """Front columns keep the text before the separator, rear columns the text after it.

    The default separator is a backslash and a slash; the front form also
    swallows a question mark before it, the rear form a backslash after it.
    """
    front = rf"\?{separator}.*|{separator}.*"
    rear = rf".*{separator}\\?|.*{separator}"
    return fold_rules_over(fold_rules_over(df, V.FRONT_COLUMNS, [(front, "")]), V.REAR_COLUMNS, [(rear, "")])


def equipment_flags(df: DataFrame, columns=V.EQUIPMENT_COLUMNS) -> DataFrame:
    """标配 becomes Y; 选配, 无 and '-' become N."""
    return fold_rules_over(df, columns, V.EQUIPMENT_RULES, V.EQUIPMENT_PLAIN)


def catalogue_color(col: Column) -> Column:
    return fold_rules(col, V.CATALOGUE_COLOR_RULES)
