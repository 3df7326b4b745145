"""Used-car listing rules: colours, defaults, dates, fees, ages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.functions.text import fold_rules

DEFAULTED = ("annual", "transfer", "insure", "state", "trans_fee")


def color(col: Column) -> Column:
    return fold_rules(F.coalesce(col.cast("string"), F.lit("")), V.LISTING_COLOR_RULES)


def text_defaults(df: DataFrame) -> DataFrame:
    """NULL becomes '' in the five free-text columns, placeholder words are stripped."""
    def clean(name: str) -> Column:
        noise = V.TRANSFER_NOISE if name == "transfer" else V.TEXT_NOISE
        return F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit("")), noise, "")

    return df.withColumns({c: clean(c) for c in DEFAULTED if c in df.columns})


def strip_brackets(col: Column) -> Column:
    return F.regexp_replace(col, V.BRACKET_NOISE, "")


def strip_city_suffix(col: Column) -> Column:
    return F.regexp_replace(col, V.CITY_SUFFIX, "")


def transfer_fee(col: Column) -> Column:
    """0 without the fee, 1 with it, '' when unknown, else the raw text."""
    text = col.cast("string")
    return (
        F.when(text.contains(V.FEE_EXCLUDED), "0")
        .when(text.contains(V.FEE_INCLUDED), "1")
        .otherwise(F.coalesce(text, F.lit("")))
    )


def day(col: Column) -> Column:
    """Calendar day of a date, an instant or text; unparseable text is NULL."""
    return F.to_date(col.try_cast("timestamp"))


def month_start(col: Column) -> Column:
    """First day of a year-month text."""
    return F.concat(col.cast("string"), F.lit("-01")).try_cast("date")


def listing_day(update_time: Column, add_time: Column) -> Column:
    return day(F.coalesce(update_time, add_time))


def deal_day(deal_date: Column, add_time: Column, update_time: Column) -> Column:
    return day(F.coalesce(deal_date, add_time, update_time))


def expiry_flag(added: Column, expires: Column) -> Column:
    """'1' expired before the listing day, '0' not, '' unknown."""
    overdue = F.datediff(day(added), day(expires))
    return F.when(overdue > 0, "1").when(overdue <= 0, "0").otherwise("")


def reg_month(col: Column) -> Column:
    return F.date_format(col.try_cast("date"), "yyyy-MM")


def partition_month(added: Column) -> Column:
    return F.date_format(day(added), "yyyyMM")


def age_years(added: Column, registered_month: Column) -> Column:
    """Years since the first day of the registration month."""
    return F.round(F.datediff(day(added), day(registered_month)) / 365, 2)


def larger_mileage(appended: Column, driven: Column) -> Column:
    """The appended mileage when it is not smaller; an unknown comparison gives the other."""
    return F.when(appended >= driven, appended).otherwise(driven)
