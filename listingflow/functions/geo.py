"""City and province standardisation against a district dimension.

Small dictionaries become one regular expression; a dictionary beyond the
checked size is matched by a join on text pieces instead. Both give the
leftmost dictionary word, the longest one at that position.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow import fixed_values as V
from listingflow.functions.text import fold_rules
from listingflow.operators.skew import broadcast_lookup_join, dealt_lookup_join, lookup_join

# Words above this count are matched by a join; the driver never holds more.
MAX_PATTERN_WORDS = 5_000


def bounded_words(df: DataFrame, column: str, limit: int = MAX_PATTERN_WORDS) -> list[str] | None:
    """The distinct words, longest first, or None when there are more than ``limit``."""
    col = F.col(column)
    rows = df.select(col).where(col.isNotNull() & (col != "")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return longest_first({r[0] for r in rows})


def longest_first(words: set[str]) -> list[str]:
    return sorted(words, key=lambda w: (-len(w), w))


def words_pattern(words: list[str]) -> str:
    """A pattern for the longest word at a position; words that begin alike share their beginning."""
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        tails = [re.escape(c) + pattern(n) for c, n in sorted(node.items()) if c]
        if not tails:
            return ""
        body = tails[0] if len(tails) == 1 and "" not in node else "(?:" + "|".join(tails) + ")"
        return body + ("?" if "" in node else "")

    return pattern(tree)


def first_word(text: Column, words: list[str]) -> Column:
    """Leftmost dictionary word in the text, NULL when none (or no dictionary)."""
    if not words:
        return F.lit(None).cast("string")
    return F.nullif(F.regexp_extract(text.cast("string"), words_pattern(words), 0), F.lit(""))


#: Characters of a word that a place in a text is looked up by, if the shortest word has as many.
PREFIX = 3


def first_word_by_join(
    df: DataFrame, text_col: str, out_col: str, words: DataFrame, word_col: str
) -> DataFrame:
    """`first_word` for a dictionary of any size, by a keyed prefix index.

    Each place in a distinct text is one row with its next characters, as many
    as the longest word has. Its first few characters tell how long the words
    that begin so are, and the text of each such length is looked up as a whole
    word: a place costs as many rows as there are lengths, however many words
    begin alike. A text that many rows share is looked up in many tasks.
    """
    words = words.select(F.col(word_col).cast("string").alias("_word")).where("_word <> ''").distinct()
    edge = words.agg(F.min(F.length("_word")).alias("least"), F.max(F.length("_word")).alias("most")).head()
    if edge["least"] is None:
        return df.withColumn(out_col, F.lit(None).cast("string"))
    width, most = min(PREFIX, edge["least"]), edge["most"]
    sizes = words.select(F.substring("_word", 1, width).alias("_key"), F.length("_word").alias("_size")).distinct()
    # a digest stands for the text, so that no row at a place carries the whole
    counted = df.select(F.col(text_col).cast("string").alias("_text")).where(F.length("_text") >= width).groupBy("_text").agg(
        F.count(F.lit(1)).alias("_n"))
    # no text is NULL here: with that said, with the count kept and an outer explode, the texts and their counts stay one shuffle
    texts, text_id = counted.where("_n > 0"), F.coalesce(_digest("_text"), F.lit("")).alias("_id")
    places = texts.select(text_id, "_text", F.explode_outer(F.sequence(F.lit(1), F.length("_text") - width + 1)).alias("_at"))
    places = places.select("_id", "_at", F.substring("_text", F.col("_at"), F.lit(most)).alias("_rest"))
    places = broadcast_lookup_join(places.withColumn("_key", F.substring("_rest", 1, width)), sizes, ["_key"], "inner")
    # leftmost, then longest, as one number
    rank = F.col("_at") * F.lit(most + 1).cast("long") - F.col("_size")
    tried = places.where(F.length("_rest") >= F.col("_size")).select(
        "_id", rank.alias("_rank"), F.substring("_rest", F.lit(1), F.col("_size")).alias("_word"))
    hits = lookup_join(tried, words, ["_word"], "inner").groupBy("_id").agg(F.min("_rank").alias("_first"))
    keep = [c for c in df.columns if c != out_col]
    # a text shorter than every word has no place, like a NULL
    keyed = df.select(*keep, F.col(text_col).cast("string").alias("_text")).withColumn(
        "_id", F.when(F.length("_text") >= width, _digest("_text")))
    found = dealt_lookup_join(keyed, hits, ["_id"], counted.select(text_id, "_n"))
    start = F.ceil(F.col("_first") / F.lit(most + 1)).cast("int")
    word = F.substring("_text", start, (start * F.lit(most + 1).cast("long") - F.col("_first")).cast("int"))
    return found.select(*keep, word.alias(out_col))


def _digest(text_col: str) -> Column:
    return F.md5(F.col(text_col).cast("string").cast("binary"))


def district_dim(district: DataFrame, region: DataFrame) -> DataFrame:
    """Distinct (regional, province, city) of the districts whose province has a region."""
    return (
        district.join(region, district["key_province"] == region["province"])
        .select("regional", "province", F.col("key_municipal").alias("city"))
        .distinct()
    )


def county_dim(district: DataFrame, region: DataFrame) -> DataFrame:
    return (
        district.join(region, district["key_province"] == region["province"])
        .select("regional", "province", F.col("key_municipal").alias("city"), "key_county")
        .distinct()
    )


def one_row_per_city(districts: DataFrame) -> DataFrame:
    """Smallest (region, province) of each city, so that joining by city never fans out."""
    return (
        districts.groupBy("city")
        .agg(F.min(F.struct("regional", "province")).alias("_first"))
        .select("city", "_first.regional", "_first.province")
    )


def city_code_dim(district: DataFrame) -> DataFrame:
    """Province and city code prefixes with the province name and its smallest city name."""
    return district.groupBy(
        F.substring("city_code", 1, 2).alias("province_id"),
        F.substring("city_code", 1, 4).alias("city_id"),
        F.col("key_province").alias("province"),
    ).agg(F.min("key_municipal").alias("city"))


def one_per_code(codes: DataFrame, code: str, name: str) -> DataFrame:
    return codes.groupBy(code).agg(F.min(name).alias(name))


def _county_city(counties: DataFrame) -> DataFrame:
    """Every county word with its smallest city; a county without a city is a word all the same, with none."""
    city = F.min(F.when(F.col("city") != "", F.col("city"))).alias("city")
    return counties.where("key_county <> ''").groupBy("key_county").agg(city)


@dataclass
class Gazetteer:
    """City, county and province dictionaries of one district dimension.

    ``cities``, ``provinces`` and ``counties`` are None when there are too many
    words for a pattern; matching then goes through the frames.
    """

    districts: DataFrame
    cities: list[str] | None
    provinces: list[str] | None
    counties: list[str] | None
    county_city: DataFrame

    @classmethod
    def load(cls, counties: DataFrame, limit: int = MAX_PATTERN_WORDS) -> "Gazetteer":
        """``counties`` has (regional, province, city, key_county)."""
        county_city = _county_city(counties)
        columns = ["regional", "province", "city", "key_county"]
        rows = counties.select(*columns).distinct().limit(limit + 1).collect()
        if len(rows) > limit:
            return cls(
                districts=counties.select("regional", "province", "city").distinct(),
                cities=bounded_words(counties, "city", limit),
                provinces=bounded_words(counties, "province", limit),
                counties=bounded_words(county_city, "key_county", limit),
                county_city=county_city,
            )
        # the whole dimension fits the bound: keep it as a literal relation
        spark = counties.sparkSession
        kinds = dict(counties.dtypes)
        local = spark.createDataFrame(rows, ", ".join(f"{c} {kinds[c]}" for c in columns))
        words = {c: longest_first({r[c] for r in rows if r[c]}) for c in columns[1:]}
        return cls(
            districts=local.select("regional", "province", "city").distinct(),
            cities=words["city"], provinces=words["province"], counties=words["key_county"],
            county_city=_county_city(local),
        )

    def add_first(self, df: DataFrame, text_col: str, out_col: str, kind: str) -> DataFrame:
        """Add the leftmost city / province / county word of a text column."""
        words = {"city": self.cities, "province": self.provinces, "key_county": self.counties}[kind]
        if words is not None:
            return df.withColumn(out_col, first_word(F.col(text_col), words))
        frame = self.county_city if kind == "key_county" else self.districts
        return first_word_by_join(df, text_col, out_col, frame, kind)

    def add_county_city(self, df: DataFrame, text_col: str, out_col: str, wanted: Column) -> DataFrame:
        """Add the city of the first county word found in a text column, looked for only where wanted."""
        df = df.withColumn("_searched", F.when(wanted, F.col(text_col)))
        df = self.add_first(df, "_searched", "_county", "key_county").drop("_searched")
        names = self.county_city.select(
            F.col("key_county").alias("_county"), F.col("city").alias(out_col)
        )
        if self.counties is not None:
            # at most MAX_PATTERN_WORDS rows, counted when the dictionary was loaded
            return df.join(F.broadcast(names), "_county", "left").drop("_county")
        return lookup_join(df, names, ["_county"]).drop("_county")


def standardise_city(df: DataFrame, column: str, gazetteer: Gazetteer) -> DataFrame:
    """Replace a free-text place by its city: first city word, else first county's city, else NULL."""
    columns = df.columns
    df = gazetteer.add_first(df, column, "_city", "city")
    df = gazetteer.add_county_city(df, column, "_by_county", F.col("_city").isNull())
    return df.withColumn(column, F.coalesce("_city", "_by_county")).select(*columns)


def standardise_listing_location(
    df: DataFrame, gazetteer: Gazetteer, county_fallback: bool = False
) -> DataFrame:
    """City of a listing: from its location (aliases fixed), else its address, else the address's county.

    With the county fallback an unknown place is '', without it NULL.
    """
    columns = df.columns
    aliases = [(re.escape(old), new) for old, new in V.CITY_ALIASES]
    df = df.withColumn("location", fold_rules(F.col("location"), aliases))
    df = gazetteer.add_first(df, "location", "_city", "city")
    df = gazetteer.add_first(df, "address", "_by_address", "city")
    choices = [F.col("_city"), F.col("_by_address")]
    if county_fallback:
        df = gazetteer.add_county_city(
            df, "address", "_by_county", F.coalesce(*choices).isNull())
        choices += [F.col("_by_county"), F.lit("")]
    # filters and joins on the place stay above this, so its patterns are matched once
    return df.withColumn("location", F.explode(F.array(F.coalesce(*choices)))).select(*columns)
