"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Jaccard similarity is useless between a short item and a long document, so items
are sketched by containment: under each of some seeded permutations the item's
smallest shingle is its MinHash, and the share of these MinHashes that a document
holds estimates how much of the item it contains. Items are parted by size. One
with no more shingles than permutations is its own sketch; larger ones get a
sketch of fixed size and a number of hits that a contained item misses with a
chance of one in 10^9 at most. A document is held against a size only if it has
shingles enough to contain it. Candidates are verified with the shingles
themselves over the whole document.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.shared import settled, sized, stored

WORDS, CONTAINED = 5, 0.8
PERMUTATIONS, MISSED = 32, 1e-9
#: Rows of a sketch, of shingles or of text keys that are broadcast; 64 bytes each at most.
BROADCAST_ROWS = 500_000
# Fixed value: a word is a run of letters and digits, compared in lower case.
TOKEN = r"[\p{L}\p{N}]+"


def needed_hits(permutations: int = PERMUTATIONS, contained: float = CONTAINED, missed: float = MISSED) -> int:
    """Largest number of hits that a contained item reaches but for a chance of ``missed``; one at least."""
    below, m = 0.0, 0
    while m < permutations:
        below += math.comb(permutations, m) * contained**m * (1 - contained) ** (permutations - m)
        if below > missed:
            break
        m += 1
    return max(1, m)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def _starts(words: str, n: int) -> Column:
    """Places of all shingles; a text of fewer words has its whole sequence, one without words has none."""
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0))))


def window_lengths(items: DataFrame, n: int) -> list[int]:
    """The lengths of shingles that items ask for: ``n``, and the whole length of items of fewer words. At most n values."""
    words = F.size(_tokens(F.col("text")))
    return sorted({n, *[r[0] for r in items.select(F.least(words, F.lit(n))).distinct().collect() if r[0] > 0]})


def _of_length(n: int, window: Callable[[int, Column], Column]) -> Callable[[Column], Column]:
    return lambda i: window(n, i)


def _every(words: str, lengths: list[int], window: Callable[[int, Column], Column]) -> Column:
    """Windows of all lengths; but for the longest only where a text has so many words."""
    parts = [F.transform(_starts(words, max(lengths)), lambda i: window(max(lengths), i))]
    for n in lengths[:-1]:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n))
        parts.append(F.coalesce(F.transform(starts, _of_length(n, window)), F.array()))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _with_hashes(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``hashes``: the distinct hashes of the shingles of ``text``."""
    df = df.withColumn("_words", _tokens(F.col("text"))).withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    # null past the end of a short text does not count in a hash
    windows = _every("_words", lengths, lambda n, i: F.xxhash64(*[F.get("_h", i + k) for k in range(n)]))
    return settled(df.withColumn("hashes", F.array_distinct(windows)).drop("_words", "_h"), "hashes")


def _with_shingles(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``shingle``, a row for each distinct one of ``text``."""
    df = df.withColumn("_words", _tokens(F.col("text")))
    windows = _every("_words", lengths, lambda n, i: F.array_join(F.slice("_words", i + 1, n), " "))
    df = settled(df.withColumn("_shingles", F.array_distinct(windows)), "_shingles")
    return df.withColumn("shingle", F.explode("_shingles")).drop("_words", "_shingles", "text")


def sketches(items: DataFrame, n: int = WORDS, contained: float = CONTAINED) -> DataFrame:
    """(item_key, h, weight, least, hits) of (item_key, text): sketch hashes, how many permutations each stands for,
    the shingles that a document must have, and the hits that make a candidate."""
    hashed = _with_hashes(items, [n]).where(F.size("hashes") > 0)
    q = F.size("hashes")
    own = q <= PERMUTATIONS
    least = F.ceil(q * contained - 1e-9).cast("int")
    rows = hashed.select(
        "item_key", least.alias("least"), F.when(own, least).otherwise(F.lit(needed_hits(PERMUTATIONS, contained))).alias("hits"),
        # an item that is its own sketch needs no permutation
        F.when(own, F.lit(1)).otherwise(F.lit(PERMUTATIONS)).alias("seeds"), F.explode("hashes").alias("h"))
    seeded = rows.withColumn("seed", F.explode(F.sequence(F.lit(1), "seeds")))
    whole = seeded.where("seeds = 1").select("item_key", "h", "least", "hits")
    least_of = seeded.where("seeds > 1").groupBy("item_key", "seed", "least", "hits").agg(F.min_by("h", F.xxhash64("h", "seed")).alias("h"))
    return whole.unionByName(least_of.drop("seed")).groupBy("item_key", "h", "least", "hits").agg(F.count(F.lit(1)).alias("weight"))


def _key(text: str) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def contaminated_texts(docs: DataFrame, items: DataFrame, n: int = WORDS, contained: float = CONTAINED) -> DataFrame:
    """(text_key, item_key, shared, item_shingles) for each distinct text of ``docs`` and each distinct item text it contains."""
    items = items.where("item_id IS NOT NULL").select(_key("text").alias("item_key"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    lengths = window_lengths(items, n)
    sketch = sized(sketches(items, n, contained), "sketches", BROADCAST_ROWS)
    keyed = docs.select(_key("text").alias("text_key"), "text")
    hashed = _with_hashes(keyed, lengths).select("text_key", F.size("hashes").alias("size"), F.explode("hashes").alias("h"))
    # copies of a text hit alike and are merged before the exchange
    hits = hashed.join(sketch, "h").where("size >= least").select("text_key", "item_key", "h", "weight", "hits").distinct()
    candidates = stored(
        hits.groupBy("text_key", "item_key").agg(F.sum("weight").alias("met"), F.max("hits").alias("hits")).where("met >= hits")
        .select("text_key", "item_key"), "candidates")
    shingles = _with_shingles(items, [n]).join(candidates.select("item_key").distinct(), "item_key", "left_semi")
    shingles = sized(shingles, "item-shingles", BROADCAST_ROWS)
    sizes = shingles.groupBy("item_key").agg(F.count(F.lit(1)).alias("item_shingles"))
    keys = sized(candidates.select("text_key").distinct(), "candidate-texts", BROADCAST_ROWS)
    texts = keyed.join(keys, "text_key", "left_semi").groupBy("text_key").agg(F.min("text").alias("text"))
    shared = (
        _with_shingles(texts, lengths).join(shingles, "shingle").groupBy("text_key", "item_key").agg(F.count(F.lit(1)).alias("shared"))
        .join(candidates, ["text_key", "item_key"], "left_semi").join(sizes, "item_key")
    )
    return stored(shared.where(F.col("shared") >= F.ceil(F.col("item_shingles") * contained - 1e-9)), "contaminated")


def find(docs: DataFrame, items: DataFrame, n: int = WORDS, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, item_id, containment, shared, item_shingles): a row for each row of ``docs`` and item it contains.

    ``docs`` has (doc_id, text), ``items`` (item_id, text). An item is contained
    if at least ``contained`` of its distinct shingles of ``n`` words stand
    anywhere in the text; one of fewer words, if its words stand there one after
    the other. Texts without words, null and empty ones, neither contain nor are
    contained. Repeated documents and null ids give their own rows. Every text
    of a repeated item id is searched, and the one contained best gives the row;
    a null item id stands for nothing. Texts of any length are read whole; a
    task holds the words and shingles of one text at a time, about 100 bytes for
    each word. Other columns are left out, so their names can't clash.
    """
    found = contaminated_texts(docs, items, n, contained)
    named = found.join(items.where("item_id IS NOT NULL").select("item_id", _key("text").alias("item_key")).distinct(), "item_key")
    share = F.round(F.col("shared") / F.col("item_shingles"), 6)
    best = named.groupBy("text_key", "item_id").agg(F.max(F.struct(share.alias("containment"), "shared", "item_shingles")).alias("best"))
    rows = docs.select("doc_id", _key("text").alias("text_key")).join(best, "text_key")
    return rows.select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, items: DataFrame, n: int = WORDS, contained: float = CONTAINED) -> DataFrame:
    """The rows of ``docs`` whose text contains no item, all columns kept, whatever their names; null and empty texts stay."""
    found = contaminated_texts(docs.select("text"), items, n, contained)
    bad = sized(found.select("text_key").distinct(), "contaminated-texts", BROADCAST_ROWS)
    names = docs.columns
    kept = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), _key("text").alias("text_key")).join(bad, "text_key", "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in names])
