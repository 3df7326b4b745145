"""Quality rules, line first: lines that fail a rule go, then texts that lose too much go.

Each line is held against punctuation, navigation and boilerplate rules. What is
left is the cleaned text; a document stays if enough of its characters and words
are left and it does not fail the document rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.shared import BLANK, WORD, free_name, settled, words_of

# The signs that count as symbols, and the limits of the document rules.
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5

# What ends a sentence, what navigation and boilerplate lines hold.
SENTENCE_END = r"[.!?…。！？:;,\"'”’»)\]][\x20\x09-\x0D]*$"
NAVIGATION = r"(?i)^[\x20\x09-\x0D]*(home|menu|next|previous|back to top|read more|log ?in|sign (in|up)|share|tweet|print|search|skip to content|all rights reserved)[\x20\x09-\x0D.!»>]*$"
BOILERPLATE = r"(?i)(lorem ipsum|javascript|cookie policy|privacy policy|terms of (use|service)|use cookies|^[\x20\x09-\x0D]*copyright\b|click here)"

#: A line is noise if more than one character in this many is a symbol.
SYMBOL_EVERY = 12
#: A line of at least this many words that ends without punctuation fails.
OPEN_WORDS = 12


def line_fault(line: Column) -> Column:
    """Why a line goes, or null: ``symbols``, ``shouting``, ``navigation``, ``boilerplate``, ``open``."""
    size = F.length(line)
    return (
        F.when(F.regexp_count(line, F.lit(SYMBOLS)) * SYMBOL_EVERY > size, "symbols")
        .when((F.regexp_count(line, F.lit(r"\p{Lu}")) * 2 > size) & (size >= 20), "shouting")
        .when(line.rlike(NAVIGATION), "navigation")
        .when(line.rlike(BOILERPLATE), "boilerplate")
        .when(~line.rlike(SENTENCE_END) & (F.regexp_count(line, F.lit(WORD)) >= OPEN_WORDS), "open")
    )


def with_repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """All rows with the number of words in a window of five words that the text holds twice or more.

    Arrays are columns of their own, step by step: an array spelled out inside a
    function of its elements would be made anew for each of them. Only a text
    with equal windows pays for finding where they are.
    """
    def twice(p: Column, k: Column) -> Column:
        # neighbours in the order of (hash, place); past either end get() gives null
        before, after = F.get("_placed", k - 1), F.get("_placed", k + 1)
        return F.when(before["h"].eqNullSafe(p["h"]) | after["h"].eqNullSafe(p["h"]), p["i"])

    steps = {
        "_hashes": F.transform(words, lambda w: F.xxhash64(w)),
        "_windows": F.when(F.size(words) > WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]))),
        "_again": F.size(F.array_distinct("_windows")) < F.size("_windows"),
        "_placed": F.when(F.col("_again"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
        "_places": F.sort_array(F.array_compact(F.transform("_placed", twice))),
        "_next": F.slice("_places", F.lit(2), F.size("_places")),
        # a window adds its five words, or those up to the next such window
        "_added": F.zip_with("_places", "_next", lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        out: F.coalesce(F.aggregate("_added", F.lit(0), lambda total, x: total + x), F.lit(0)).cast("long"),
    }
    for name, value in steps.items():
        df = df.withColumn(name, value)
    return df.drop(*[name for name in steps if name != out])


#: Columns that exist on the way only.
_STEPS = ("_lines", "_hashes", "_windows", "_again", "_placed", "_places", "_next", "_added", "_settled")


def clean(docs: DataFrame, text: str = "text", most_lost: float = 0.4) -> DataFrame:
    """All rows with the counts, the cleaned text and the verdict of the rules.

    Added: ``words`` (array), ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` (long), ``base_failed``, ``line_faults``
    (fault by line, null where a line stays), ``clean_text``, ``lost`` (share of
    the non-blank characters that went) and ``kept``. Columns of these names are
    replaced, all others stay whatever their names. Null and empty texts have no
    words and are rejected. A blank line is neither kept nor lost. A line equal to
    an earlier one counts as a duplicate but stays: only its own content judges
    it. Repeated rows are judged each. A text of any length is read whole; a task
    holds its words and lines, about 100 bytes for each word.
    """
    aside = {c: free_name(docs, f"{c}_kept") for c in docs.columns if c.lower() in _STEPS}
    back = {v: k for k, v in aside.items()}
    return _clean(docs.withColumnsRenamed(aside), aside.get(text, text), most_lost).withColumnsRenamed(back)


def _clean(docs: DataFrame, text: str, most_lost: float) -> DataFrame:
    added = ("words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "line_faults",
             "clean_text", "lost", "kept")
    docs = docs.drop(*added)
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
    first = docs.withColumns({"words": words_of(F.col(text)), "_lines": lines, "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long")})
    counted = with_repeated_words(first, "words", "n_repeat_words").withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "line_faults": F.transform("_lines", line_fault),
    })
    stay = F.filter("_lines", lambda x, i: F.get("line_faults", i).isNull())
    judged = counted.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        "clean_text": F.array_join(stay, "\n"),
    })
    left = F.length(F.regexp_replace("clean_text", BLANK + "+", ""))
    judged = judged.withColumn("lost", F.when(F.col("word_chars") > 0, 1 - left / F.col("word_chars")).otherwise(F.lit(0.0)))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= most_lost)).drop("_lines")
    return settled(judged, *added)
