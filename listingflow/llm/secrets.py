"""Secret scans over an incremental blob ledger.

Every version of a file is addressed by the SHA-256 of its content. The ledger
holds one row for each blob and rule version that has been scanned, with what was
found in it. A run scans the blobs that the ledger lacks under its rule version,
once each however many paths and versions hold them, adds them, and joins the
findings back to all versions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listingflow.operators.skew import lookup_join


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` from left to right whose ``part`` has ``least`` characters."""

    kind: str
    pattern: str
    part: int = 0
    least: int = 0
    #: Texts with none of these, in lower case, have no match.
    hints: tuple[str, ...] = ()


# Kinds, patterns and least lengths of the base rules, in the order in which kinds are listed.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, ("akia",)),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
# Further kinds: headers of private keys, and tokens with a published prefix.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, ("private key-----",)),
    Rule("prefixed", r"\b(ghp|gho|ghs|xoxb|xoxp|glpat|sk_live)[_-][A-Za-z0-9_-]{16,}", 0, 0,
         ("ghp", "gho", "ghs", "xox", "glpat", "sk_live")),
)
RULES = BASE + MORE


def version_of(rules: tuple[Rule, ...]) -> str:
    """Other rules, or rules in another order, are another version."""
    return hashlib.sha256(repr([(r.kind, r.pattern, r.part, r.least) for r in rules]).encode()).hexdigest()[:16]


SPAN = "struct<start:int,place:int,kind:string,end:int>"


def _searched(rule: Rule) -> str:
    """A pattern whose matches are those of the rule that are long enough, where one exists; else the rule's own.

    A run of one class can ask for its length itself: a match that is long
    enough starts where the run starts, just as the shorter ones do.
    """
    if rule.pattern.startswith("[") and rule.pattern.endswith("]+") and rule.part == 0:
        return f"{rule.pattern[:-1]}{{{rule.least},}}"
    return rule.pattern


def _matches(text: Column, low: Column, rule: Rule) -> Column:
    """Gaps before the matches, lengths of the matches, and whether each counts; null where there is none."""
    pattern = _searched(rule)
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0))
    part = found if rule.part == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.part))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    rows = F.arrays_zip(gaps.alias("gap"), F.transform(found, F.length).alias("size"),
                        F.transform(part, lambda p: F.length(p) >= rule.least).alias("good"))
    hinted = F.lit(False) if rule.hints else text.rlike(pattern)
    for hint in rule.hints:
        hinted = hinted | F.contains(low, F.lit(hint))
    return F.when(hinted, rows)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of every row of (blob, content): spans in code points, end exclusive, by start and order of rules."""
    text = F.coalesce("content", F.lit(""))
    # the lower-cased copy only says which rules are worth trying
    rows = blobs.select("blob", text.alias("content"), F.lower(text).alias("low"))
    kinds = F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(r.kind).alias("kind"), _matches(F.col("content"), F.col("low"), r).alias("rows"))
        for i, r in enumerate(rules)
    ])
    tried = rows.select("blob", F.filter(kinds, lambda k: F.size(k["rows"]) > 1).alias("kinds"))
    each = tried.select("blob", F.explode_outer("kinds").alias("k")).select(
        "blob", "k.place", "k.kind", F.posexplode_outer("k.rows").alias("at", "m"))
    before = Window.partitionBy("blob", "place").orderBy("at")
    # what lies before a match: all gaps up to it and all matches before it
    past = F.sum(F.col("m.gap") + F.coalesce(F.col("m.size"), F.lit(0))).over(before) - F.col("m.size")
    spans = each.select("blob", F.col("m.good").alias("good"), F.struct(
        past.cast("int").alias("start"), "place", "kind", (past + F.col("m.size")).cast("int").alias("end")).alias("span"))
    return spans.groupBy("blob").agg(F.sort_array(F.collect_list(F.when(F.col("good"), F.col("span")))).alias("spans"))


class Ledger:
    """Scanned (blob, rule version) pairs with their spans, below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, version: str) -> str:
        return f"{self.path}/rules={version}"

    def read(self, version: str) -> DataFrame | None:
        """One row per blob scanned under a rule version, however many runs added it; None if there is none yet."""
        schema = f"blob string, spans array<{SPAN}>"
        try:
            # runs at the same time may have scanned the same blob; they found the same
            return self.spark.read.schema(schema).parquet(self._folder(version)).groupBy("blob").agg(F.first("spans").alias("spans"))
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def add(self, scanned: DataFrame, version: str) -> None:
        scanned.write.mode("append").parquet(self._folder(version))


def scan_versions(
    versions: DataFrame, ledger: Ledger, content: str = "content", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """All rows with ``blob`` (SHA-256 of the content) and ``spans``; columns of these names are replaced.

    Null content counts as empty. Equal contents are one blob and are scanned
    once; rows are never merged. A second run over the same rows scans nothing;
    other rules are another version and scan all. Extra columns may have any
    other name. A text of any length is scanned whole; a task holds its pieces,
    some 10 bytes for each character.
    """
    version = version_of(rules)
    text = F.coalesce(F.col(content), F.lit(""))
    blob = F.sha2(text.cast("binary"), 256)
    texts = versions.select(blob.alias("blob"), text.alias("content"))
    seen = ledger.read(version)
    if seen is not None:
        texts = texts.join(seen.select("blob"), "blob", "left_anti")
    unseen = texts.dropDuplicates(["blob"])  # copies go before the exchange
    ledger.add(scan(unseen, rules), version)
    # copies of one text may be a third of all rows
    return lookup_join(versions.drop("blob", "spans").withColumn("blob", blob), ledger.read(version), ["blob"], "inner")


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
