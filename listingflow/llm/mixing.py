"""Temperature mixing of sources to target weights, realised as budgeted block permutations.

A source's weight is its token share to the power of an exponent, normalised: one
keeps natural shares, zero makes all alike. The exponent is bisected until the
weights have a target entropy, or until no source is repeated more often than a
limit. A weight times the total budget is a source's budget. It is spent on whole
permutations of the source (epochs) and a last one cut at the budget. A
permutation orders blocks of a source by a seeded hash and rows within a block by
another, so no task ever holds a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.shared import WORD, stored

#: The exponent is a multiple of this power of two.
GRID = 1 << 24
#: Exponents that are tried in one pass over the sources.
FAN = 63
EXACT = "decimal(38,15)"


def tokens_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_totals(docs: DataFrame, source: str = "source", tokens: str = "tokens") -> DataFrame:
    """(source, rows, tokens) of all sources, some without tokens; rows without a source form one of their own (null)."""
    tokens = F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens")
    return stored(docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("rows"), tokens), "source-totals")


def blank_budgets(totals: DataFrame) -> DataFrame:
    """The sources without tokens, which no weight can reach: a budget of -1 stands for one whole epoch."""
    return totals.where("tokens = 0").select("source", "rows", "tokens", F.lit(0.0).alias("weight"), F.lit(-1).cast("long").alias("budget"))


def _sum(totals: DataFrame) -> int:
    return totals.agg(F.sum("tokens")).head()[0] or 1


def _bisect(totals: DataFrame, enough) -> int:
    """Largest grid step from 0 to GRID for which ``enough`` of the measures there holds; -1 if it holds nowhere.

    ``enough`` must hold below some step and nowhere above. Measures are taken
    over a fan of steps per pass and summed exactly, so they do not depend on
    the order of rows.
    """
    low, high = -1, GRID + 1
    share = F.col("tokens") / F.lit(_sum(totals))
    while high - low > 1:
        steps = sorted({low + (high - low) * i // (FAN + 1) for i in range(1, FAN + 1)} - {low})
        tried = totals.withColumn("k", F.explode(F.array(*[F.lit(k) for k in steps])))
        raw = F.pow(share, F.col("k") / GRID)
        sums = tried.groupBy("k").agg(
            F.sum(raw.cast(EXACT)).cast("double").alias("z"), F.sum((raw * F.ln(raw)).cast(EXACT)).cast("double").alias("s"),
            F.max(raw / share).alias("most"), F.min(raw / share).alias("least"))
        good = {r["k"]: enough(r) for r in sums.collect()}  # FAN rows at most
        low = max([low, *[k for k in steps if good.get(k)]])
        high = min([k for k in steps if k > low], default=high)
    return low


def exponent_for_entropy(totals: DataFrame, entropy: float) -> float:
    """Largest exponent from 0 to 1 at which the weights have at least this entropy (nats); 0 if none has."""
    return max(0, _bisect(totals, lambda r: math.log(r["z"]) - r["s"] / r["z"] >= entropy)) / GRID


def exponent_for_repeats(totals: DataFrame, repeats: float, budget: int | None) -> float:
    """Smallest exponent from 0 to 1 at which no source is used more than ``repeats`` times; 1 if there is none.

    ``budget`` None stands for the smallest budget that uses each source whole.
    """
    total = _sum(totals)

    def too_often(r) -> bool:
        times = r["most"] / r["least"] if budget is None else budget * r["most"] / (r["z"] * total)
        return times > repeats * (1 + 1e-12)

    return min(_bisect(totals, too_often) + 1, GRID) / GRID


def budgets(totals: DataFrame, exponent: float, budget: int | None) -> DataFrame:
    """(source, rows, tokens, weight, budget): whole tokens for each source.

    ``budget`` None gives each source its tokens at least, with no larger total than the weights need.
    """
    raw = totals.withColumn("raw", F.pow(F.col("tokens") / F.lit(_sum(totals)), F.lit(float(exponent))))
    whole = raw.agg(F.sum(F.col("raw").cast(EXACT)).cast("double").alias("z"), F.max(F.col("tokens") / F.col("raw")).alias("need")).head()
    out = raw.withColumn("weight", F.round(F.col("raw") / F.lit(whole["z"] or 1.0), 12))
    if budget is None:
        spend = F.ceil(F.round(F.lit(whole["need"] or 0.0) * F.col("raw"), 3))
    else:
        spend = F.floor(F.col("weight") * F.lit(int(budget)))
    return out.select("source", "rows", "tokens", "weight", spend.cast("long").alias("budget"))


def _hash(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))


def _hashable(df: DataFrame) -> list[str]:
    return [f"row.`{f.name}`" for f in df.schema.fields if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def _named(source: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def realise(docs: DataFrame, plan: DataFrame, key: str, source: str = "source", tokens: str = "tokens", seed: int = 7,
            block_rows: int = 512) -> DataFrame:
    """The rows of ``docs`` as often as their source's budget asks, with ``epoch``, ``block`` and ``at``.

    ``at`` counts the tokens of a source's budget spent before the row, so
    sorting by at / budget interleaves the sources at their weights. A row is
    taken if tokens of the budget are left before it; the last one may exceed
    it. Rows without tokens are taken in whole epochs only.
    """
    names = docs.columns
    sizes = plan.select(_named(F.col("source")).alias("_s"), F.col("tokens").alias("_all"), F.col("rows").alias("_rows"), F.col("budget").alias("_budget"))
    row = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), _named(F.col(f"`{source}`")).alias("_s"),
                      F.coalesce(F.col(f"`{tokens}`"), F.lit(0)).alias("_tokens"), F.col(f"`{key}`").alias("_key"))
    # one row per source: Spark broadcasts by size, else adaptive execution splits a hot source
    row = row.join(sizes, "_s")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_rows") / block_rows))
    whole = F.when(F.col("_all") > 0, F.expr("try_divide(_budget - pmod(_budget, nullif(_all, 0)), _all)")).otherwise(F.abs("_budget"))
    # of all columns, so that null or equal keys don't share a block
    hashed = F.conv(F.substring(_hash(seed, F.col("_key"), F.xxhash64("_s", *_hashable(docs))), 1, 8), 16, 10).cast("long")
    row = row.withColumns({"_block": F.pmod(hashed, blocks).cast("int"), "_epochs": whole.cast("int")})
    # whole epochs, and one more that the budget cuts
    epochs = F.col("_epochs") + F.when((F.col("_all") > 0) & (F.col("_budget") > F.col("_epochs") * F.col("_all")), 1).otherwise(0)
    spread = row.where(epochs > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    counts = spread.groupBy("_s", "_epoch", "_block").agg(F.sum("_tokens").alias("_n"))
    before = Window.partitionBy("_s", "_epoch").orderBy(_hash(seed + 1, F.col("_epoch"), F.col("_block")), "_block")
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = spread.join(stored(starts.drop("_n"), "block-starts"), ["_s", "_epoch", "_block"])
    order = Window.partitionBy("_s", "_epoch", "_block").orderBy(_hash(seed + 2, F.col("_epoch"), F.col("_key")), "_key", "_tokens")
    spent = F.coalesce(F.sum("_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("_at", F.col("_epoch") * F.col("_all") + F.col("_start") + spent)
    taken = placed.where((F.col("_epoch") < F.col("_epochs")) | ((F.col("_at") < F.col("_budget")) & (F.col("_tokens") > 0)))
    kept = [c for c in names if c not in ("epoch", "block", "at")]
    return taken.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("_epoch").cast("int").alias("epoch"),
                        F.col("_block").cast("int").alias("block"), F.col("_at").cast("long").alias("at"))


def mix(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens", source: str = "source", entropy: float | None = None,
        repeats: float | None = None, epochs: float | None = None, seed: int = 7, block_rows: int = 512) -> DataFrame:
    """The rows of ``docs``, mixed, with ``epoch``, ``block`` and ``at`` (columns of these names are replaced).

    Give a target ``entropy`` (nats) or a limit of ``repeats``. The budget is
    ``epochs`` times the sum of the column ``tokens`` (null counts as 0); None takes the smallest at which every
    source is used whole.
    Rows without a source are one source. A source without tokens can't be
    weighed: without a budget (``epochs`` None) it is used whole, once; a budget
    has nothing to spend on it and leaves its rows out. Repeated rows are rows of
    their own and keep their order by key and tokens; blocks are cut by a hash of
    the whole row, so only rows equal in all columns share one for sure. A text
    of any length is a row like others. No rows give no rows.
    """
    every = source_totals(docs, source, tokens)
    totals = every.where("tokens > 0")
    total = totals.agg(F.sum("tokens")).head()[0] or 0
    budget = None if epochs is None else int(total * epochs)
    if entropy is not None:
        exponent = exponent_for_entropy(totals, entropy)
    else:
        exponent = exponent_for_repeats(totals, repeats if repeats is not None else 1.0, budget)
    plan = budgets(totals, exponent, budget)
    plan = stored(plan.unionByName(blank_budgets(every)) if budget is None else plan, "budgets")
    return realise(docs, plan, key, source, tokens, seed, block_rows)
