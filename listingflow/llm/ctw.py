"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A byte is eight binary choices; each choice has a tree of contexts, the bytes
before it. A node holds Krichevsky-Trofimov estimates from all training bytes in
its context, and a context's own estimate is mixed with those of its longer
contexts by the probability that each gives the training data. With the counts
fixed, the mixture over all depths is one distribution per leaf, so scoring a
byte is finding its leaf.

The tree has every context up to ``DEPTH`` bytes that stands in the training texts, so
it grows with them. ``table`` works it out in Spark and gives the finished value of each
(context, byte): a task has the parts of the tree below some contexts of ``TOP`` bytes, a
run of them at a time, what lies above is one aggregation and one join for each depth.
``fit`` is the form for one process: it takes the contexts with at least one byte in
``share`` of the training bytes, and a context's rarer extensions share one leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.chars import sums
from listingflow.llm.shared import stored

DEPTH, TOP = 5, 3
#: Rows of a task's part of the tree that are worked on together; a context of TOP bytes stays whole.
RUN = 1 << 17


def laid(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes, each with ``depth`` zeros before and a zero that ends it; places that are predicted, and bounds by text."""
    pad = bytes(depth)
    data = np.frombuffer(b"".join([pad + t + b"\0" for t in texts]), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(bounds[-1]) + np.repeat(np.arange(1, len(texts) + 1) * depth, sizes)
    return data, places, bounds


def _keys(data: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    keys = np.zeros(len(places), np.int64)
    for k in range(depth + 1):
        keys |= data[places - k].astype(np.int64) << (8 * k)
    return keys


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, byte) of the texts and their counts; the byte is the lowest, then the latest context byte."""
    data, places, _ = laid(texts, depth)
    return np.unique(_keys(data, places, depth), return_counts=True)


def placed(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, byte) of the texts, the place there of each byte that is predicted, and bounds by text."""
    data, places, bounds = laid(texts, depth)
    keys = pa.array(_keys(data, places, depth)).dictionary_encode()
    return keys.dictionary.to_numpy(), keys.indices.to_numpy(), bounds


def lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive arguments (Stirling's series after moving up by eight)."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    for k in range(8):
        series = series - np.log(x + k)
    return series


def _choices(counts: np.ndarray) -> np.ndarray:
    """Counts under each of 511 prefixes of a byte: place 1 is the empty prefix, 2i and 2i + 1 add a bit."""
    heap = np.zeros((len(counts), 512))
    heap[:, 256:] = counts
    for size in (128, 64, 32, 16, 8, 4, 2, 1):
        heap[:, size:2 * size] = heap[:, 2 * size:4 * size:2] + heap[:, 2 * size + 1:4 * size:2]
    return heap


def _evidence(heap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability that KT gives the counts of each choice, and its estimate of a one."""
    zeros, ones = heap[:, 0::2].copy(), heap[:, 1::2].copy()
    zeros[:, 0] = ones[:, 0] = 0
    total = zeros + ones
    log = np.where(total > 0, lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(total + 1) - math.log(math.pi), 0.0)
    return log, ((ones + 0.5) / (total + 1)).astype(np.float32)


def _measured(counts: np.ndarray, rows: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """The evidence of many contexts, some rows at a time: the steps between need several times the result."""
    log, one = np.empty((len(counts), 256)), np.empty((len(counts), 256), np.float32)
    for a in range(0, len(counts), rows):
        log[a:a + rows], one[a:a + rows] = _evidence(_choices(counts[a:a + rows]))
    return log, one


def _log_bytes(p: np.ndarray) -> np.ndarray:
    """Log10 probabilities of all bytes from the probabilities of a one at each choice."""
    out = np.zeros((len(p), 512))
    for size in (1, 2, 4, 8, 16, 32, 64, 128):
        here = p[:, size:2 * size]
        out[:, 2 * size:4 * size:2] = out[:, size:2 * size] + np.log10(1 - here)
        out[:, 2 * size + 1:4 * size:2] = out[:, size:2 * size] + np.log10(here)
    return out[:, 256:].astype(np.float32)


@dataclass(frozen=True)
class Model:
    step: np.ndarray  # by inner node and byte: the next inner node, or -1 - leaf
    leaves: np.ndarray  # by leaf and byte: log10 of its probability
    depth: int

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Log10 probability of each text with its end."""
        data, places, bounds = laid(texts, self.depth)
        state = self.step[0][data[places - 1]] if self.depth else np.full(len(places), -1)
        for k in range(2, self.depth + 1):
            inner = np.flatnonzero(state >= 0)
            state[inner] = self.step[state[inner], data[places[inner] - k]]
        return sums(self.leaves[-1 - state, data[places]], bounds)


def build(levels: list[tuple[np.ndarray, np.ndarray]], depth: int = DEPTH) -> Model:
    """The model of (contexts, counts by byte) for each depth from none up; contexts are sorted."""
    while len(levels) > 1 and not len(levels[-1][0]):
        levels = levels[:-1]
    last = len(levels) - 1
    parents = [None] + [np.searchsorted(levels[d - 1][0], levels[d][0] & ((1 << (8 * (d - 1))) - 1)) for d in range(1, last + 1)]
    below: np.ndarray | None = None  # log probability of the data by a node's longer contexts, for the depth above
    own_weight, estimate, other = [None] * (last + 1), [None] * (last + 1), [None] * (last + 1)
    inner = [np.zeros(len(levels[d][0]), bool) for d in range(last + 1)]
    for d in range(last, -1, -1):
        counts = levels[d][1]
        log, estimate[d] = _measured(counts)
        if d < last:
            inner[d][parents[d + 1]] = True
            rest = counts.copy()
            np.subtract.at(rest, parents[d + 1], levels[d + 1][1])
            rest_log, other[d] = _measured(rest)
            longer = rest_log + below
            own_weight[d] = np.where(inner[d][:, None], 1 / (1 + np.exp(np.clip(longer - log, -700, 700))), 1.0).astype(np.float32)
            weighted = np.where(inner[d][:, None], np.logaddexp(log, longer) - math.log(2), log)
        else:
            own_weight[d], weighted = np.ones(log.shape, np.float32), log
        if d:
            below = np.zeros((len(levels[d - 1][0]), 256))
            np.add.at(below, parents[d], weighted)
    # From the root down: what shorter contexts add, and the weight that is left for longer ones.
    step, leaves, rows = [], [], 0
    number = [np.cumsum(i) - 1 for i in inner]
    base = np.concatenate(([0], np.cumsum([int(i.sum()) for i in inner])))
    add, left = np.zeros_like(estimate[0]), np.ones_like(estimate[0])
    for d in range(last + 1):
        leaf = ~inner[d]
        mixed = add + left * own_weight[d] * estimate[d]
        leaf_rows = np.full(len(leaf), -1)
        leaf_rows[leaf] = rows + np.arange(int(leaf.sum()))
        leaves.append(_log_bytes(mixed[leaf]))
        rows += int(leaf.sum())
        if d:  # what leads here from the depth above
            last_byte = (levels[d][0] >> (8 * (d - 1))) & 255
            step[d - 1][number[d - 1][parents[d]], last_byte] = np.where(leaf, -1 - leaf_rows, base[d] + number[d])
        if d < last:
            remain = left * (1 - own_weight[d])
            leaves.append(_log_bytes((mixed + remain * other[d])[inner[d]]))
            size = int(inner[d].sum())
            step.append(np.repeat(-1 - (rows + np.arange(size)), 256).reshape(size, 256))
            rows += size
            add, left = mixed[parents[d + 1]], remain[parents[d + 1]]
    steps = np.concatenate(step).astype(np.int32) if step and base[-1] else np.full((1, 256), -1, np.int32)
    return Model(steps, np.concatenate(leaves), depth)


def fit(counts: DataFrame, depth: int, share: int) -> Model:
    """The model of (key, n): how often each (context, byte) stands in the training texts. No rows: all bits are even."""
    total = counts.agg(F.sum("n")).head()[0] or 0
    mask = F.expr("CASE depth " + " ".join(f"WHEN {d} THEN {(1 << (8 * d)) - 1}L" for d in range(depth + 1)) + " END")
    each = counts.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in range(depth + 1)])))
    pairs = each.groupBy("depth", F.shiftright("key", 8).bitwiseAND(mask).alias("context"), F.col("key").bitwiseAND(F.lit(255)).alias("byte")).agg(F.sum("n").alias("n"))
    pairs = stored(pairs, "context-bytes")
    known = pairs.groupBy("depth", "context").agg(F.sum("n").alias("all")).where(F.col("all") * share >= total).drop("all")
    rows = pairs.join(known, ["depth", "context"]).toArrow()  # share contexts per depth at most
    levels = []
    for d in range(depth + 1):
        here = rows.filter(pa.compute.equal(rows.column("depth"), d))
        context, byte, n = (here.column(c).to_numpy() for c in ("context", "byte", "n"))
        names, place = np.unique(context, return_inverse=True)
        table = np.zeros((max(len(names), int(d == 0)), 256))
        table[place, byte] = n
        levels.append((names if len(names) or d else np.zeros(1, np.int64), table))
    del rows
    return build(levels, depth)


def _lgamma(x: Column) -> Column:
    """As ``lgamma``; the eight steps are one product."""
    y = x + 8
    steps = x
    for k in range(1, 8):
        steps = steps * (x + k)
    series = F.lit(1 / 12) / y - F.lit(1 / 360) / (y * y * y) + F.lit(1 / 1260) / (y * y * y * y * y)
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series - F.ln(steps)


def _level(rows: DataFrame) -> DataFrame:
    """Of (context, choice, zeros, ones, below): weighted evidence, a context's own weight, its estimate of a one."""
    zeros, ones = F.col("zeros"), F.col("ones")
    log = F.when(zeros + ones > 0, _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1) - math.log(math.pi)).otherwise(0.0)
    rows = rows.withColumn("log", log).withColumn("gap", F.col("below") - F.col("log"))
    own = 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("gap")))))
    return rows.select(
        "context", "choice", "zeros", "ones", (F.greatest("log", "below") + F.log1p(F.exp(-F.abs("gap"))) - math.log(2)).alias("weighted"),
        own.alias("own"), ((ones + 0.5) / (zeros + ones + 1)).alias("estimate"))


def _factorials(counts: np.ndarray, plus: float, tables: dict[float, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """lgamma of whole numbers plus a half or one, the small ones from a table that stays."""
    if plus not in tables:
        tables[plus] = lgamma(np.arange(1 << 12) + plus)
    small = tables[plus]
    out = small[np.minimum(counts, len(small) - 1).astype(np.int64)]
    large = np.flatnonzero(counts >= len(small))
    out[large] = lgamma(counts[large] + plus)
    return out


@dataclass(frozen=True)
class Part:
    """The choices of all contexts of one depth; codes are context and choice, sorted."""
    codes: np.ndarray
    lower: np.ndarray  # place here of each choice one depth below; at the last depth, of the eight choices of each key
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    own: np.ndarray
    estimate: np.ndarray


def parts(keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[list[Part], np.ndarray]:
    """The tree of distinct keys from ``depth`` up to ``top``, and the bits of each key."""
    byte, j = (keys & 255)[:, None], np.arange(8)
    bits = (byte >> (7 - j)) & 1
    codes = ((keys >> 8 << 8)[:, None] | (1 << j) | (byte >> (8 - j))).ravel()
    zeros, ones = (n[:, None] * (1 - bits)).ravel(), (n[:, None] * bits).ravel()
    below, out = None, []
    for d in range(depth, top - 1, -1):
        names, place = np.unique(codes & ((1 << (8 * d + 8)) - 1), return_inverse=True)
        zeros, ones = (np.bincount(place, x, len(names)) for x in (zeros, ones))
        log = _factorials(zeros, 0.5) + _factorials(ones, 0.5) - _factorials(zeros + ones, 1.0) - math.log(math.pi)
        log[zeros + ones == 0] = 0
        if d == depth:
            weighted, own = log, np.ones(len(names))
        else:
            longer = np.bincount(place, below, len(names))
            weighted, own = np.logaddexp(log, longer) - math.log(2), 1 / (1 + np.exp(np.clip(longer - log, -700, 700)))
        out.append(Part(names, place, zeros, ones, weighted, own, (ones + 0.5) / (zeros + ones + 1)))
        codes, below = names, weighted
    return out, bits


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Whole contexts of rows sorted by context, about ``size`` rows at a time."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            table = pa.Table.from_batches(held)
            context = table.column("context").to_numpy()
            end = int(np.searchsorted(context, context[-1]))
            if end:
                yield table.slice(0, end)
            held = table.slice(end).combine_chunks().to_batches()
            rows -= end
            size = max(size, rows * 2) if not end else size
    if rows:
        yield pa.Table.from_batches(held)


def _up(depth: int, top: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, size):
            t = parts(table.column("key").to_numpy(), table.column("n").to_numpy(), depth, top)[0][-1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (t.codes >> 8, t.codes & 255, t.zeros, t.ones, t.weighted)],
                                             names=["context", "choice", "zeros", "ones", "weighted"])

    return run


def _down(depth: int, top: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, size):
            given = table.filter(pa.compute.is_null(table.column("key")))
            table = table.filter(pa.compute.is_valid(table.column("key")))
            keys = table.column("key").to_numpy()
            levels, bits = parts(keys, table.column("n").to_numpy(), depth, top)
            codes = given.column("context").to_numpy() << 8 | given.column("choice").to_numpy()
            order = np.argsort(codes)  # the same codes as the highest part has
            add, left = (given.column(c).to_numpy()[order] for c in ("above", "weight"))
            for k in range(len(levels) - 1, -1, -1):
                t = levels[k]
                add, left = add + left * t.own * t.estimate, left * (1 - t.own)
                add, left = add[t.lower], left[t.lower]
            one = add.reshape(-1, 8)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.log10(np.where(bits == 1, one, 1 - one)).sum(axis=1))], names=["key", "log"])

    return run


def table(counts: DataFrame, depth: int = DEPTH, top: int = TOP) -> DataFrame:
    """(key, log): log10 of the probability of each (context, byte) of (key, n), keys distinct, learned from the counts n.

    A key with n = 0 teaches nothing and still gets its value, so keys of texts
    that are only scored belong here too. A context of ``top`` bytes has at most
    256^(depth - top + 1) keys at any size of the corpus; a join key above has at
    most 256 rows.
    """
    top = min(top, depth)

    def mask(d: int) -> Column:
        return F.lit((1 << (8 * d)) - 1).cast("long")

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition("context").sortWithinPartitions("context")

    keys = counts.select(F.shiftright("key", 8).bitwiseAND(mask(top)).alias("context"), "key", "n")
    found = grouped(keys).mapInArrow(_up(depth, top, RUN), "context long, choice long, zeros double, ones double, weighted double")
    first = below = stored(found, f"contexts-{top}")
    levels = []
    for d in range(top - 1, -1, -1):
        rows = below.groupBy(F.col("context").bitwiseAND(mask(d)).alias("context"), "choice").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
        below = stored(_level(rows), f"contexts-{d}")
        levels.insert(0, below)
    # From the root down: what shorter contexts add, and the weight that is left for longer ones.
    state = None
    for d, level in enumerate([*levels, first]):
        if state is None:
            here = level.withColumns({"above": F.lit(0.0), "weight": F.lit(1.0)})
        else:
            parent = F.col("context").bitwiseAND(mask(d - 1))
            # at most 255 rows above depth 1, 65,280 above depth 2
            here = level.withColumn("parent", parent).join(F.broadcast(state) if d <= 2 else state, ["parent", "choice"]).drop("parent")
        if d < top:
            state = here.select(
                F.col("context").alias("parent"), "choice", (F.col("above") + F.col("weight") * F.col("own") * F.col("estimate")).alias("above"),
                (F.col("weight") * (1 - F.col("own"))).alias("weight"))
    both = here.select("context", "choice", "above", "weight").unionByName(keys, allowMissingColumns=True)
    return grouped(both).mapInArrow(_down(depth, top, RUN), "key long, log double")


def merged(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several counts, and their sums."""
    keys, counts = map(np.concatenate, zip(*parts, strict=True))
    names, place = np.unique(keys, return_inverse=True)
    return names, np.bincount(place, counts, len(names)).astype(np.int64)
