"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A token is a run of letters (lower-cased), of digits or of other signs. Features
are its hash and the hash of two neighbours; a token that repeats the one before
it, or the one before that, has a feature of its own, whatever the token. A text's
value of a feature is its count over the number of tokens, so the score is a
sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.chars import BLANK, chunks, joined, mixed, sums, tables
from listingflow.llm.shared import importable

BITS = 18
#: Features of a token that repeats the one before, or the one before that.
ONE_BACK, TWO_BACK = 0, 1
BASE = 0x100000001B3


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    up = np.full(n, BASE, np.uint64)
    down = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of texts one after the other (2^BITS: none), their bounds by text, and tokens by text."""
    points, nuls = joined(texts)
    kind, low = tables()
    kinds = kind[points]
    edge = np.flatnonzero(np.concatenate(([True], kinds[1:] != kinds[:-1])))
    ends = np.append(edge[1:], len(points))
    word = kinds[edge] != BLANK
    starts, ends = edge[word], ends[word]
    up, down = _powers(1 << max(20, int(len(points) - 1).bit_length()))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((low[points].astype(np.uint64) + np.uint64(1)) * up[:len(points)], dtype=np.uint64)))
    h = mixed((total[ends] - total[starts]) * down[starts])
    bounds = np.searchsorted(starts, nuls)
    mask, none = np.uint64((1 << BITS) - 1), 1 << BITS
    out = np.full((len(h), 3), none, np.int64)
    out[:, 0] = mixed(h + np.uint64(1)) & mask
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pair = mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) & mask
    pair[h[:-1] == h[1:]] = ONE_BACK
    out[1:, 1] = np.where(text[1:] == text[:-1], pair, none)
    out[2:, 2] = np.where((text[2:] == text[:-2]) & (h[2:] == h[:-2]), TWO_BACK, none)
    return out.reshape(-1), bounds * 3, np.diff(bounds)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # 2^BITS values and a zero for "no feature"
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each text; a text without tokens gets the bias alone."""
        out = np.empty(len(texts))
        for first, part in chunks(texts):
            index, bounds, counted = features(part)
            dots = sums(self.weights[index], bounds) / np.maximum(counted, 1)
            out[first:first + len(part)] = 1 / (1 + np.exp(-np.clip(SCALE * dots + self.bias, -40, 40)))
        return out


#: Shares are small numbers; this brings features of a few hundredths into the range where steps are useful.
SCALE = 10.0


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], passes: int = 3, alpha: float = 0.3, beta: float = 1.0,
          l1: float = 0.002, l2: float = 0.001) -> Model:
    """FTRL-proximal over (label, feature numbers, shares); per-coordinate steps, L1 and L2."""
    size = (1 << BITS) + 1
    bias = size - 1  # the last place holds the bias while training
    z, n = np.zeros(size), np.zeros(size)

    def weight(i: np.ndarray) -> np.ndarray:
        far = np.sign(z[i]) * l1
        far[i == bias] = 0
        w = -(z[i] - far) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where((np.abs(z[i]) <= l1) & (i != bias), 0.0, w)

    for _ in range(passes):
        for label, index, share in examples:
            i, x = np.append(index, bias), np.append(share * SCALE, 1.0)
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -40, 40)))
            g = (p - label) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    w = weight(np.arange(size))
    value = float(w[bias])
    w[bias] = 0
    return Model(w.astype(np.float32), value)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {"order": [], "label": [], "index": [], "share": []}
        texts, labels, order = (batch.column(c).to_pylist() for c in ("text", "label", "order"))
        for first, part in chunks(texts):
            index, bounds, counted = features(part)
            for k in range(len(part)):
                found, times = np.unique(index[bounds[k]:bounds[k + 1]], return_counts=True)
                real = found < 1 << BITS
                rows["order"].append(order[first + k])
                rows["label"].append(labels[first + k])
                rows["index"].append(found[real].astype(np.int32).tobytes())
                rows["share"].append((times[real] / max(counted[k], 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
            ("order", pa.int64()), ("label", pa.int32()), ("index", pa.binary()), ("share", pa.binary())]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> Model:
    """Train on at most ``max_rows`` labelled documents, those with the smallest hash of their id.

    ``docs`` has (doc_id, text), ``labels`` (doc_id, label). Null labels and ids
    are left out; several labels of one id count as the largest, and a repeated id
    teaches once. Without any labelled row the score is ½ everywhere.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    # at most max_rows pairs of numbers: safe to broadcast
    chosen = known.select("doc_id", F.col("label").cast("int").alias("label"), order.alias("order")).orderBy("order", "doc_id").limit(max_rows)
    importable(docs.sparkSession)
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("order", "doc_id", "label").agg(F.min("text").alias("text")).select("order", "label", "text")
        .mapInArrow(_examples, "order long, label int, index binary, share binary").toArrow()
    )
    rows = rows.sort_by([("order", "ascending"), ("index", "ascending")])
    examples = [
        (label, np.frombuffer(index, np.int32), np.frombuffer(share, np.float32))
        for label, index, share in zip(*(rows.column(c).to_pylist() for c in ("label", "index", "share")), strict=True)
    ]
    return train(examples)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows with the probability of label 1; null and empty texts are scored as texts without tokens.

    A column named like ``out`` is replaced.
    """
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size, 1 MB

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts.to_pylist()), pa.float64())

    return docs.withColumn(out, probability(F.col(text)))
