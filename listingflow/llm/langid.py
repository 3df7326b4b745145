"""Language ID: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

Subwords are 2 to 4 neighbouring letters of a lower-cased word, its edges
included. Their embeddings are averaged over the whole text. Because the classes
are linear in that average, embedding times class weights is one table once
training is over, and a text's classes are an average of table rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.chars import LETTER, chunks, joined, mixed, sums, tables
from listingflow.llm.shared import importable, stored

BITS, DIM, SIZES = 16, 16, (2, 3, 4)
#: What a text without letters is called.
UNKNOWN = "und"


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each subword size: hashed subwords of texts one after the other, and their bounds by text."""
    points, nuls = joined(texts)
    kind, low = tables()
    letters = np.where(kind[points] == LETTER, low[points], 0).astype(np.uint64)
    keep = letters != 0
    keep[1:] |= letters[:-1] != 0
    keep[0] = True
    starts = np.cumsum(keep)[nuls] - 1  # the blank before each text, shared with the text before
    seq = letters[keep]
    for n in SIZES:
        count = len(seq) - n + 1
        if count <= 0:
            yield np.empty(0, np.int64), np.zeros(len(nuls), np.int64)
            continue
        h = np.full(count, n, np.uint64)
        inside = np.ones(count, bool)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + seq[k:k + count]
            if 0 < k < n - 1:
                inside &= seq[k:k + count] != 0
        at = np.flatnonzero(inside)
        yield (mixed(h[at]) & np.uint64((1 << BITS) - 1)).astype(np.int64), np.searchsorted(at, starts)


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    table: np.ndarray  # a row of class values per hashed subword
    bias: np.ndarray
    temperature: float
    floor: float  # probabilities below it are rejected

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated class probabilities of each text, and whether it has a letter."""
        out = np.zeros((len(texts), len(self.classes)))
        some = np.zeros(len(texts), bool)
        for first, part in chunks(texts):
            total, count = 0, 0
            for index, bounds in subwords(part):
                total = total + sums(self.table[index], bounds)
                count = count + np.diff(bounds)
            rows = slice(first, first + len(part))
            out[rows] = softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)
            some[rows] = count > 0
        return out, some


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


Example = tuple[int, np.ndarray, np.ndarray]


def train(classes: tuple[str, ...], examples: list[Example], passes: int = 3, rate: float = 2.0, seed: int = 11,
          precision: float = 0.995) -> Model:
    """SGD over (class, subwords, shares), a falling rate, then a temperature and a floor from every fifth example.

    The temperature makes the likelihood of the kept-back examples largest; the
    floor is the smallest probability above which they are right as often as
    ``precision`` asks.
    """
    rng = np.random.default_rng(seed)
    embed = (rng.random((1 << BITS, DIM)) - 0.5) / DIM
    weight, bias = np.zeros((DIM, len(classes))), np.zeros(len(classes))
    weight += rng.normal(0, 0.1, weight.shape)
    held = examples[::5] if len(examples) >= 50 else examples
    used = [e for i, e in enumerate(examples) if i % 5] if len(examples) >= 50 else examples
    steps, done = max(1, passes * len(used)), 0
    for _ in range(passes):
        for label, index, share in used:
            mean = share @ embed[index]
            g = softmax(mean @ weight + bias)
            g[label] -= 1
            lr = rate * (1 - done / steps)
            back = weight @ g
            weight -= lr * np.outer(mean, g)
            bias -= 0.1 * lr * g
            embed[index] -= lr * 30 * share[:, None] * back
            done += 1
    table = embed @ weight
    logits = np.array([share @ table[index] + bias for _, index, share in held]).reshape(-1, len(classes))
    truth = np.array([label for label, _, _ in held], int)
    heats = np.geomspace(0.05, 5, 60)
    right = np.arange(len(truth))
    losses = [-np.log(np.maximum(softmax(logits / t)[right, truth], 1e-12)).mean() for t in heats] if len(truth) else [0.0] * len(heats)
    heat = float(heats[int(np.argmin(losses))])
    p = softmax(logits / heat) if len(truth) else np.zeros((0, len(classes)))
    best = p.max(axis=1) if len(truth) else np.zeros(0)
    order = np.argsort(-best)
    hits = np.cumsum((p.argmax(axis=1) == truth)[order]) / (right + 1) if len(truth) else np.zeros(0)
    good = np.flatnonzero(hits >= precision)
    floor = float(best[order][good[-1]]) if len(good) else 1.0
    return Model(classes, table.astype(np.float32), bias, heat, floor)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {"order": [], "lang": [], "index": [], "share": []}
        texts, langs, order = (batch.column(c).to_pylist() for c in ("text", "lang", "order"))
        for i, text in enumerate(texts):
            parts = [index for index, _ in subwords([text or ""])]
            found, times = np.unique(np.concatenate(parts), return_counts=True)
            rows["order"].append(order[i])
            rows["lang"].append(langs[i])
            rows["index"].append(found.astype(np.int32).tobytes())
            rows["share"].append((times / max(times.sum(), 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
            ("order", pa.int64()), ("lang", pa.string()), ("index", pa.binary()), ("share", pa.binary())]))


def fit(docs: DataFrame, per_lang: int = 800, most: int = 160_000) -> Model:
    """Train on (doc_id, text, lang): every language, of each at most ``per_lang`` rows.

    With many languages each gives fewer rows, so that there are ``most`` in all,
    or one of each if there are more languages. Rows with the smallest hash of
    their id are taken; a repeated id teaches once. Rows with a null id or
    language teach nothing, nor do texts without letters. Without any example
    every text is unknown.
    """
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang").distinct()
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("doc_id")).alias("first")), "languages")
    langs = sizes.count()
    per_lang = max(1, min(per_lang, most // max(langs, 1)))
    # Hashes are uniform: this leaves about 1.5 * per_lang ids of a language before they meet in a task, and one at least.
    order = F.xxhash64("doc_id")
    near = F.shiftrightunsigned(order, 33) < F.lit((1.5 * per_lang + 20) * 2.0**31) / F.col("n")
    ids = known.join(F.broadcast(sizes) if langs <= most else sizes, "lang").where(near | (order == F.col("first"))).select("doc_id", "lang", order.alias("order"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    chosen = ids.withColumn("rank", rank).where(F.col("rank") <= per_lang).drop("rank")
    chosen = F.broadcast(chosen) if langs <= most else chosen  # at most ``most`` ids
    importable(docs.sparkSession)
    rows = (
        docs.select("doc_id", "text", "lang").join(chosen, ["doc_id", "lang"])
        .groupBy("order", "doc_id", "lang").agg(F.min("text").alias("text")).select("order", "lang", "text")
        .mapInArrow(_examples, "order long, lang string, index binary, share binary").toArrow()
    ).sort_by([("order", "ascending"), ("lang", "ascending"), ("index", "ascending")])
    names = tuple(sorted(set(rows.column("lang").to_pylist())))
    examples = [
        (names.index(lang), np.frombuffer(index, np.int32), np.frombuffer(share, np.float32))
        for lang, index, share in zip(*(rows.column(c).to_pylist() for c in ("lang", "index", "share")), strict=True)
        if index
    ]
    return train(names or (UNKNOWN,), examples)


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """All rows with a struct (lang, score, rejected).

    ``lang`` is the likeliest learned language, ``score`` its calibrated
    probability, ``rejected`` says that it lies below the calibrated floor. A
    null text or one without a letter is ``und`` with score 0, rejected. A
    column named like ``out`` is replaced.
    """
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS rows of classes

    @F.arrow_udf("lang string, score double, rejected boolean")
    def predicted(texts: pa.Array) -> pa.Array:
        m = shared.value
        p, some = m.probabilities(texts.to_pylist())
        best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
        score = np.where(some, p.max(axis=1), 0.0) if len(p) else np.zeros(0)
        lang = [m.classes[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(~some | (score < m.floor), pa.bool_())],
            names=["lang", "score", "rejected"])

    return docs.withColumn(out, predicted(F.col(text)))


def kept_language(prediction: Column) -> Column:
    """The predicted language, or ``und`` where it is rejected."""
    return F.when(prediction["rejected"], F.lit(UNKNOWN)).otherwise(prediction["lang"])
