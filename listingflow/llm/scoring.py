"""Scores of whole texts by the context-tree model, beside a word-count base.

One pass over the texts counts the training texts' words (by their XXH64, where two
of n words meet with a chance of n²/2^65) and all texts' byte contexts. Words with at
least one token in ``COMMON`` are at most COMMON many, so they are sent to all tasks;
the rest, none of which is hot, meet their counts in a join. So it is with the values of
the context tree: the ``KEYS`` most frequent at most are sent, the others are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm import ctw
from listingflow.llm.chars import sums
from listingflow.llm.shared import importable, stored

COMMON = 1 << 20
#: (context, byte) whose values are sent to all tasks; a bound on memory only, no score depends on it.
KEYS = 1 << 21
#: Bytes worked on together; a longer text is worked on alone.
CHUNK = 1 << 21
#: Words and bytes that teach, and bytes that are only scored.
WORD_ROW, BYTE_ROW, OTHER_ROW = 0, 1, 2


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows of about CHUNK bytes, with their texts in UTF-8; null is empty."""
    for batch in batches:
        texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in batch.column("text").to_pylist()]
        first, size = 0, 0
        for i, text in enumerate(texts):
            if i > first and size + len(text) > CHUNK:
                yield batch.slice(first, i - first), texts[first:i]
                first, size = i, 0
            size += len(text)
        if texts:
            yield batch.slice(first), texts[first:]


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, the place there of each token, and bounds by text."""
    split = [t.lower().split() for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in split]))).astype(np.int64)
    tokens = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in tokens.dictionary.to_pylist()), np.uint64, len(tokens.dictionary))
    return hashes.view(np.int64), tokens.indices.to_numpy(), bounds


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n) of a task's texts."""
    held: dict[int, list] = {WORD_ROW: [], BYTE_ROW: [], OTHER_ROW: []}

    def packed() -> Iterator[pa.RecordBatch]:
        for kind, parts in held.items():
            if parts:
                keys, n = ctw.merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], names=["kind", "key", "n"])
                parts.clear()

    for batch, texts in _chunks(batches):
        teaches = batch.column("train").to_pylist()
        lessons, others = ([t for t, x in zip(texts, teaches, strict=True) if x == kind] for kind in (True, False))
        if lessons:
            hashes, place, _ = _words(lessons)
            held[WORD_ROW].append((hashes, np.bincount(place, minlength=len(hashes))))
            held[BYTE_ROW].append(ctw.grams(lessons))
        if others:
            held[OTHER_ROW].append(ctw.grams(others))
        if sum(len(k) for parts in held.values() for k, _ in parts) > 1 << 22:
            yield from packed()
    yield from packed()


def _found(sought: np.ndarray, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which are among the sorted keys, and their values, else 0."""
    if not len(keys):
        return np.zeros(len(sought), bool), np.zeros(len(sought))
    at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    hit = keys[at] == sought
    return hit, np.where(hit, values[at], 0.0)


def _others(part: int, number: np.ndarray, names: np.ndarray, place: np.ndarray, bounds: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
    """What was not found: each once for a text, with its count."""
    rare = np.flatnonzero(~hit[place])
    text = np.searchsorted(bounds, rare, "right") - 1
    pairs, times = np.unique(text * len(names) + place[rare], return_counts=True)
    m, size = len(pairs), max(len(names), 1)
    blank = pa.nulls(m, pa.float64())
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(m, part, np.int32)), pa.array(number[pairs // size]), pa.nulls(m, pa.int64()), pa.array(times.astype(np.int64)),
        pa.nulls(m, pa.int64()), blank, blank, pa.nulls(m, pa.int64()), pa.array(names[pairs % size]),
    ], names=NAMES)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs, common, values = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch, texts in _chunks(batches):
            hashes, place, bounds = _words(texts)
            hit, worth = _found(hashes, common, values)
            names, at, ends = ctw.placed(texts)
            seen, log = _found(names, keys, logs)
            n = len(texts)
            number = np.arange(row, row + n)
            row += n
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int32)), pa.array(number), batch.column("doc_id"), pa.array(np.diff(bounds) + 1),
                pa.array(sums(hit[place].astype(np.float64), bounds).astype(np.int64)), pa.array(sums(worth[place], bounds)),
                pa.array(sums(log[at], ends)), pa.array([len(t) for t in texts], pa.int64()), pa.nulls(n, pa.int64()),
            ], names=NAMES)
            yield _others(1, number, hashes, place, bounds, hit)
            yield _others(2, number, names, at, ends, seen)

    return run


NAMES = ["part", "row", "doc_id", "n", "known", "sum", "score", "bytes", "key"]
SCHEMA = "part int, row long, doc_id long, n long, known long, sum double, score double, bytes long, key long"


def _least(counts: DataFrame, most: int) -> int:
    """The smallest n, of the halvings of an octave, that no more than ``most`` rows of (n) reach."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 2)
    held, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).collect(), key=lambda r: -r["low"]):
        held += r["rows"]
        if held > most:
            return r["high"] + 1
        least = r["low"]
    return least or 0


def score(docs: DataFrame, train: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte), a row for each row of (doc_id, text).

    Rows where ``train`` is true teach. Tokens are words (ASCII letters in lower
    case) and one end. A null text counts as empty: its only token is the end.
    Equal texts and repeated ids each teach and are each scored; null ids stay.
    With nothing to learn from, every byte costs eight bits and every token's
    base is log10 of 1.
    """
    spark = docs.sparkSession
    importable(spark)
    taught = F.coalesce(train, F.lit(False))
    counts = stored(
        docs.select("text", taught.alias("train")).mapInArrow(_counted, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    ends = docs.where(taught).count()
    words = counts.where(F.col("kind") == WORD_ROW).select(F.col("key").alias("word"), F.col("n").alias("c"))
    size = words.agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("distinct")).head()
    total, distinct = (size["tokens"] or 0) + ends, size["distinct"] + (ends > 0)
    frequent = words.where(F.col("c") * COMMON >= total)  # COMMON words at most
    common = frequent.orderBy("word").toArrow()
    values = np.log10(common.column("c").to_numpy().astype(np.float64) + 0.1)
    grams = stored(counts.where(F.col("kind") != WORD_ROW).groupBy("key").agg(
        F.sum(F.when(F.col("kind") == BYTE_ROW, F.col("n")).otherwise(0)).alias("n"), F.sum("n").alias("seen")), "grams")
    logs = stored(ctw.table(grams.select("key", "n")).join(grams.select("key", "seen"), "key"), "logs")
    least = _least(logs.select(F.col("seen").alias("n")), KEYS)
    sent = logs.where(F.col("seen") >= least).select("key", "log").orderBy("key").toArrow()  # KEYS rows at most
    shared = spark.sparkContext.broadcast((sent.column("key").to_numpy(), sent.column("log").to_numpy(), common.column("word").to_numpy(), values))
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(shared), SCHEMA), "scored")
    others = words.where(F.col("c") * COMMON < total)
    rare = rows.where("part = 1").select("row", "n", F.col("key").alias("word")).join(others, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(0.1))).alias("rare_sum"))
    rest = rows.where("part = 2").select("row", "n", "key").join(logs.where(F.col("seen") < least), "key").groupBy("row").agg(
        F.sum(F.col("n") * F.col("log")).alias("rest"))
    # the end is a token of its own
    end, each = math.log10(ends + 0.1), math.log10(total + 0.1 * (distinct + 1))
    out = rows.where("part = 0").join(rare, "row", "left").join(rest, "row", "left").withColumn("score", F.col("score") + F.coalesce("rest", F.lit(0.0)))
    return out.select(
        "doc_id", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(end) - F.col("n") * F.lit(each)).alias("base_score"), "score",
        (-F.col("score") / F.lit(math.log10(2)) / (F.col("bytes") + 1)).alias("bits_per_byte"))
