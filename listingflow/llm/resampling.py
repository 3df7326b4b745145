"""Target-distribution importance resampling with a head-tail vocabulary of hashed word runs.

A text's features are its words and pairs of neighbouring words, each in the
bucket of its CRC-32. Buckets are counted over the corpus and over the target;
a bucket's gain says how much likelier the target makes it. A document's weight
is the mean gain of its features, and documents are drawn by weight plus Gumbel
noise of their id.

Word frequencies fall steeply, so most CRCs are of few features. The head, the
corpus' most frequent words and pairs, is counted once and broadcast: words
with their CRC state, from which the CRC of a pair goes on, and pairs with
their bucket. Features outside the head take their CRC directly. Both give the
same buckets, so the head decides speed only; bucket totals are exact.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.pieces import runs, text_slices
from listingflow.llm.shared import importable, stored
from listingflow.operators.ids import rank_within

BUCKETS = 10_000
#: Most entries of the head, and most bytes of one of them: 9 MB at most are broadcast.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 1 << 14, 1 << 16, 96
#: A slice of texts proposes what makes up at least one in this many of its features.
COMMON = 1 << 14

# The bytes of a word (digits, letters, all of a multi-byte character), and A-Z in lower case.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[0x41:0x5B] += 32


@dataclass(frozen=True)
class Head:
    """Frequent words with their CRC state and bucket, frequent pairs with their bucket."""

    words: dict[bytes, int]
    pairs: dict[bytes, int]


def _cut(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words as numbers, the distinct words, and the number of words before each text."""
    inside = _IN_WORD[data]
    found, at = runs(_LOW[data], inside, np.zeros(len(data), bool), bounds)
    coded = found.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist(), at


def _pairs(codes: np.ndarray, distinct: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring words of one text: numbers of distinct pairs, these pairs, and the pairs before each text."""
    # a word starts a pair unless it is the last one of its text
    last = np.zeros(len(codes) + 1, bool)
    last[at[1:][at[1:] > 0] - 1] = True
    first = np.flatnonzero(~last[:len(codes)])
    first = first[first + 1 < len(codes)]
    coded = pa.array(codes[first] * max(distinct, 1) + codes[first + 1]).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_numpy(), np.searchsorted(first, at)


def _buckets(data: np.ndarray, bounds: np.ndarray, head: Head, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bucket of every feature, words and then pairs, each with their bounds by text."""
    codes, words, at = _cut(data, bounds)
    crc = zlib.crc32
    known = [head.words.get(w, -1) for w in words]
    states = [crc(w) if s < 0 else s for w, s in zip(words, known, strict=True)]
    yield (np.array(states, np.int64) % buckets)[codes] if len(codes) else codes, at
    numbers, pairs, pair_at = _pairs(codes, len(words), at)
    out = []
    for a, b in zip((pairs // max(len(words), 1)).tolist(), (pairs % max(len(words), 1)).tolist(), strict=True):
        rest = b" " + words[b]
        if known[a] < 0:
            out.append(crc(words[a] + rest) % buckets)
        else:
            found = head.pairs.get(words[a] + rest, -1) if known[b] >= 0 else -1
            out.append(crc(rest, known[a]) % buckets if found < 0 else found)
    yield np.array(out, np.int64)[numbers] if len(numbers) else numbers, pair_at


def _proposals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent words and pairs of slices of texts with their counts there."""
    for batch in batches:
        rows: dict[str, list] = {"feature": [], "pair": [], "n": []}
        for _, data, bounds in text_slices(batch.column("text")):
            codes, words, at = _cut(data, bounds)
            numbers, pairs, _ = _pairs(codes, len(words), at)
            least = max(2, len(codes) // COMMON)
            for pair, times in ((False, np.bincount(codes, minlength=1)), (True, np.bincount(numbers, minlength=1))):
                for i in np.flatnonzero(times >= least).tolist():
                    feature = words[pairs[i] // len(words)] + b" " + words[pairs[i] % len(words)] if pair else words[i]
                    if len(feature) <= HEAD_BYTES:
                        rows["feature"].append(feature)
                        rows["pair"].append(pair)
                        rows["n"].append(int(times[i]))
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("feature", pa.binary()), ("pair", pa.bool_()), ("n", pa.int64())]))


def head_of(texts: DataFrame, buckets: int = BUCKETS) -> Head:
    """The most frequent words and pairs of (text), at most HEAD_WORDS and HEAD_PAIRS of them."""
    importable(texts.sparkSession)
    counted = texts.select("text").mapInArrow(_proposals, "feature binary, pair boolean, n long").groupBy("feature", "pair").agg(F.sum("n").alias("n"))
    counted = stored(counted, "head")
    top = lambda pair, most: [r.feature for r in counted.where(F.col("pair") == pair).orderBy(F.desc("n"), "feature").limit(most).collect()]
    words = {bytes(w): zlib.crc32(w) for w in top(False, HEAD_WORDS)}
    pairs = {bytes(p): zlib.crc32(p) % buckets for p in top(True, HEAD_PAIRS)}
    return Head(words, {p: b for p, b in pairs.items() if all(w in words for w in p.split(b" "))})


def features(docs: DataFrame, head: Head, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """All rows with ``n_words``, ``n_features`` and ``counts``: (bucket, times) of the text's features, packed."""
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(head)

    @F.arrow_udf("n_words long, n_features long, counts binary")
    def counted(texts: pa.Array) -> pa.Array:
        words, total, packed = [], [], []
        for _, data, bounds in text_slices(texts):
            parts = list(_buckets(data, bounds, shared.value, buckets))
            for i in range(len(bounds) - 1):
                own = np.concatenate([b[at[i]:at[i + 1]] for b, at in parts])
                words.append(int(parts[0][1][i + 1] - parts[0][1][i]))
                total.append(len(own))
                found, times = np.unique(own, return_counts=True)
                packed.append(np.stack([found, times]).astype("<u4").tobytes() if len(own) else b"")
        return pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(total, pa.int64()), pa.array(packed, pa.binary())],
                                          names=["n_words", "n_features", "counts"])

    names = [c for c in docs.columns if c not in ("n_words", "n_features", "counts")]
    return docs.withColumn("_f", counted(F.col(text))).select(*[f"`{c}`" for c in names], "_f.*")


def unpacked(counts: bytes) -> np.ndarray:
    """Two rows: buckets and times."""
    return np.frombuffer(counts, "<u4").reshape(2, -1).astype(np.int64)


def bucket_totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket, summed in the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for c in batch.column("counts").to_pylist():
                found, times = unpacked(c)
                total[found] += times
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["bucket", "n"])

    sums = counted.select("counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # one row per bucket at most
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of smoothed bucket shares, rounded down."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * float(s_all + size) / ((float(s) + 1) * float(t_all + size))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable made from the id, rounded down; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("long")


def weighed(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    """All rows with ``weight``, the mean gain of their features rounded down (none: 0), in place of ``counts``."""
    spark = counted.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(gain)

    @F.arrow_udf("long")
    def weight(counts: pa.Array) -> pa.Array:
        out = []
        for c in counts.to_pylist():
            found, times = unpacked(c)
            n = int(times.sum())
            out.append(int((shared.value[found] * times).sum()) // n if n else 0)
        return pa.array(out, pa.int64())

    return counted.withColumn("weight", weight("counts")).drop("counts")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of (doc_id, text), drawn towards the texts of ``target``.

    Of the rows with ``least_words`` words the ``percent`` of a hundred with the
    highest score get a rank from 1, ties to the smaller doc_id, null ids last.
    Null and empty texts have no features, weight 0 and no rank. Repeated rows
    are rows of their own, ranked one after the other. Other columns are left
    out, so their names can't clash. A text of any length is read whole; one
    longer than a slice is worked on alone, at about 60 bytes of memory for each
    of its bytes. Empty tables give no rows; an empty target has no features.
    """
    rows = docs.select("doc_id", "text")
    head = head_of(rows, buckets)
    counted = stored(features(rows, head, buckets).drop("text"), "features")
    aimed = stored(features(target.select("text"), head, buckets).select("counts"), "target-features")
    gain = gains(bucket_totals(counted, buckets), bucket_totals(aimed, buckets))
    scored = weighed(counted, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stored(scored.select("doc_id", "n_words", "n_features", "weight", "score"), "scores")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    # equal rows are told apart by their place in the stored table, so that no key fills one range
    ordered = scored.where(able).withColumns({
        "_all": F.lit(0), "_down": -F.col("score"), "_null": F.col("doc_id").isNull(), "_place": F.monotonically_increasing_id()})
    ranked = rank_within(ordered, ["_all"], ["_down", "_null", "doc_id", "_place"])
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        scored.where(~able).select(*out, F.lit(None).cast("long").alias("rank")))
