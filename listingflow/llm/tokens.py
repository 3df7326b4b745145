"""Token ids of documents in files of range-coded blocks, written and read by Spark.

Texts are encoded with a public tokenizer in the tasks. One table of shares,
counted over all ids, serves every block. Documents are sorted by id over all
tasks; each task lays its documents end to end and cuts blocks at document
ends, so a block can be read alone. A file set is a folder with ``blocks``
(Parquet: one row for each block, with its place, its documents and its coded
bytes) and ``table`` (ids and shares). Spark writes both, so a lost executor's
files are written again and readers need nothing but the shared folder.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from listingflow.llm import rans
from listingflow.llm.pieces import runs, spread, text_slices
from listingflow.llm.shared import importable, stored

#: A block is closed once it has this many ids; blocks of about PENDING ids are coded together.
BLOCK, PENDING = 1 << 15, 1 << 20
#: Bytes of ids that one task lays into a file, and the most files: beyond it they grow, written as a stream.
FILE_BYTES, FILES = 64 << 20, 20_000
#: Pieces of text whose ids a worker remembers, and the longest that it does.
MEMO, MEMO_CHARS = 3 << 17, 32
#: Pieces that the tokenizer gets at once, and bytes of text that are cut together.
CALL, SLICE = 1 << 11, 2 << 20

_BLANK, _LETTER, _OTHER, _GLUED = 0, 1, 2, 3
_LATIN = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_KIND = np.full(256, _GLUED, np.uint8)
_KIND[:128] = _OTHER
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[[0x20, 0x09, 0x0A, 0x0D]] = _BLANK
# An apostrophe binds letters in contractions, a bar those of special tokens.
_KIND[[0x27, 0x7C]] = _GLUED


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer's file, the end id, and whether the tokenizer works by piece.

    One that does drops white space, lower-cases, takes runs of letters as words
    and lets no id cross the edge between a letter and another ASCII sign. It is
    asked once for each distinct piece of a text; any other one for each text.
    """

    file: str
    end: int
    by_piece: bool = True


def public(name: str, end: int, by_piece: bool = True) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name), end, by_piece)


@lru_cache(maxsize=2)
def _loaded(file: str) -> tuple:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    # how the tokenizer spells the letters of Latin-1 beyond ASCII
    letters = {c: "".join(x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))) for c in range(128, 256) if chr(c).isalpha()}
    return tokenizer, {}, letters


def _by_piece(data: np.ndarray, bounds: np.ndarray, file: str) -> tuple[np.ndarray, np.ndarray]:
    tokenizer, memo, letters = _loaded(file)
    kind = np.take(_KIND, data)
    cuts = np.zeros(len(data), bool)
    # a letter beside another sign: the only two kinds of which one and two are the numbers
    np.equal(kind[1:] * kind[:-1], _LETTER * _OTHER, out=cuts[1:])
    cuts[1:] &= kind[1:] != kind[:-1]
    found, at = runs(data, kind != _BLANK, cuts, bounds)
    coded = found.dictionary_encode()
    pieces = coded.dictionary.cast(pa.large_string()).to_pylist()
    known = [memo.get(p) for p in pieces]
    new = [i for i, k in enumerate(known) if k is None]
    model, other = tokenizer.model, []
    for i in new:
        p = pieces[i]
        if p.isalpha() and (p.isascii() or _LATIN.fullmatch(p)):
            # a word as it is: what comes before the model would leave it so
            word = p.lower()
            known[i] = array("I", [t.id for t in model.tokenize(word if word.isascii() else word.translate(letters))]).tobytes()
        else:
            other.append(i)
    for at_once in range(0, len(other), CALL):  # what the library returns for a piece is large
        some = other[at_once:at_once + CALL]
        for i, e in zip(some, tokenizer.encode_batch_fast([pieces[i] for i in some], add_special_tokens=False), strict=True):
            known[i] = array("I", e.ids).tobytes()
    for i in new:
        if len(pieces[i]) <= MEMO_CHARS:
            if len(memo) >= MEMO:
                memo.clear()
            memo[pieces[i]] = known[i]
    sizes = np.array([len(k) for k in known], np.int64) // 4
    flat = np.frombuffer(b"".join(known), np.uint32)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    own = sizes[codes]
    ids = flat[spread((np.cumsum(sizes) - sizes)[codes], own)] if len(codes) else flat
    return ids, np.concatenate(([0], np.cumsum(own)))[at]


def _whole(data: np.ndarray, bounds: np.ndarray, file: str) -> tuple[np.ndarray, np.ndarray]:
    texts = [data[a:b].tobytes().decode("utf-8") for a, b in zip(bounds, bounds[1:], strict=False)]
    found = [e.ids for e in _loaded(file)[0].encode_batch_fast(texts, add_special_tokens=False)]
    return np.array([i for ids in found for i in ids], np.uint32), np.cumsum([0, *map(len, found)])


def width_of(vocabulary: Vocabulary) -> str:
    """Two bytes for each id on the way where all ids fit, else four."""
    return "<u2" if max(_loaded(vocabulary.file)[0].get_vocab_size(), vocabulary.end + 1) <= 1 << 16 else "<u4"


def tokenised(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, ids) of every row: ids as little-endian integers of ``width_of``, the end id included. Null counts as empty."""
    importable(docs.sparkSession)
    kind = width_of(vocabulary)

    @F.arrow_udf("n int, ids binary")
    def encoded(texts: pa.Array) -> pa.Array:
        sizes, packed = [], []
        for _, data, bounds in text_slices(texts, SLICE):
            ids, at = (_by_piece if vocabulary.by_piece else _whole)(data, bounds, vocabulary.file)
            full = np.insert(ids.astype(kind), at[1:], vocabulary.end)
            ends = at + np.arange(len(at))
            packed.extend(full[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False))
            sizes.append(np.diff(ends))
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(packed, pa.binary())], names=["n", "ids"])

    return docs.select(F.col(f"`{key}`").alias("key"), encoded(F.col(f"`{text}`")).alias("_t")).select("key", "_t.n", "_t.ids")


def frequencies(tokens: DataFrame, kind: str) -> rans.Table:
    """The table of all ids; one row per id of the vocabulary comes to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind)
            counts = np.bincount(ids, minlength=len(total))
            counts[:len(total)] += total
            total = counts
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["id", "n"])

    found = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    return rans.table_of(found.column("id").to_numpy(), found.column("n").to_numpy())


def _coded(table: rans.Table, key: pa.DataType, kind: str):
    """Sorted rows (part, key, n, ids) of a task to rows of blocks."""
    doc = pa.struct([("key", key), ("n", pa.int32())])
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("docs", pa.list_(doc)), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, part = 0, 0, 0
        keys: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        held: list[bytes] = []
        waiting = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal number, before, waiting
            if not held:
                return
            n = np.concatenate(sizes)
            docs = pa.StructArray.from_arrays([pa.concat_arrays(keys), pa.array(n, pa.int32())], fields=list(doc))
            ids, ends = np.frombuffer(b"".join(held), kind), np.cumsum(n)
            cuts, at = [0], 0  # places of documents at which blocks end
            while at < len(n):
                at = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK)) + 1
                cuts.append(min(at, len(n)))
                at = cuts[-1]
            bounds = [0, *[int(ends[c - 1]) for c in cuts[1:]]]
            coded = rans.encode([ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)], table)
            for k, raw in enumerate(coded):
                own = docs.slice(cuts[k], cuts[k + 1] - cuts[k])
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
                    pa.array([bounds[k + 1] - bounds[k]], pa.int64()), pa.ListArray.from_arrays([0, len(own)], own).cast(pa.list_(doc)),
                    pa.array([raw], pa.binary())], schema=schema)
                number, before = number + 1, before + bounds[k + 1] - bounds[k]
            keys.clear(), sizes.clear(), held.clear()
            waiting = 0

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            n = batch.column("n").to_numpy(zero_copy_only=False)
            ends, first = np.cumsum(n.astype(np.int64)), 0
            while first < len(n):  # a batch can hold more than is coded together
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PENDING, "right")))
                keys.append(batch.column("key").slice(first, last - first))
                sizes.append(n[first:last])
                held.append(b"".join(batch.column("ids").slice(first, last - first).to_pylist()))
                waiting += int(sizes[-1].sum())
                first = last
                if waiting >= PENDING:
                    yield from packed()
        yield from packed()

    return run


def write(docs: DataFrame, path: str, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> None:
    """Encode every row's text and write a file set at ``path``, rows in rising order of the key, null keys last.

    Rows of one key follow in the order of their ids' hash; repeated rows stay,
    each with its own ids. A text of any length is one document in one block, so
    a task needs memory for its longest text (about 100 bytes for each byte of
    it). No rows give a file set without blocks.
    """
    spark = docs.sparkSession
    tokens = stored(tokenised(docs, vocabulary, key, text), "token-ids")
    kind = width_of(vocabulary)
    table = frequencies(tokens, kind)
    spark.createDataFrame(list(zip(table.ids.tolist(), table.share.tolist(), strict=True)), "id long, share long").coalesce(1).write.parquet(f"{path}/table")
    total = tokens.agg(F.sum(F.col("n").cast("long"))).head()[0] or 0
    width = min(max(spark.sparkContext.defaultParallelism, -(-4 * total // FILE_BYTES)), FILES)
    # equal rows are told apart by their place in the stored step: no key fills one range
    order = [F.col("key").isNull(), F.col("key"), F.xxhash64("ids"), F.col("_place")]
    placed = tokens.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(width, *order).sortWithinPartitions(*order)
    placed = placed.select(F.spark_partition_id().alias("part"), "key", "n", "ids")
    key_type = tokens.schema["key"].dataType
    coded = placed.mapInArrow(_coded(table, to_arrow_type(key_type), kind), f"part int, block int, before long, n_ids long, docs array<struct<key:{key_type.simpleString()},n:int>>, data binary")
    coded.write.parquet(f"{path}/blocks")


def table_at(spark: SparkSession, path: str) -> rans.Table:
    rows = spark.read.parquet(f"{path}/table").orderBy("id").toArrow()
    share = rows.column("share").to_numpy()
    return rans.Table(rows.column("id").to_numpy(), share, max(int(share.sum()).bit_length() - 1, 0) if len(share) else rans.table_of(np.zeros(0), np.zeros(0)).bits)


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document of a file set, decoded from it; with ``ids`` also the ids (array).

    ``start`` is the number of ids before the document. Blocks are decoded and
    checked wherever they lie; what fails a checksum raises an error.
    """
    importable(spark)
    table = spark.sparkContext.broadcast(table_at(spark, path))
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row for each file that was written, FILES at most
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, before = [], 0
    for r in sizes:
        starts.append((r.part, before))
        before += r.n
    key = blocks.schema["docs"].dataType.elementType["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_ids = np.cumsum(batch.column("n_ids").to_numpy())
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(n_ids, (n_ids[first - 1] if first else 0) + PENDING, "right")))
                some = batch.slice(first, last - first)
                first = last
                docs = some.column("docs")
                own = docs.flatten()
                n = own.field("n").to_numpy().astype(np.int64)
                per = np.diff(docs.offsets.to_numpy())
                found = rans.decode(some.column("data").to_pylist(), table.value)
                flat = np.concatenate(found).astype("<u4") if found else np.zeros(0, "<u4")
                ends = np.cumsum(n)
                at = ends - n  # within these blocks
                base = np.cumsum([0, *map(len, found)])[:-1]
                start = some.column("before").to_numpy()
                columns = {
                    "key": own.field("key"), "part": pa.array(np.repeat(some.column("part").to_numpy(), per), pa.int32()),
                    "at": pa.array(np.repeat(start - base, per) + at, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at, ends, strict=True)], pa.int64()),
                }
                if ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    out = f"key {key}, part int, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    docs = blocks.mapInArrow(run, out)
    offsets = spark.createDataFrame(starts, "part int, start long")
    whole = docs.join(F.broadcast(offsets), "part").withColumn("start", F.col("start") + F.col("at"))
    return whole.select("key", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else []))
