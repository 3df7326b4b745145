"""Vector code compression: product codes whose codebooks are learned with anchors-hierarchy metric trees.

A vector of whole numbers is cut into parts, and each part is named by the
nearest entry of its codebook. Rows are taken in chunks; a chunk's parts become
balls (see balls.py) once and are written to the shared folder. A round sends
the codebooks to all chunks, which answer with the sums and numbers of what each
entry owns, most of it from whole balls. All arithmetic that decides a result is
in whole numbers, so no result depends on chunks, tasks or their order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from listingflow.llm import balls
from listingflow.llm.shared import importable, stored
from listingflow.operators.skew import lookup_join

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components of a chunk's vectors: bounds the memory of a task and a row of the stored trees.
CHUNK_COMPONENTS = 1 << 18


def sound(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    v = F.col(f"`{vector}`")
    return v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def width_of(vectors: DataFrame, vector: str = "embedding") -> int:
    """The commonest length of the vectors, the smaller of equally common ones; 0 without vectors."""
    sizes = vectors.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), "size").head()
    return first["size"] if first else 0


def _limit(width: int) -> int:
    """Largest component: with it, and with its negative, no squared distance of whole vectors passes 2^62."""
    return min(math.isqrt((1 << 62) // max(width, 1)) // 2, (1 << 31) - 1)


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(SCALE * x), held within the largest component."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    limit = _limit(width)
    return np.clip(np.floor(flat * SCALE), -limit, limit).astype(np.int64).reshape(len(column), width)


def _edges(width: int, parts: int) -> list[int]:
    return [i * width // parts for i in range(parts + 1)]


def _cut(rows: np.ndarray, parts: int) -> np.ndarray:
    """(parts x rows x components); a part shorter than others is filled with zeros, which no distance feels."""
    edges = _edges(rows.shape[1], parts)
    out = np.zeros((parts, len(rows), max(b - a for a, b in zip(edges, edges[1:], strict=False))), np.int64)
    for p in range(parts):
        out[p, :, :edges[p + 1] - edges[p]] = rows[:, edges[p]:edges[p + 1]]
    return out


def first_entries(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(parts x entries x components) of the vectors with the smallest ids, ties by the vector itself; null ids come last."""
    order = [F.col("vec_id").isNull(), F.col("vec_id"), F.col("embedding")]
    top = vectors.where(F.size("embedding") == width).orderBy(*order).limit(entries).select("embedding").toArrow()
    column = top.column("embedding").combine_chunks() if top.num_rows else pa.array([], pa.list_(pa.float32()))
    return _cut(_whole(column, width), parts)


def forests(vectors: DataFrame, width: int, parts: int = PARTS) -> DataFrame:
    """Chunks of the vectors of that length: ids, labels and the packed trees of all parts."""
    rows = max(16, CHUNK_COMPONENTS // max(width, 1))
    types = [to_arrow_type(vectors.schema[c].dataType) for c in ("vec_id", "label")]
    schema = pa.schema([("vec_id", pa.list_(types[0])), ("label", pa.list_(types[1])), *[(k, pa.binary()) for k in balls.TYPES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                forest = balls.build(_cut(_whole(part.column("embedding"), width), parts)).packed()
                own = [pa.array([part.column(c).to_pylist()], pa.list_(t)) for c, t in zip(("vec_id", "label"), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array([forest[k]], pa.binary()) for k in balls.TYPES]], schema=schema)

    kinds = [vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    out = f"vec_id array<{kinds[0]}>, label array<{kinds[1]}>, " + ", ".join(f"{k} binary" for k in balls.TYPES)
    return vectors.where(F.size("embedding") == width).select("vec_id", "label", "embedding").mapInArrow(run, out)


def _forests_of(batch: pa.RecordBatch, parts: int, width: int) -> Iterator[balls.Forest]:
    columns = [batch.column(k).to_pylist() for k in balls.TYPES]
    for raw in zip(*columns, strict=True):
        yield balls.unpacked(dict(zip(balls.TYPES, raw, strict=True)), parts, width)


def next_codebooks(trees: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry moved to the mean, rounded down, of the parts it owns; one that owns none stays."""
    parts, k, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros(codebooks.shape, np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for forest in _forests_of(batch, parts, width):
                s, n = balls.totals(forest, codebooks)
                sums += s
                count += n
        full = np.flatnonzero(count)
        at = np.repeat(full, width) * width + np.tile(np.arange(width), len(full))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.reshape(-1)[at]), pa.array(count.reshape(-1)[at // max(width, 1)])],
                                         names=["at", "total", "n"])

    found = trees.select(*balls.TYPES).mapInArrow(run, "at long, total long, n long").groupBy("at").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()  # one row per component of the codebooks at most
    out = codebooks.reshape(-1).copy()
    at = found.column("at").to_numpy()
    out[at] = found.column("total").to_numpy() // found.column("n").to_numpy()
    return out.reshape(codebooks.shape)


def coded(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): entries in the order of parts, two hex digits each, and the squared distance to them."""
    parts, _, width = codebooks.shape
    kinds = [trees.schema[c].dataType.elementType for c in ("vec_id", "label")]
    types = [to_arrow_type(k) for k in kinds]
    digits = np.array([f"{i:02x}".encode() for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for forest, ids, labels in zip(_forests_of(batch, parts, width), *(batch.column(c).to_pylist() for c in ("vec_id", "label")), strict=True):
                own = balls.owners(forest, codebooks)
                error = np.zeros(len(own), np.int64)
                for p in range(parts):
                    error += ((forest.points[p] - codebooks[p, own[:, p]]) ** 2).sum(axis=1)
                code = np.ascontiguousarray(digits[own]).view(f"S{2 * parts}").reshape(-1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, types[0]), pa.array(labels, types[1]), pa.array([c.decode() for c in code.tolist()], pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, f"vec_id {kinds[0].simpleString()}, label {kinds[1].simpleString()}, code string, error long")


def digest(codebooks: np.ndarray, width: int) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined decimals."""
    edges = _edges(width, len(codebooks))
    numbers = [str(x) for p, book in enumerate(codebooks) for entry in book[:, :edges[p + 1] - edges[p]].tolist() for x in entry]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def learned(trees: DataFrame, codebooks: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        codebooks = next_codebooks(trees, codebooks)
    return codebooks


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every sound row of (vec_id, embedding, label).

    Rows whose vector is null or holds a null or non-finite component are left
    out. A component becomes floor(256 x), held within about 2^30 divided by the
    root of the length, so that no distance overflows. The length is the
    commonest one; a sound row of another length stays with a null code and
    error. A length that ``parts`` does not divide gives parts that differ by
    one component. Repeated ids and rows stay, each with its own code; null ids
    come after all others when the first entries are chosen. Fewer rows than
    ``entries`` give as many entries. ``label_error`` sums the errors of equal
    labels (nulls together), at most the largest long. Entries are at most 256.
    Other columns are left out, so their names can't clash. No rows give no rows.
    """
    spark = vectors.sparkSession
    importable(spark)
    kept = vectors.where(sound("embedding")).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    width = width_of(kept)
    trees = stored(forests(kept, width, parts), "ball-trees")
    books = learned(trees, first_entries(kept, width, parts, entries), rounds)
    done = stored(coded(trees, books), "codes")
    other = kept.where(F.size("embedding") != width).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    rows = done.unionByName(other)
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("-"))
    rows = rows.select("vec_id", "code", "error", label.alias("_label"))
    most = (1 << 63) - 1
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(most).cast("decimal(38,0)")).cast("long")
    sums = rows.groupBy("_label").agg(total.alias("label_error"))
    return lookup_join(rows, sums, ["_label"]).select("vec_id", "code", "error", "label_error", F.lit(digest(books, width)).alias("codebooks_sha256"))
