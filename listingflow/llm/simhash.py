"""SimHash near-duplicates: fingerprints in numpy, links by BK-trees of fingerprint shards.

Fingerprints within the radius agree wholly in some bands of bits (pigeonhole),
so a shard is all fingerprints with the same bits in a chosen set of bands, and
each fingerprint's searches go to the few shards that can hold a neighbour. A
shard's BK-tree hangs its fingerprints by their distance to the parent; a search
follows only the edges within the radius. Shards are built where their rows
meet. A shard too large for one tree is dealt into blocks, whose trees are sent
to one another's queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.components import components
from listingflow.llm.shared import importable, sized, stored
from listingflow.operators.skew import lookup_join

#: The seed of the shingle hash and the bits of a fingerprint.
SEED, BITS = 42, 64
#: Ids of copies that are broadcast; beyond that the join shuffles.
BROADCAST_ROWS = 2_000_000
#: Shingles whose bits are counted together.
BLOCK = 1 << 14


def fingerprint(text: str | None, words: int = 4) -> int:
    """SimHash of a text's word shingles, repeats included; no word: zero."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    digest = xxhash.xxh64_digest
    if len(tokens) <= words:
        return int.from_bytes(digest(line, SEED), "big")
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    ends = starts + sizes
    counts = np.zeros(BITS, np.int64)
    last = len(tokens) - words + 1
    for at in range(0, last, BLOCK):
        to = min(at + BLOCK, last)
        pairs = zip(starts[at:to].tolist(), ends[at + words - 1:to + words - 1].tolist(), strict=True)
        raw = np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in pairs]), np.uint8)
        counts += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > last).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, text: str = "text", out: str = "fp") -> DataFrame:
    """All rows with the fingerprint as a signed long; a column of that name is replaced."""
    importable(docs.sparkSession)

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
        return pa.array(values.view(np.int64), pa.int64())

    return docs.withColumn(out, prints(F.col(text)))


def band_masks(radius: int, agree: int) -> list[int]:
    """Masks of every ``agree`` bands out of radius + agree; within the radius, two fingerprints agree under one of them."""
    n = radius + agree
    edges = [round(i * BITS / n) for i in range(n + 1)]
    bands = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(bands, agree)]


def bands_to_agree(rows: int, radius: int) -> int:
    """Bands that must agree so that chance alone fills a shard with 16 fingerprints or fewer; two at least."""
    for agree in range(2, 8):
        if rows >> (BITS * agree // (radius + agree)) <= 16:
            return agree
    return 8


class Tree:
    """A BK-tree of distinct fingerprints that also joins what it finds.

    A node's children are keyed by their distance to it. ``whole`` marks
    subtrees known to be one group: a search for links leaves those out whose
    group it has already joined, so dense shards cost no more than sparse ones.
    """

    def __init__(self, radius: int):
        self.radius = radius
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []
        self.group: list[int] = []
        self.whole: list[bool] = []

    def find(self, i: int) -> int:
        group = self.group
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    def search(self, value: int) -> Iterator[int]:
        """Every node within the radius."""
        stack = [0] if self.value else []
        while stack:
            i = stack.pop()
            d = (self.value[i] ^ value).bit_count()
            if d <= self.radius:
                yield i
            for edge, child in self.children[i].items():
                if d - self.radius <= edge <= d + self.radius:
                    stack.append(child)

    def link(self, value: int, mine: int | None) -> int | None:
        """Join all groups within the radius of a value, and with ``mine`` if given; the group that results."""
        stack = [(0, False)] if self.value else []
        while stack:
            i, done = stack.pop()
            if done:  # its children have been looked at
                g = self.find(i)
                self.whole[i] = all(self.whole[c] and self.find(c) == g for c in self.children[i].values())
                continue
            if self.whole[i] and mine is not None and self.find(i) == self.find(mine):
                continue
            d = (self.value[i] ^ value).bit_count()
            if d <= self.radius:
                a = self.find(i)
                if mine is None:
                    mine = a
                elif a != (b := self.find(mine)):
                    self.group[max(a, b)] = min(a, b)
            if not self.whole[i] and self.children[i]:
                stack.append((i, True))
            for edge, child in self.children[i].items():
                if d - self.radius <= edge <= d + self.radius:
                    stack.append((child, False))
        return mine

    def add(self, value: int, group: int | None) -> None:
        new = len(self.value)
        self.value.append(value)
        self.children.append({})
        self.whole.append(True)
        self.group.append(new if group is None else self.find(group))
        if new == 0:
            return
        i = 0
        while True:
            if self.whole[i] and self.find(i) != self.find(new):
                self.whole[i] = False
            d = (self.value[i] ^ value).bit_count()
            if d not in self.children[i]:
                self.children[i][d] = new
                return
            i = self.children[i][d]


def shard_links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links that join what is within the radius of one another: each to the first of its group."""
    tree = Tree(radius)
    for value in values:
        tree.add(value, tree.link(value, None))
    for i, value in enumerate(values):
        if (g := tree.find(i)) != i:
            yield value, values[g]


def _link_shards(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        held: list[int] = []
        key = None

        def packed() -> pa.RecordBatch:
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            keys = list(zip(batch.column("mask").to_pylist(), batch.column("bits").to_pylist(), strict=True))
            values = batch.column("fp").to_numpy().view(np.uint64).tolist()
            for k, v in zip(keys, values, strict=True):
                if k != key:
                    found.extend(shard_links(held, radius))
                    held, key = [], k
                held.append(v)
            if len(found) > 1 << 16:
                yield packed()
                found.clear()
        found.extend(shard_links(held, radius))
        yield packed()

    return run


def _link_blocks(radius: int):
    """Rows (tree, query): a block's tree against another block's fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for own, other in zip(batch.column("own"), batch.column("other"), strict=True):
                first = np.array(own.as_py(), np.int64).view(np.uint64).tolist()
                second = np.array(other.as_py(), np.int64).view(np.uint64).tolist()
                found.extend(shard_links(list(dict.fromkeys(first + second)), radius))
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def near_links(prints: DataFrame, radius: int = 4, shard_rows: int = 20_000) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` so that whatever is within the radius is joined.

    Not every pair is listed: in a shard each fingerprint is linked to the first
    of its group, which joins the same fingerprints. A shard of more than
    ``shard_rows`` is dealt into blocks of half that size, and each two blocks
    are searched in a task of their own, so its work is split and its memory
    bounded, whatever its size.
    """
    spark = prints.sparkSession
    importable(spark)
    agree = bands_to_agree(prints.count(), radius)
    masks = [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in band_masks(radius, agree)]
    # no array of the masks in each row: one pass writes a row per mask
    dealt = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("mask", "bits"))
    sizes = dealt.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stored(sizes.where(F.col("n") > shard_rows), "large-shards")
    large = not sizes.isEmpty()
    small = dealt.join(sizes, ["mask", "bits"], "left_anti") if large else dealt
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = small.repartition(width, "mask", "bits").sortWithinPartitions("mask", "bits", "fp")
    links = rows.mapInArrow(_link_shards(radius), "a long, b long")
    if large:
        half = shard_rows // 2
        blocks = F.ceil(F.col("n") / half)
        cut = dealt.join(sizes, ["mask", "bits"]).withColumn("block", F.pmod(F.xxhash64("fp"), blocks).cast("int"))
        lists = stored(cut.groupBy("mask", "bits", "block", blocks.cast("int").alias("blocks")).agg(F.collect_list("fp").alias("fps")), "blocks")
        own = lists.select("mask", "bits", "block", F.col("fps").alias("own"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("with"))
        other = lists.select("mask", "bits", F.col("block").alias("with"), F.col("fps").alias("other"))
        meets = own.join(other, ["mask", "bits", "with"]).select("own", "other")
        links = links.union(meets.repartition(max(width, 64)).mapInArrow(_link_blocks(radius), "a long, b long"))
    return links


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of every row of (doc_id, text).

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is
    the smallest doc_id that links reach. Texts without words, null and empty
    ones included, have fingerprint zero and link like any other. Equal texts
    share a fingerprint and are searched once. Rows with a null id get a
    fingerprint and the component of their fingerprint; if no row there has an
    id, it is null. Repeated rows stay.
    """
    prints = stored(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"), "fingerprints")
    heads = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("head")), "distinct-fingerprints")
    groups = components(near_links(heads.select("fp"), radius))
    named = heads.join(groups.select(F.col("node").alias("fp"), "component"), "fp", "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("head").alias("component_id"))
    # a component can hold a third of all fingerprints, a fingerprint a third of all rows
    found = lookup_join(named, least, ["component"], "inner").select("fp", "component", "component_id")
    return prints.join(found, "fp").select("doc_id", "fp", "component_id", "component")


def hexadecimal(fp: Column) -> Column:
    """Sixteen lower-case hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, all columns kept: the one with the smallest id, then the smallest row hash.

    Null ids come last. Of rows equal in all columns one stays. Texts without
    words are one group. Extra columns may have any name; a text of any length is
    read whole, in blocks of shingles.
    """
    names = docs.columns
    plain = [f"`{f.name}`" for f in docs.schema.fields if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    # a row is known by its values: the same in both reads, whatever tasks are repeated
    keyed = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), F.xxhash64(*plain).alias("h"), F.xxhash64(F.lit(17), *plain).alias("g"))
    prints = stored(fingerprints(keyed.select("h", "g", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")), words)
                    .select("h", "g", "doc_id", "fp"), "fingerprints")
    heads = stored(prints.groupBy("fp").agg(F.min(_place("doc_id")).alias("head")), "distinct-fingerprints")
    groups = components(near_links(heads.select("fp"), radius))
    named = heads.join(groups.select(F.col("node").alias("fp"), "component"), "fp", "left")
    first = named.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("head").alias("head"))
    chosen = sized(first.select("head.h", "head.g").distinct(), "kept-rows", BROADCAST_ROWS)
    kept = keyed.join(chosen, ["h", "g"], "left_semi")
    # rows equal in all columns are rare; only they are moved
    twice = stored(prints.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(chosen, ["h", "g"], "left_semi").select("h", "g"), "repeated-rows")
    if not twice.isEmpty():
        again = sized(twice, "repeated-rows", BROADCAST_ROWS)
        kept = kept.join(again, ["h", "g"], "left_anti").unionByName(kept.join(again, ["h", "g"], "left_semi").dropDuplicates(["h", "g"]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in names])


def _place(key: str) -> Column:
    """Orders rows by id, null ids last, then by hash."""
    return F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "h", "g")
