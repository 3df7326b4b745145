import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listingflow.llm import decontam, simhash
from listingflow.llm.components import components


def _slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(values, near):
    group = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    return group


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB É\n\t c", max_size=80))
def test_fingerprint_is_the_defined_one(text):
    assert simhash.fingerprint(text) == _slow_print(text)


def _dense(n, seed=3):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = {0}
    while len(out) < n:
        v = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randrange(7)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


def test_tree_finds_what_is_within_the_radius():
    values = _dense(300)
    tree = simhash.Tree(4)
    for v in values:
        tree.add(v, None)
    for v in values[:50] + [v ^ 6 for v in values[:20]]:
        assert sorted(values[i] for i in tree.search(v)) == [x for x in values if (x ^ v).bit_count() <= 4]


def test_shard_links_join_the_groups():
    values = _dense(400)
    want = _groups(values, lambda a, b: (a ^ b).bit_count() <= 4)
    at = {v: i for i, v in enumerate(values)}
    got = list(range(len(values)))
    for a, b in simhash.shard_links(values, 4):
        x, y = got[at[a]], got[at[b]]
        got = [min(x, y) if g in (x, y) else g for g in got]
    assert got == want


@pytest.mark.parametrize("agree", [2, 3, 4])
def test_some_band_set_agrees_within_the_radius(agree):
    rng = random.Random(5)
    masks = simhash.band_masks(4, agree)
    for _ in range(300):
        v = rng.getrandbits(64)
        w = v
        for b in rng.sample(range(64), 4):
            w ^= 1 << b
        assert any(v & m == w & m for m in masks)


@pytest.mark.parametrize("shard_rows", [20_000, 8])
def test_links_of_shards_and_blocks(spark, shard_rows):
    values = _dense(250)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, shard_rows)
    found = {r.node: r.component for r in components(links).collect()}
    want = _groups(values, lambda a, b: (a ^ b).bit_count() <= 4)
    for i, g in enumerate(want):
        for j in range(i):
            assert (want[j] == g) == (found.get(signed[i], i) == found.get(signed[j], -j - 1) if signed[i] in found and signed[j] in found else False)


def test_documents_with_nulls_copies_and_no_words(spark):
    rows = [(5, "a b c d e"), (3, "A b  c d e"), (9, None), (7, ""), (8, " \n"), (None, "a b c d e"), (2, "other words stand here now"), (2, "other words stand here now")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == {5: 3, 3: 3, 9: 7, 7: 7, 8: 7, None: 3, 2: 2}
    assert {r.fp for r in got if r.doc_id in (7, 8, 9)} == {0}
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(docs).collect()) == ["2", "3", "7"]
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(docs.where("doc_id IS NULL OR doc_id = 2")).collect()) == ["2", "None"]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_chains_and_loops(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 150), (150, 175), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 150, 175: 150, 200: 150}


def _slow_containment(doc, item):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    n = min(5, len(words(item)))
    shingles = lambda t: {" ".join(words(t)[i:i + n]) for i in range(len(words(t)) - n + 1)} if n else set()
    a, b = shingles(doc), shingles(item)
    return len(a & b) / len(b) if b else 0


def test_contained_items_are_found(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 6, 12, 40, 120])))) for i in range(30)] + [(90, None), (91, "!!"), (None, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for i in range(120):
        body = rng.choices(words, k=rng.choice([5, 60, 800]))
        if i % 2:
            passage = rng.choice(items[:30])[1].split()
            cut = rng.random() * 0.4
            body[10:10] = [w.upper() + "," for w in passage[int(len(passage) * cut * rng.random()):]]
        docs.append((i, " ".join(body)))
    docs += [(500, items[0][1]), (501, None), (502, ""), (None, items[5][1]), (503, items[5][1]), (503, items[5][1])]
    frame = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, text_key string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id) for r in decontam.find(frame, bench).collect())
    want = sorted((str(d), i) for d, t in docs for i, x in items if i is not None and _slow_containment(t, x) >= 0.8 - 1e-9)
    assert got == want and len(want) > 30
    kept = decontam.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, t in docs if not any(_slow_containment(t, x) >= 0.8 - 1e-9 for i, x in items if i is not None))
    assert decontam.find(frame.limit(0), bench).collect() == [] and decontam.find(frame, bench.limit(0)).collect() == []


def test_hits_asked_for_are_almost_never_missed():
    assert 1 <= decontam.needed_hits() < 0.8 * decontam.PERMUTATIONS


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    near = "one two three four five six seven eight nine ten"
    rows = [(None, near, 1), (None, near, 2), (None, near, 1), (4, near, 9), (4, "other text that stands alone", 1), (4, near, 8), (6, "a third", 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, h int, row string")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted([(4, near), (4, "other text that stands alone"), (6, "a third")])
    assert simhash.one_of_each(docs.limit(0)).collect() == []


def test_short_items_and_every_text_of_an_id_are_found(spark):
    docs = spark.createDataFrame([
        (1, "here alpha beta gamma stands inside it"), (2, "Alpha, beta gamma"), (3, "alpha gamma beta and more words"), (4, "beta"), (5, None), (6, ""),
        (7, "x the second passage of this very item y"), (8, "x y the first passage of the very item")], "doc_id long, text string")
    items = spark.createDataFrame([
        (10, "alpha beta gamma"), (11, "the first passage of the very item"), (11, "the second passage of this very item"), (12, "beta"), (13, ""), (14, None),
        (None, "stands inside it")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.containment, r.shared, r.item_shingles) for r in decontam.find(docs, items).collect())
    assert got == [(1, 10, 1.0, 1, 1), (1, 12, 1.0, 1, 1), (2, 10, 1.0, 1, 1), (2, 12, 1.0, 1, 1), (3, 12, 1.0, 1, 1), (4, 12, 1.0, 1, 1),
                   (7, 11, 1.0, 3, 3), (8, 11, 1.0, 3, 3)]
    clean = decontam.clean(docs.withColumn("text_key", F.lit("mine")), items.where("item_id <> 12"))
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6] and clean.columns == ["doc_id", "text", "text_key"]
