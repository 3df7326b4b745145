import math
from collections import Counter

from pyspark.sql import functions as F

from listingflow.llm import mixing, sharding


def _place(rows):
    return {(r.shard, r.slot): r for r in rows}


def test_shards_are_level_gapless_and_repeatable(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50), i) for i in range(1001)] + [(None, None, None)] * 5, "id long, text string, slot int")
    run = lambda: sharding.external_shuffle(docs, sharding.text_bytes("text"), shards=7, bucket_bytes=2000).collect()
    rows = run()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == 1006 and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    assert Counter(r.id for r in rows) == Counter([*range(1001), *[None] * 5])
    assert _place(rows) == _place(run())
    order = [r.id for _, r in sorted(_place(rows).items())]
    rising = sum(1 for a, b in zip(order, order[1:], strict=False) if a is not None and b is not None and a < b)
    assert 400 < rising < 600  # as many up as down


def test_equal_rows_that_overfill_a_bucket_are_cut(spark):
    docs = spark.createDataFrame([(1, "same")] * 9000 + [(i, "t") for i in range(2, 500)], "id long, text string")
    rows = sharding.external_shuffle(docs, sharding.text_bytes("text"), shards=3, bucket_rows=500).collect()
    assert len({(r.shard, r.slot) for r in rows}) == len(rows) == 9498
    assert Counter(r.id for r in rows)[1] == 9000


def test_empty_and_fewer_rows_than_shards(spark):
    none = spark.createDataFrame([], "id long, text string")
    assert sharding.external_shuffle(none, sharding.text_bytes("text")).collect() == []
    two = spark.createDataFrame([(1, None), (2, "")], "id long, text string")
    assert len(sharding.external_shuffle(two, sharding.text_bytes("text")).collect()) == 2


def test_sizes_and_crc(spark):
    rows = sharding.document_records(spark.createDataFrame([(1, "é"), (2, None), (3, "")], "doc_id long, text string")).collect()
    assert [(r.size, r.text_crc32) for r in rows] == [(3, __import__("zlib").crc32("é".encode())), (1, None), (1, 0)]


def test_written_shards_read_back(spark, tmp_path):
    docs = spark.range(100).withColumn("text", F.lit("ab"))
    out = sharding.external_shuffle(docs, sharding.text_bytes("text"), shards=4)
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(tuple, back.select("id", "shard", "slot").collect())) == sorted(map(tuple, out.select("id", "shard", "slot").collect()))


def _docs(spark):
    sizes = {"a": (400, 10), "b": (60, 5), "c": (9, 3), None: (20, 4)}
    rows = [(f"{s}{i}", s, n + i % 3, "kept") for s, (count, n) in sizes.items() for i in range(count)]
    return spark.createDataFrame(rows, "doc_id string, source string, tokens long, epoch string"), rows


def _weights(totals, k):
    raw = {s: (t / sum(totals.values())) ** k for s, t in totals.items()}
    return {s: r / sum(raw.values()) for s, r in raw.items()}


def test_exponents_agree_with_bisection(spark):
    docs, rows = _docs(spark)
    totals = Counter()
    for _, s, n, _ in rows:
        totals[s] += n
    table = mixing.source_totals(docs.select("source", "tokens"))
    entropy = lambda k: -sum(w * math.log(w) for w in _weights(totals, k).values())
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(mid) >= 1.1 else (low, mid)
    assert abs(mixing.exponent_for_entropy(table, 1.1) - low) < 1e-6
    assert mixing.exponent_for_entropy(table, 9.0) == 0.0
    k = mixing.exponent_for_repeats(table, 3.0, None)
    times = {s: w / totals[s] for s, w in _weights(totals, k).items()}
    assert 2.999 < max(times.values()) / min(times.values()) <= 3.0 + 1e-9
    assert mixing.exponent_for_repeats(table, 1e9, None) == 0.0


def test_budgets_are_spent_in_permutations(spark):
    docs, rows = _docs(spark)
    got = mixing.mix(docs, entropy=1.2, epochs=1.0, block_rows=16).collect()
    size = {d: n for d, _, n, _ in rows}
    source = {d: s for d, s, _, _ in rows}
    totals = Counter()
    for d, n in size.items():
        totals[source[d]] += n
    weights = _weights(totals, mixing.exponent_for_entropy(mixing.source_totals(docs.select("source", "tokens")), 1.2))
    for s in totals:
        mine = sorted((r for r in got if r.source == s), key=lambda r: r["at"])
        budget = math.floor(round(weights[s], 12) * sum(totals.values()))
        assert [r["at"] for r in mine] == [sum(size[x.doc_id] for x in mine[:i]) for i in range(len(mine))]
        assert mine[-1]["at"] < budget <= mine[-1]["at"] + size[mine[-1].doc_id]
        seen = Counter(r.doc_id for r in mine)
        assert max(seen.values()) - min(seen.get(d, 0) for d in size if source[d] == s) <= 1
        blocks = [(r.epoch, r.block) for r in mine]
        assert len([1 for a, b in zip(blocks, blocks[1:], strict=False) if a != b]) == len(set(blocks)) - 1  # block by block
    again = mixing.mix(docs, entropy=1.2, epochs=1.0, block_rows=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_cover_uses_every_row_and_keeps_the_limit(spark):
    docs, rows = _docs(spark)
    seen = Counter(r.doc_id for r in mixing.mix(docs, repeats=2.0).collect())
    assert set(seen) == {d for d, *_ in rows} and max(seen.values()) == 2
    once = Counter(r.doc_id for r in mixing.mix(docs, repeats=1.0).collect())
    assert set(once.values()) == {1}


def test_mix_of_nothing_and_of_texts_without_words(spark):
    none = spark.createDataFrame([], "doc_id long, source string, tokens long")
    assert mixing.mix(none, repeats=2.0).collect() == []
    odd = spark.createDataFrame([(1, "a", 0), (2, "a", None), (3, "a", 5), (None, "a", 5)], "doc_id long, source string, tokens long")
    assert len(mixing.mix(odd, repeats=1.0).collect()) == 4
    assert spark.range(1).select(mixing.tokens_of(F.lit(" a\tb")), mixing.tokens_of(F.lit(None))).head()[:] == (2, 0)


def test_sources_without_tokens_stay_in_a_mix_without_a_budget(spark):
    rows = [(1, "a", 5), (2, "a", 5), (3, "b", 0), (4, "b", None), (5, None, 0), (6, "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    got = Counter(r.doc_id for r in mixing.mix(docs, repeats=2.0).collect())
    assert set(got) == {1, 2, 3, 4, 5, 6} and got[3] == got[4] == got[5] == 1 and max(got.values()) <= 2
    # a budget has nothing to spend on them
    assert {r.doc_id for r in mixing.mix(docs, repeats=9.0, epochs=1.0).collect()} == {1, 2, 6}
    blank = docs.where("doc_id IN (3, 4, 5)")
    assert sorted(r.doc_id for r in mixing.mix(blank, repeats=2.0).collect()) == [3, 4, 5]


def test_null_keys_do_not_share_a_block(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).alias("tokens"), F.col("id").alias("x"))
    sizes = Counter(r.block for r in mixing.mix(docs, repeats=2.0).collect())
    assert sum(sizes.values()) == 20_000 and len(sizes) == 40 and max(sizes.values()) < 700
