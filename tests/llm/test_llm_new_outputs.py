"""Resampling, token files and vector codes against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from listingflow.llm import balls, codes, queries, rans, resampling, tokens
from listingflow.llm.shared import shared_path

# ---- resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORDS.findall(low)
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def _resampled(docs, target):
    s = Counter(b for _, t in docs for b in _features(t)[1])
    t = Counter(b for x in target for b in _features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    rows, able = [], []
    for i, (key, text) in enumerate(docs):
        n, own = _features(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(own), weight, score, None])
        if n >= 20:
            able.append((-score, key is None, key or 0, i))
    for rank, (*_, i) in enumerate(sorted(able)[:25 * len(able) // 100], 1):
        rows[i][4] = rank
    return Counter(map(tuple, rows))


def _text_rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_resampling_query_agrees_with_brute_force(spark):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.QUERIES["op11_importance_resampling"](spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_features", "weight", "score", "rank")]]
    assert Counter(map(tuple, got.collect())) == _resampled(_text_rows(spark), target)


def test_resampling_of_nulls_ties_long_texts_and_clashing_columns(spark, monkeypatch):
    # whatever the head holds and however slices fall, results stay
    monkeypatch.setattr(resampling, "COMMON", 8)
    rng = random.Random(3)
    words = ["Alpha", "be-ta", "größe", "x1", "日本", "ÅÉ", "end."]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(1, None), (2, ""), (3, "..."), (None, some(30)), (None, some(25)), (4, some(40)), (4, some(40)), (5, some(3)), (6, some(300_000))]
    same = some(50)
    docs += [(7, same)] * 40 + [(i, some(20 + i % 5)) for i in range(8, 60)]
    frame = spark.createDataFrame([(k, t, 1, "c", None) for k, t in docs], "doc_id long, text string, score int, counts string, rank string")
    target = spark.createDataFrame([("alpha be ta", 1), (None, 2), (some(30), 3)], "text string, n_words int")
    got = Counter(map(tuple, resampling.resample(frame, target).collect()))
    assert got == _resampled(docs, [r.text for r in target.collect()])


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    assert [tuple(r)[:2] for r in resampling.resample(some, none).collect()] == [(1, 79)]


# ---- token files


def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _expected(docs):
    t, out, start = _tokenizer(), Counter(), 0
    for key, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out[key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    return out


def test_token_query_agrees_with_whole_text_encoding(spark):
    got = queries.QUERIES["op12_token_output"](spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert Counter(map(tuple, got.collect())) == _expected(sorted(_text_rows(spark)))


SIGNS = st.text(st.sampled_from("abAZz09 '!|<>=,.\n\t\r_é̸  …日ſİΣς½"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(SIGNS, st.text(max_size=30), st.sampled_from(["<|endoftext|>", "a<|startoftext|>b", "don't!'s", "a!'s it's", None, ""])), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    import pyarrow as pa

    from listingflow.llm.pieces import text_slices

    file = tokens.public("word_bpe_49k.json", 2).file
    texts = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    for _, data, bounds in text_slices(pa.array(texts, pa.string())):
        ids, at = tokens._by_piece(data, bounds, file)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [
            _tokenizer_cached().encode(t or "", add_special_tokens=False).ids for t in texts]


_CACHE = []


def _tokenizer_cached():
    if not _CACHE:
        _CACHE.append(_tokenizer())
    return _CACHE[0]


def test_ids_come_back_from_files_with_nulls_repeats_and_long_texts(spark, monkeypatch):
    docs = [(None, "last one"), (3, None), (1, "same"), (1, "same"), (2, ""), (0, "word " * 70_000), (5, "<|endoftext|> it's"), (4, "Ärger über ½")]
    frame = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, n string")
    path = shared_path(spark, "tokens")
    tokens.write(frame, path, tokens.public("word_bpe_49k.json", 2))
    got = tokens.read(spark, path, ids=True).collect()
    t = _tokenizer()
    assert Counter((r.key, tuple(r.ids)) for r in got) == Counter((k, (*t.encode(x or "", add_special_tokens=False).ids, 2)) for k, x in docs)
    assert Counter(tuple(r)[:4] for r in got) == _expected(sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)))


def test_keys_may_be_texts_and_other_tokenizers_see_whole_texts(spark):
    frame = spark.createDataFrame([("b", " two  words"), ("a", "x")], "name string, body string")
    path = shared_path(spark, "tokens")
    tokens.write(frame, path, tokens.public("byte_bpe_50k.json", 50256, by_piece=False), key="name", text="body")
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {k: [*t.encode(x, add_special_tokens=False).ids, 50256] for k, x in (("a", "x"), ("b", " two  words"))}
    assert {r.key: (r.start, r.ids) for r in tokens.read(spark, path, ids=True).collect()} == {"a": (0, want["a"]), "b": (len(want["a"]), want["b"])}


def test_no_documents_give_a_file_set_without_blocks(spark):
    path = shared_path(spark, "tokens")
    tokens.write(spark.createDataFrame([], "doc_id long, text string"), path, tokens.public("word_bpe_49k.json", 2))
    assert tokens.read(spark, path).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70_000), max_size=400), max_size=5), st.integers(0, 3))
def test_blocks_are_coded_without_loss(blocks, repeat):
    blocks = [np.array(b * (1 + 30 * repeat), np.int64) for b in blocks] + [np.array([7], np.int64)]
    ids, counts = np.unique(np.concatenate(blocks), return_counts=True)
    table = rans.table_of(ids, counts)
    assert table.share.sum() == 1 << table.bits and table.share.min() >= 1
    coded = rans.encode(blocks, table)
    assert [b.tolist() for b in rans.decode(coded, table)] == [b.tolist() for b in blocks]
    assert rans.decode(coded[-1:], table)[0].tolist() == [7]  # alone


def test_parts_at_and_across_checkpoints_and_the_size_reached():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.geometric(0.02, 60_000), 3000)
    found, counts = np.unique(ids, return_counts=True)
    table = rans.table_of(found, counts)
    step = rans.STEP * rans.LANES
    blocks = [ids[:n] for n in (step - 1, step, step + 1, 3 * step + 5, 60_000, 0)]
    coded = rans.encode(blocks, table)
    assert all((a == b).all() for a, b in zip(rans.decode(coded, table), blocks, strict=True))
    p = counts / counts.sum()
    checkpoints = 8 * (8 + 8 * rans.LANES + 4)  # a place, the states and a checksum for each of eight parts
    assert (len(coded[4]) - rans.HEADER.size - checkpoints) * 8 < 60_000 * (-(p * np.log2(p)).sum() + 0.02)


def test_damage_is_noticed():
    ids = np.arange(20_000) % 97
    table = rans.table_of(*np.unique(ids, return_counts=True))
    raw = rans.encode([ids], table)[0]
    for at in (0, 30, rans.HEADER.size + 5, len(raw) // 2, len(raw) - 1):
        with pytest.raises(rans.Damaged):
            rans.decode([raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1:]], table)
    with pytest.raises(rans.Damaged):
        rans.decode([raw], rans.table_of(np.arange(98), np.ones(98, int)))


# ---- vector codes


@pytest.mark.parametrize(("n", "width", "spread"), [(1, 4, 5), (40, 1, 2), (700, 4, 3), (3000, 4, 60), (900, 7, 10**6)])
def test_trees_find_the_nearest_entry_of_every_part(n, width, spread):
    rng = np.random.default_rng(n)
    points = rng.integers(-spread, spread + 1, (5, n, width))
    points[:, :n // 3] = points[:, :1]  # a third are copies
    books = points[:, rng.integers(0, n, 64)]  # entries that equal one another too
    forest = balls.build(points)
    want = ((points[:, :, None, :] - books[:, None]) ** 2).sum(-1).argmin(-1)
    assert (balls.owners(forest, books) == want.T).all()
    sums, count = balls.totals(forest, books)
    for p in range(5):
        assert (count[p] == np.bincount(want[p], minlength=64)).all()
        assert all((sums[p, e] == points[p][want[p] == e].sum(axis=0)).all() for e in range(64))


def test_balls_hold_their_points_and_copies_are_owned_whole():
    rng = np.random.default_rng(0)
    points = rng.integers(-50, 50, (1, 1000, 3))
    f = balls.build(points)
    assert f.count[f.root[0]] == 1000 and (f.sums[f.root[0]] == points[0].sum(axis=0)).all()
    for b in range(len(f.part)):
        stack, own = [b], []
        while stack:
            i = stack.pop()
            if f.left[i] < 0:
                own.extend(f.order[f.first[i]:f.first[i] + f.count[i]])
            else:
                stack += [f.left[i], f.right[i]]
        assert len(own) == f.count[b] and np.sqrt(((points[0][own] - f.centre[b]) ** 2).sum(axis=1)).max() <= f.radius[b]
    copies = balls.build(np.repeat(points[:, :1], 5000, axis=1))
    whole, single = balls.assign(copies, points[:, :64])
    assert not single and len(copies.part) == 1 and sum(len(b) for b, _ in whole) == 1


def _compressed(rows, width, parts=16, k=64):
    kept = [(i, np.floor(np.array(v, np.float64) * 256).astype(np.int64), lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, tuple(r[1])))
    edges = [p * width // parts for p in range(parts + 1)]
    cut = [np.array([v[a:b] for _, v, _ in kept]) for a, b in zip(edges, edges[1:], strict=False)]
    books = [c[:k].copy() for c in cut]
    near = lambda c, b: ((c[:, None] - b[None]) ** 2).sum(-1)
    for _ in range(2):
        own = [near(c, b).argmin(1) for c, b in zip(cut, books, strict=True)]
        for p in range(parts):
            for e in range(len(books[p])):
                if (own[p] == e).any():
                    books[p][e] = cut[p][own[p] == e].sum(axis=0) // (own[p] == e).sum()
    d = [near(c, b) for c, b in zip(cut, books, strict=True)]
    code = ["".join(f"{x.argmin():02x}" for x in row) for row in zip(*d, strict=True)]
    error = [int(sum(x.min() for x in row)) for row in zip(*d, strict=True)]
    by = Counter()
    for (_, _, lab), e in zip(kept, error, strict=True):
        by[lab] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b.tolist() for x in e).encode()).hexdigest()
    return Counter((i, c, e, by[lab], sha) for (i, _, lab), c, e in zip(kept, code, error, strict=True))


@pytest.mark.parametrize("width", [64, 20])
def test_codes_of_nulls_repeats_ties_and_clashing_columns(spark, width, monkeypatch):
    monkeypatch.setattr(codes, "CHUNK_COMPONENTS", 1 << 12)
    rng = np.random.default_rng(width)
    rows = [(int(i), rng.normal(0, 0.3, width).astype(np.float32).tolist(), int(i) % 5) for i in rng.permutation(400)]
    rows += [(7, rows[0][1], None)] * 200 + [(None, rows[1][1], 2), (None, rows[2][1], None), (901, None, 1), (902, [0.0] * (width - 1) + [None], 1),
             (903, [float("nan")] * width, 1), (904, [float("inf")] * width, 1), (905, [0.0] * (width - 1) + [-float("inf")], 1)]
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, code string, error double")
    got = Counter(map(tuple, codes.compress(frame).collect()))
    assert got == _compressed(rows, width)


def test_other_lengths_large_numbers_few_rows_and_none(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert codes.compress(spark.createDataFrame([], kind)).collect() == []
    one = codes.compress(spark.createDataFrame([(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [1.0], 1), (4, [], 1)], kind)).collect()
    found = {r.vec_id: (r.code, r.error) for r in one}
    assert found == {1: ("00" * 16, 0), 2: ("01" * 16, 0), 3: (None, None), 4: (None, None)}
    assert codes.compress(spark.createDataFrame([(3, [], None)], kind)).count() == 1
