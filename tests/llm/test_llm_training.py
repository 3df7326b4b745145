"""The trainers against plain loops, and registered queries against their contracts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest import SF

from listingflow.llm import langid, quality, queries


def _examples(labels, count, size, seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        index = np.sort(rng.choice(size, 6, replace=False)).astype(np.int32)
        share = rng.random(6)
        out.append((int(rng.integers(labels)), index, (share / share.sum()).astype(np.float32)))
    return out


def test_ftrl_updates_are_those_of_a_plain_loop():
    examples = _examples(2, 60, 40, 1)
    alpha, beta, l1, l2 = 0.3, 1.0, 0.002, 0.001
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if i != "bias" and abs(z[i]) <= l1:
            return 0.0
        far = 0.0 if i == "bias" else math.copysign(l1, z[i])
        return -(z[i] - far) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(3):
        for label, index, share in examples:
            x = {int(i): float(np.float32(s)) * quality.SCALE for i, s in zip(index, share, strict=True)} | {"bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    model = quality.train(examples)
    assert math.isclose(model.bias, weight("bias"), rel_tol=1e-6)
    assert all(math.isclose(model.weights[i], weight(i), rel_tol=1e-4, abs_tol=1e-6) for i in range(40))
    assert not model.weights[40:].any()


def test_sgd_updates_are_those_of_a_plain_loop():
    classes, examples = ("a", "b", "c"), _examples(3, 40, 30, 2)  # fewer than 50: none is kept back
    rng = np.random.default_rng(11)
    embed = ((rng.random((1 << langid.BITS, langid.DIM)) - 0.5) / langid.DIM).tolist()[:30]
    weight = rng.normal(0, 0.1, (langid.DIM, 3)).tolist()
    bias, done, steps = [0.0] * 3, 0, 3 * len(examples)
    for _ in range(3):
        for label, index, share in examples:
            mean = [sum(float(s) * embed[i][k] for i, s in zip(index, share, strict=True)) for k in range(langid.DIM)]
            raw = [sum(mean[k] * weight[k][c] for k in range(langid.DIM)) + bias[c] for c in range(3)]
            top = [math.exp(x - max(raw)) for x in raw]
            g = [t / sum(top) - (c == label) for c, t in enumerate(top)]
            rate = 2.0 * (1 - done / steps)
            back = [sum(weight[k][c] * g[c] for c in range(3)) for k in range(langid.DIM)]
            for k in range(langid.DIM):
                for c in range(3):
                    weight[k][c] -= rate * mean[k] * g[c]
            for c in range(3):
                bias[c] -= 0.1 * rate * g[c]
            for i, s in zip(index, share, strict=True):
                for k in range(langid.DIM):
                    embed[i][k] -= rate * 30 * float(s) * back[k]
            done += 1
    model = langid.train(classes, examples)
    want = np.array(embed) @ np.array(weight)
    assert np.allclose(model.table[:30], want, rtol=1e-3, atol=1e-4) and np.allclose(model.bias, bias, rtol=1e-4, atol=1e-6)


def test_sharding_query_keeps_its_law(spark):
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, None if r.text is None else zlib.crc32(r.text.encode()))
                    for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = queries.QUERIES["op2_sharding"](spark, SF).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_mixing_query_spends_the_budgets_of_the_target_entropy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes, count = {}, Counter()
    for r in docs:
        n = len((r.text or "").replace("\x0b", " ").replace("\x0c", " ").split())
        sizes[r.doc_id] = (r.source, n)
        count[r.source] += n
    total = sum(count.values())

    def weights(e):
        raw = {s: (c / total) ** e for s, c in count.items() if c}
        z = sum(raw.values())
        return {s: x / z for s, x in raw.items()}

    def entropy(e):
        return -sum(w * math.log(w) for w in weights(e).values())

    low, high = 0.0, 1.0
    if entropy(1.0) >= queries.MIX_ENTROPY:
        low = 1.0
    else:
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if entropy(middle) >= queries.MIX_ENTROPY else (low, middle)
    want = {s: w * total for s, w in weights(low).items()}
    rows = queries.QUERIES["op1_source_mixing"](spark, SF).collect()
    spent, largest = Counter(), max(n for _, n in sizes.values())
    for r in rows:
        spent[r.source] += r.n_tokens
        assert (r.source, r.n_tokens) == sizes[r.doc_id]
    # a budget is exceeded by less than the last document
    assert all(-2 - want[s] * 1e-6 <= spent[s] - want[s] <= largest + 2 for s in want)
    for s in want:
        times = Counter(r.doc_id for r in rows if r.source == s and r.n_tokens)
        assert not times or max(times.values()) - min(times.values()) <= 1
