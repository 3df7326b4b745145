import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingflow.llm import ctw, langid, licenses, line_rules, quality, scoring, secrets
from listingflow.llm.shared import shared_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _odd_texts():
    rng = random.Random(2)
    parts = ["a", "b", "The end.", "x|y", "é#", "\n", "\t", " ", "HOME", "cookie policy", "\x0b", "🙂", "word", "z."]
    return [None, "", " \n ", *["".join(rng.choice(parts) + rng.choice(["", " ", "\n"]) for _ in range(rng.randrange(90))) for _ in range(80)]]


def test_line_rules_count_as_defined(spark):
    texts = _odd_texts() + ["a b c d e f g " * 40]
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    for r in line_rules.clean(docs).collect():
        t = texts[r.doc_id] or ""
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        again = {k for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(words) < 10 or 100 * len(again) > 20 * len(words))
        assert not (r.kept and r.base_failed)
        left = [x for x, fault in zip(lines, r.line_faults, strict=True) if fault is None]
        assert r.clean_text == "\n".join(left)
    assert line_rules.clean(docs.limit(0)).where("kept").collect() == []


def test_bad_lines_go_and_good_ones_stay(spark):
    good = "Here is a sentence with quite enough words to stay in the text.\n" * 2 + "Another one of the same kind, only it says something else again.\n"
    bad = good + "Home\n" + "### $$$ %%% &&& ***\n" + "THIS WHOLE LINE IS SHOUTED AT THE READER!\n" + "We use cookies and javascript.\n"
    rows = line_rules.clean(spark.createDataFrame([(1, good), (2, bad), (3, "a | b | c | d\n" * 9 + good[:64])], "doc_id long, text string")).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].clean_text == good.strip() and by[1].lost == 0
    assert [f for f in by[2].line_faults if f] == ["navigation", "symbols", "shouting", "boilerplate"]
    assert not by[3].kept


def _slow_spans(text):
    out = []
    for place, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if len(m.group(rule.part)) >= rule.least:
                out.append((m.start(), place, rule.kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_secrets_and_ledger(spark):
    rng = random.Random(4)
    parts = ["password", "PASSWD", "token", "api_key", "apikey", "=", ": ", "==", '"', "'", "secret", "AKIA", "ABCDEFGH1234567", "deadbeef00112233",
             "0123456789abcdef", "x", " ", "é🙂", "\n", "abcdefghijklmnop", "-----BEGIN RSA PRIVATE KEY-----", "ghp_", "-"]
    texts = [None, "", "password=token: abcdefghijklmnop", "secret = 'aaaaaaaaaaaa'", *["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(150)]]
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate([*texts, texts[3]])], "doc_id long, content string, blob string")
    ledger = secrets.Ledger(spark, shared_path(spark, "test-ledger"))
    rows = secrets.scan_versions(docs, ledger).select("doc_id", secrets.listed(F.col("spans")).alias("s")).collect()
    assert {r.doc_id: r.s for r in rows} == {i: _slow_spans(t or "") for i, t in enumerate([*texts, texts[3]])}
    first = ledger.read(secrets.version_of(secrets.RULES)).count()
    assert first == len({t or "" for t in texts})
    more = docs.unionByName(spark.createDataFrame([(900, "token=abcdefghijkl", "")], docs.schema))
    assert secrets.scan_versions(more, ledger).count() == len(texts) + 2
    assert ledger.read(secrets.version_of(secrets.RULES)).count() == first + 1
    assert secrets.scan_versions(docs, ledger, rules=secrets.BASE).count() == len(texts) + 1
    assert secrets.scan_versions(docs.limit(0), ledger).collect() == []


def _slow_license(text, template, least):
    """All runs of lines, compared in full."""
    lines = (text or "").split("\n")
    full = [i for i, x in enumerate(lines) if licenses.WORD.search(x.lower())]
    best = 0.0
    for a in range(len(full)):
        for b in range(a, len(full)):
            run = "\n".join(lines[full[a]:full[b] + 1])
            best = max(best, licenses.dice(licenses.bigrams(run), licenses.bigrams(template)))
    return best if best >= least - 1e-9 else None


def test_licenses_agree_with_all_runs():
    rng = random.Random(9)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    mit = licenses.TEMPLATES["MIT"].split()
    assert scanner.scan(None) == scanner.scan("") == scanner.scan("!\n?") == []
    for _ in range(25):
        words = [w for w in mit if rng.random() > 0.08] if rng.random() < 0.5 else rng.choices(mit, k=60)
        lines = [" ".join(words[i:i + 12]) for i in range(0, len(words), 12)]
        lines[rng.randrange(len(lines)):0] = ["released under the MIT License", "", "the software"]
        text = "\n".join(["Some words before."] + lines + ["And after it more words.", "Licensed under CC-BY NC 4.0"])
        got = {m.license: m.dice for m in scanner.scan(text)}
        for name, template in licenses.TEMPLATES.items():
            want = _slow_license(text, template, licenses.DICE)
            assert got.get(name) == (None if want is None else pytest.approx(want))


def test_common_licenses_have_templates(spark):
    names = ["BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-header", "GPL-3.0-header", "LGPL-2.1-header", "LGPL-3.0-header", "AGPL-3.0-header",
             "MPL-2.0-header", "EPL-2.0-header", "CC0-1.0-notice", "Unlicense", "CC-BY-4.0-notice", "CC-BY-SA-4.0-header", "CC-BY-NC-ND-4.0-header",
             "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]
    texts = [(i, "Copyright 2021 Example\n" + licenses.TEMPLATES[n] + "\nThen the text goes on.") for i, n in enumerate(names)]
    got = {(r.doc_id, r.license): r.dice for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [got.get((i, n)) for i, n in enumerate(names)] == [1.0] * len(names)
    assert len(licenses.WORD.findall(licenses.TEMPLATES["GPL-3.0"])) > 5000


def test_licenses_inside_paragraphs(spark):
    notice = "This package is free software. Released under the MIT License. Copyright 2021 Example Corp."
    whole = "So it begins here. " * 30 + licenses.TEMPLATES["MIT"] + " and so it goes on." * 30
    docs = spark.createDataFrame([(1, notice), (2, whole), (3, "one\ntwo words Released under\nthe MIT License. And on.")], "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.dice, r.first_line, r.last_line) for r in licenses.scan(docs).collect()}
    assert got[1, "MIT-notice"] == (1.0, 0, 0) and got[2, "MIT"] == (1.0, 0, 0) and got[3, "MIT-notice"] == (1.0, 1, 2)


def test_licenses_agree_with_all_windows_of_words():
    rng = random.Random(12)
    templates = {"a": "x y x y z x y", "b": "the end of the", "c": "z z z z", "d": "y z"}
    scanner = licenses.Scanner(templates, 0.7, lines=False)
    found = 0
    for _ in range(150):
        words = rng.choices(["x", "y", "z", "the", "end", "of"], [3, 3, 2, 1, 1, 1], k=rng.randrange(30))
        got = {m.license: m.dice for m in scanner.scan(" ".join(words))}
        for name, template in templates.items():
            runs = [licenses.dice(licenses.bigrams(" ".join(words[a:b])), licenses.bigrams(template)) for a in range(len(words)) for b in range(a + 2, len(words) + 1)]
            want = max(runs, default=0)
            assert got.get(name) == (pytest.approx(want) if want >= 0.7 - 1e-9 else None)
            found += want >= 0.7
    assert found > 50


def test_license_query_rows(spark):
    docs = spark.createDataFrame([(1, "x\nReleased under the MIT License.", 1), (1, "Released under the MIT License.", 1), (None, None, 2)], "doc_id long, text string, dice int")
    assert sorted(map(tuple, licenses.scan(docs).collect())) == [(1, "MIT-notice", 1.0, 0, 0), (1, "MIT-notice", 1.0, 1, 1)]
    assert licenses.scan(docs.limit(0)).collect() == []


def test_language_of_texts_without_letters_and_of_nothing(spark):
    rows = [(i, "the cat and the dog were there", "en") for i in range(20)] + [(100 + i, "der hund und die katze waren da", "de") for i in range(20)]
    docs = spark.createDataFrame([*rows, (300, None, "en"), (None, "x", "fr"), (301, "12 !", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    asked = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "123 ?!", 1), (4, "the dog and the cat", 1), (5, "die katze und der hund " * 2000, 1)], "doc_id long, text string, language int")
    got = {r.doc_id: r.language for r in langid.identify(asked, model).collect()}
    assert [got[i].lang for i in (1, 2, 3, 4, 5)] == ["und", "und", "und", "en", "de"]
    assert all(got[i].score == 0 and got[i].rejected for i in (1, 2, 3)) and 0.5 < got[4].score <= 1
    nothing = langid.fit(docs.limit(0))
    assert {r.language.lang for r in langid.identify(asked, nothing).collect()} == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    taught = {}
    monkeypatch.setattr(langid, "train", lambda names, examples: taught.update(names=names, counts=Counter(names[e[0]] for e in examples)))
    rows = [(3 * k + i, "some words", f"l{k:03}") for k in range(230) for i in range(3)] + [(9000, "one row again", "rep")] * 9000 + [(9001, "the other", "rep")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langid.fit(docs)
    assert len(taught["names"]) == 231 and taught["counts"]["rep"] == 2 and taught["counts"]["l229"] == 3
    langid.fit(docs, most=231)
    assert len(taught["counts"]) == 231 and set(taught["counts"].values()) == {1}


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    texts = ["", "a", *["".join(rng.choice(list("ab c.1É"), 50)) for _ in range(30)], None, "ß"]
    model = quality.Model(np.append(rng.normal(size=1 << quality.BITS), 0).astype(np.float32), 0.3)
    whole = model.scores(texts)
    assert all(whole[i] == model.scores([t])[0] for i, t in enumerate(texts))
    index, bounds, counted = quality.features(["Aa aa! 12", "", "x"])
    assert list(counted) == [4, 0, 1] and list(bounds) == [0, 12, 12, 15]


def test_quality_without_labels_and_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (2, "a b", 3), (None, "c", 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (2, 0), (77, 1), (None, 1)], "doc_id long, label int")
    for used in (labels, labels.limit(0)):
        rows = quality.score(docs, quality.fit(docs, used)).collect()
        assert len(rows) == 4 and all(0 < r.score < 1 for r in rows)
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}


def _kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)


def _slow_ctw(train, depth, share):
    """Log2 probability of a byte in a context, by recursion over the context tree of each choice."""
    data = [(bytes(depth) + t, i) for t in train for i in range(depth, depth + len(t) + 1)]
    seen = [((t + b"\0")[i], t[i - depth:i]) for t, i in data]
    total = len(seen)

    def bits(b):
        return [(b >> (7 - k)) & 1 for k in range(8)]

    def kept(suffix):
        return sum(c[depth - len(suffix):] == suffix for _, c in seen) * share >= total

    def node(suffix, prefix, rest=None):
        """Counts of a choice in a context, or in what its kept extensions leave over."""
        n = [0, 0]
        for b, c in seen:
            if c[depth - len(suffix):] == suffix and (rest is None or c[depth - len(suffix) - 1:] not in rest) and bits(b)[:len(prefix)] == prefix:
                n[bits(b)[len(prefix)]] += 1
        return n

    def longer(suffix):
        if len(suffix) == depth:
            return set()
        return {c[depth - len(suffix) - 1:] for _, c in seen if c[depth - len(suffix):] == suffix and kept(c[depth - len(suffix) - 1:])}

    def weighted(suffix, prefix):
        own, below = _kt(*node(suffix, prefix)), longer(suffix)
        if not below:
            return own
        rest = _kt(*node(suffix, prefix, below)) + sum(weighted(s, prefix) for s in below)
        return np.logaddexp(own, rest) - math.log(2)

    def one(context, suffix, prefix):
        n = node(suffix, prefix)
        own, below = (n[1] + 0.5) / (sum(n) + 1), longer(suffix)
        if not below:
            return own
        rest = node(suffix, prefix, below)
        other = _kt(*rest) + sum(weighted(s, prefix) for s in below)
        w = 1 / (1 + math.exp(other - _kt(*n)))
        nxt = context[depth - len(suffix) - 1:]
        deep = one(context, nxt, prefix) if nxt in below else (rest[1] + 0.5) / (sum(rest) + 1)
        return w * own + (1 - w) * deep

    def score(text):
        t, out = bytes(depth) + text + b"\0", 0.0
        for i in range(depth, len(t)):
            for k in range(8):
                p = one(t[i - depth:i], b"" if depth == 0 else t[i:i], bits(t[i])[:k])
                out += math.log10(p if bits(t[i])[k] else 1 - p)
        return out

    return score


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_context_tree_agrees_with_recursion(spark, depth):
    train = [b"abab", b"abba", b"", b"aab"]
    keys, n = ctw.grams(train, depth)
    model = ctw.fit(spark.createDataFrame([(int(k), int(c)) for k, c in zip(keys, n, strict=True)], "key long, n long"), depth, share=6)
    slow = _slow_ctw(train, depth, 6)
    for text in (b"", b"ab", b"bbz"):
        assert model.scores([text])[0] == pytest.approx(slow(text), rel=1e-4)
    assert np.allclose((10.0 ** model.leaves.astype(float)).sum(axis=1), 1, atol=1e-4)


@pytest.mark.parametrize(("depth", "top", "run"), [(0, 3, 1), (1, 3, 1), (2, 3, 4), (2, 1, 1), (2, 1, 1000), (2, 0, 5)])
def test_every_context_is_in_the_table(spark, monkeypatch, depth, top, run):
    monkeypatch.setattr(ctw, "RUN", run)
    train = [b"abab", b"abba", b"", b"aab", b"abcabc"]
    n = Counter(dict(zip(*(x.tolist() for x in ctw.grams(train, depth)), strict=True)))
    asked = [b"", b"ab", b"bbz", b"cab"]
    counts = [(k, n[k]) for k in {*n, *ctw.grams(asked, depth)[0].tolist()}]
    log = {r.key: r.log for r in ctw.table(spark.createDataFrame(counts, "key long, n long"), depth, top).collect()}
    assert set(log) == {k for k, _ in counts}
    slow = _slow_ctw(train, depth, 10**9)  # no context is too rare
    for text in asked:
        names, place, _ = ctw.placed([text], depth)
        assert sum(log[int(k)] for k in names[place]) == pytest.approx(slow(text), rel=1e-9)


@pytest.mark.parametrize("keys", [1 << 21, 40, 0])
def test_rare_contexts_count_at_any_corpus_size(spark, monkeypatch, keys):
    """A passage seen often enough to be learned, in a corpus where it is less than 1/65,536 of the bytes."""
    monkeypatch.setattr(scoring, "KEYS", keys)
    passage = "qjxzvk wvqzjx"
    texts = ["the cat and the dog were there " * 400] * 100 + [passage] * 8
    docs = spark.createDataFrame([*enumerate(texts), (900, passage), (901, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in scoring.score(docs, F.col("doc_id") < 900).collect()}
    assert len(got) == len(texts) + 2
    assert got[900].bits_per_byte == pytest.approx(got[100].bits_per_byte, rel=1e-9) and got[900].bits_per_byte < 1.5
    n = dict(zip(*(x.tolist() for x in ctw.grams([t.encode() for t in texts])), strict=True))
    assert min(n.values()) * (1 << 16) < sum(n.values())


def test_scores_and_base_of_documents(spark):
    texts = {1: "the cat The", 2: "a dog", 3: None, 4: "", 5: "the zebra " * 300, 6: "é x é x"}
    docs = spark.createDataFrame([*texts.items(), (None, "the"), (1, "the cat The")], "doc_id long, text string").withColumn("score", F.lit("x"))
    rows = scoring.score(docs, F.col("doc_id") != 5).collect()
    words = Counter()
    lessons = [t for d, t in [*texts.items(), (1, texts[1])] if d != 5]
    for t in lessons:
        words.update(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    total, distinct = sum(words.values()) + len(lessons), len(words) + 1
    assert len(rows) == 8
    for r in rows:
        mine = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), ("the" if r.doc_id is None else texts[r.doc_id]) or ""))
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in [*[words[w] for w in mine], len(lessons)])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine) + 1, sum(words[w] > 0 for w in mine) + 1, total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    untaught = scoring.score(docs, F.lit(False)).collect()
    assert {round(r.bits_per_byte, 4) for r in untaught} == {8.0}
    assert scoring.score(docs.limit(0), F.lit(True)).collect() == []


def test_a_blob_that_two_runs_added_is_one_row_and_other_rules_scan_again(spark):
    docs = spark.createDataFrame([(1, "token = abcdefghijkl9"), (2, "none")], "doc_id long, text string")
    ledger = secrets.Ledger(spark, shared_path(spark, "test-ledger"))
    first = secrets.scan_versions(docs, ledger, "text").collect()
    version = secrets.version_of(secrets.RULES)
    ledger.add(ledger.read(version), version)  # as a run does that started at the same time
    assert sorted(map(str, secrets.scan_versions(docs, ledger, "text").collect())) == sorted(map(str, first))
    longer = (secrets.Rule("assign", secrets.BASE[0].pattern, 2, 99),)
    assert [r.spans for r in secrets.scan_versions(docs, ledger, "text", longer).collect()] == [[], []]


def test_line_rules_keep_columns_of_their_own_names(spark):
    docs = spark.createDataFrame([(1, "A line that stands here, whole.", 5, "x", 7)], "doc_id int, text string, _next int, _Hashes string, _lines int")
    row = line_rules.clean(docs).collect()[0].asDict()
    assert (row["_next"], row["_Hashes"], row["_lines"], row["n_words"]) == (5, "x", 7, 6)
    assert line_rules.clean(docs.select("doc_id", F.col("text").alias("_next")), "_next").collect()[0].n_words == 6
