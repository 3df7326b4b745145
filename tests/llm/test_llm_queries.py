"""The registered queries: contract columns, SQL where there is any, brute force elsewhere."""

import zlib
from collections import Counter

import oracle
import pytest
from conftest import SF

from listingflow.llm import queries

COLUMNS = {
    "op2_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op3_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op4_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op8_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF), SF, name, queries.QUERIES[name], queries.SQL[name]) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(queries.SQL)))
def test_every_document_has_a_row(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert [c for c in COLUMNS[name] if c in got.columns] == COLUMNS[name]
    docs = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(docs)


def _held_out(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 0


def test_language_is_right_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.QUERIES["op4_language_id"](spark, folder).collect() if r.held_out]
    assert {r.doc_id for r in rows} == {d for d in langs if _held_out(d, 5)}
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_quality_is_right_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op6_quality_classifier"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.95 * len(rows)
    assert not [r for r in rows if labels[r.doc_id] == 1 and r.predicted == 0]


def test_license_lines_are_found(spark):
    wanted = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for name, line in (("MIT-notice", "Released under the MIT License."), ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0.")):
            if line in (r.text or "").split("\n"):
                wanted[r.doc_id, name] += 1
    got = {(r.doc_id, r.license) for r in queries.QUERIES["op9_license_scan"](spark, SF).collect()}
    assert wanted and set(wanted) <= got
