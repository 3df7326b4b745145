"""The pipeline's stages, each held against its own input."""

import corpus_pipeline
from conftest import SF

from listingflow.llm import decontam, simhash
from listingflow.llm.queries import KEEP_QUALITY, QUERIES
from listingflow.llm.shared import stored


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name.replace(" ", "-"))
        outs.append(docs)
        if len(outs) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    ids = [[r.doc_id for r in out.collect()] for out in outs]
    scores = {r.doc_id: r.score for r in QUERIES["op6_quality_classifier"](spark, SF).collect()}
    assert sorted(ids[0]) == sorted(d for d in before if scores[d] >= KEEP_QUALITY)
    prints = {d: simhash.fingerprint(before[d].text) for d in ids[0]}
    group = {d: d for d in ids[0]}
    changed = True
    while changed:
        changed = False
        for a in ids[0]:
            for b in ids[0]:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and group[b] < group[a]:
                    group[a], changed = group[b], True
    assert sorted(ids[1]) == sorted(set(group.values()))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.doc_id for r in decontam.find(outs[1], bench).collect()}
    assert bad and sorted(ids[2]) == sorted(set(ids[1]) - bad)
    assert set(ids[3]) == set(ids[2]) and all(ids[3].count(d) <= 2 for d in set(ids[3]))
    assert sorted(ids[4]) == sorted(ids[3])
    last = outs[4].collect()
    assert len({(r.shard, r.slot) for r in last}) == len(last)
    assert {(r.doc_id, r.text) for r in last} <= {(d, r.text) for d, r in before.items()}


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns[-2:] == ["shard", "slot"]
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
