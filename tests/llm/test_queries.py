"""The registered queries beside their SQL, and the pipeline beside its stages."""

from __future__ import annotations

import pytest

import corpus_pipeline
import tests.oracle as oracle
from textloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_beside_sql(spark, monkeypatch, name):
    monkeypatch.setattr(oracle, "QUERIES", QUERIES)
    monkeypatch.setattr(oracle, "ORACLES", ORACLES)
    assert oracle.compare(spark, oracle.connect(FOLDER), FOLDER, name) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER), name)
        seen.append((before, docs))
    kept = [[r["doc_id"] for r in after.collect()] for _, after in seen]
    assert all(after.columns == before.columns for before, after in seen[:-1])
    assert set(kept[0]) == set(rows)  # all have a language
    from tests.llm.test_shared_text import components

    groups = components([(i, r["text"]) for i, r in rows.items()])
    assert sorted(kept[1]) == sorted({c for _, _, c in groups})
    found = {r["doc_id"] for r in QUERIES["op4_benchmark_decontamination"](spark, FOLDER).collect()}
    assert sorted(kept[2]) == sorted(set(kept[1]) - found)
    assert set(kept[3]) <= set(kept[2]) and max(kept[3].count(i) for i in set(kept[3])) <= 2
    assert sorted(kept[4]) == sorted(kept[3])
    last = sorted(seen[4][1].collect(), key=lambda r: r["start"])
    assert [r["start"] for r in last] == [sum(x["n_tokens"] for x in last[:k]) for k in range(len(last))]
    assert [r["doc_id"] for r in last] == sorted(r["doc_id"] for r in last)
