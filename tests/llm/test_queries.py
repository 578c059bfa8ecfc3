"""Every registered query of the subpackage, and the pipeline against plain Python."""

from __future__ import annotations

import zlib

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from salesmart.llm import queries as llm
from salesmart.llm import mixing, quality_mil, token_ids
from tests.compare import problems

from .common import WORD, collected, connect, empty, nasty
from .test_free import _components, _contaminated, _fingerprint

QUERIES, SQL = llm.queries(), llm.oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert problems(spark, connect(sf_dir), QUERIES[name], SQL.get(name), sf_dir) == []


def test_all_are_registered():
    names = driver.queries()
    assert [n.partition("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(SQL) <= set(driver.oracle_sql())


def test_held_out_accuracy(spark, sf_dir):
    rows = QUERIES["op2_quality_mil"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 40 and sum(p == q for p, q in held) / len(held) > 0.95


def test_pipeline_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.id for r in quality_mil.quality_scores(docs, labels).where("score >= 0.3").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good]
    fps = {i: _fingerprint(t) for i, t, _ in rows}
    root = _components(fps.values(), 2)
    least: dict = {}
    for i in sorted(fps):
        least.setdefault(root[fps[i]], i)
    rows = [r for r in rows if r[0] in set(least.values())]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {int(i) for i, _, n, _ in _contaminated([r[:2] for r in rows], items) if not n}
    rows = [r for r in rows if r[0] in clean]
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    targets = mixing.capped_targets(size, mixing.ranked_weights(sorted(size)), 3, sum(size.values()))

    stage = docs
    for name, step in corpus_pipeline.STAGES[:4]:
        stage = corpus_pipeline.stage(step(spark, stage, sf_dir), name)
        assert stage.columns == docs.columns
        if name == "benchmark_decontamination":
            assert {r.doc_id for r in stage.collect()} == clean and stage.count() == len(clean)
    mixed = stage.collect()
    assert {r.doc_id for r in mixed} <= clean
    for s, target in targets.items():
        longest = max(len(WORD.findall(t or "")) for _, t, x in rows if x == s)
        assert abs(sum(len(WORD.findall(r.text or "")) for r in mixed if r.source == s) - target) <= longest
    out = corpus_pipeline.STAGES[4][1](spark, stage, sf_dir).collect()
    whole = token_ids.Encoder(llm.vocabulary()).whole
    want = sorted((r.doc_id, zlib.crc32(whole([r.text or ""])[0] + b"\x02\0\0\0")) for r in mixed)
    assert sorted((r.doc_id, r.ids_crc32) for r in out) == want


def test_pipeline_stages_on_hard_rows(spark, sf_dir):
    for docs in (nasty(spark).select("doc_id", "text", "source", "row", "id"), empty(spark)):
        for name, step in corpus_pipeline.STAGES:
            before, docs = docs, corpus_pipeline.stage(step(spark, docs, sf_dir), name)
            if name != "token_ids":
                assert docs.columns == before.columns
                assert set(collected(docs.select("doc_id", "text"))) <= set(collected(before.select("doc_id", "text")))
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
