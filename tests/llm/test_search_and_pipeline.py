"""Nearest neighbours, and the stages of the pipeline one after the other."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from mapledger.llm import cross_polytope, quality
from tests.llm import cases


@pytest.mark.parametrize(("block", "stretch"), [(4096, 1.0), (16, 1.0), (64, 3.0)])
def test_nearest_finds_most_and_ranks_exactly(spark, monkeypatch, block, stretch):
    monkeypatch.setattr(cross_polytope, "BLOCK", block)
    rows = [(i, None if v is None else [x * (stretch if k % 3 == 0 else 1) if x is not None else None for x in v], n)
            for k, (i, v, n) in enumerate(cases.vectors(size=600))]
    found = {}
    for r in cross_polytope.nearest(cases.embeddings(spark, rows), F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and cases.usable(v)]
    hits = wanted = 0
    for i, q in good:
        if i % 20:
            continue
        best = {}
        for j, v in good:
            if j != i and len(v) == len(q):
                best[j] = max(best.get(j, -np.inf), float(np.ascontiguousarray(q * v).sum()))
        truth = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20]
        own = sorted(found.get(i, []))
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1)) and len(own) <= 20
        assert [(j, s) for _, j, s in own] == sorted(((j, s) for _, j, s in own), key=lambda x: (-x[1], x[0]))
        assert all(abs(best[j] - s) <= 1e-9 * max(1, abs(s)) for _, j, s in own if i != 0)
        hits += len({j for j, _ in truth} & {j for _, j, _ in own})
        wanted += len(truth)
    assert hits >= 0.9 * wanted


@pytest.mark.parametrize("same", [True, False])
def test_repeated_rows_are_one_candidate(spark, same):
    draw = np.random.default_rng(5)
    query = draw.standard_normal(32)
    near = [query + 0.01 * draw.standard_normal(32) for _ in range(25)]
    near = [v * np.linalg.norm(query) / np.linalg.norm(v) for v in near]
    copies = [near[0] if same else near[0] * (1 + 1e-9 * k) for k in range(50)]
    rows = [(0, query.tolist(), 0)] + [(k + 1, v.tolist(), 0) for k, v in enumerate(near)] + [(1, v.tolist(), 0) for v in copies]
    found = cross_polytope.nearest(cases.embeddings(spark, rows), F.col("vec_id") == 0).collect()
    best = {k + 1: float((query * v).sum()) for k, v in enumerate(near)}
    best[1] = max(float((query * v).sum()) for v in [near[0], *copies])
    truth = sorted(best, key=lambda i: (-best[i], i))[:20]
    assert len({r.vec_id for r in found}) == len(found) == 20
    assert len({r.vec_id for r in found} & set(truth)) >= 19


def test_nearest_of_nothing(spark):
    assert cross_polytope.nearest(cases.embeddings(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_stages_equal_plain_versions(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "PII", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    columns, held = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, held, sf).cache()
        before, after = held.collect(), out.collect()
        texts = {r.doc_id: r.text for r in before}
        if name == "quality classifier":
            scores = {r.doc_id: r.predicted for r in quality.scored(held, labels).collect()}
            assert {r.doc_id for r in after} == {i for i, p in scores.items() if p}
        elif name == "MinHash near-dedup":
            classes = cases.near_classes(sorted(texts.items()), 80)
            assert {r.doc_id for r in after} == {i for i, (_, c) in classes.items() if c == i}
        elif name == "PII":
            assert len(after) == len(before)
            for r in after:
                if cases.personal(texts[r.doc_id])[1]:
                    assert r.text != texts[r.doc_id] and "<" in r.text
        elif name.startswith("mixing"):
            clean = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
            lost = {r.doc_id for r in before} - {r.doc_id for r in after}
            assert len(lost & clean) <= 1
        if name.startswith("SentencePiece"):
            assert all(r.same and r.n_pieces == len(r.ids) for r in after) and len(after) == len(before)
        else:
            assert out.columns == columns
        held = out


def test_registered_once_each():
    names = [n for n in registered.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in registered.queries()


