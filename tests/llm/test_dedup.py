"""Deduplication operators against plain versions."""

import hypothesis.strategies as st
import numpy as np
import pytest
from hypothesis import given, settings

from mapledger.llm import chains, minmax, repeats, rotation_codes
from mapledger.llm.steps import connected
from tests.llm import cases


def test_connected_takes_paths_stars_and_rings(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 20)] + [(300, 301), (301, 302), (302, 300)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(found[i] == 1 for i in range(1, 41)) and all(found[100 + i] == 100 for i in range(20))
    assert found[302] == 300
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("percent", "block", "bucket"), [(85, 1024, 4096), (80, 3, 2), (50, 2, 4096)])
def test_minmax_classes(spark, monkeypatch, percent, block, bucket):
    monkeypatch.setattr(minmax, "BLOCK", block)
    monkeypatch.setattr(minmax, "BUCKET", bucket)
    rows = cases.corpus()
    expected = cases.near_classes(rows, percent)
    for r in minmax.classes(cases.documents(spark), percent).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id] and r.kept == (r.component_id == r.doc_id)


def test_minmax_one_of_each(spark):
    docs = cases.documents(spark)
    left = minmax.one_of_each(docs, 80)
    expected = cases.near_classes(cases.corpus(), 80)
    ids = [r.doc_id for r in left.collect()]
    assert left.columns == docs.columns
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in expected.items() if i == c)
    assert ids.count(None) == 2
    assert minmax.one_of_each(cases.documents(spark, []), 80).count() == 0


def test_minmax_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**63, 1200).astype(np.uint64)
    a, b = minmax.signature(np.sort(pool[:1000])), minmax.signature(np.sort(pool[200:]))
    assert abs((a == b).mean() - 800 / 1200) < 0.2


@pytest.mark.parametrize(("least", "group"), [(400, 2000), (60, 2000), (60, 3), (60, 1)])
def test_repeats(spark, monkeypatch, least, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = cases.corpus()
    found = [tuple(r)[:5] for r in repeats.without_repeats(cases.documents(spark), least).collect()]
    def order(r):
        return r[0] is not None, r[0] or 0, r[1:]
    assert sorted(found, key=order) == sorted(cases.repeats(rows, least), key=order)


def test_repeats_of_nothing(spark):
    assert repeats.without_repeats(cases.documents(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=12, max_size=30), min_size=2, max_size=6, unique=True), st.integers(8, 11))
def test_covered_spans_equal_all_pairs(parts, least):
    core = b"XYZX"
    texts = [p[: len(p) // 2].encode() + core + p[len(p) // 2 :].encode() for p in parts]
    lefts = [t.index(core) for t in texts]
    for t, at, spans in zip(texts, lefts, repeats.covered(texts, lefts, least), strict=True):
        through, anywhere = set(), set()
        for s in range(len(t) - least + 1):
            if any(t[s : s + least] in o for o in texts if o != t):
                anywhere |= set(range(s, s + least))
                if s <= at and at + len(core) <= s + least:
                    through |= set(range(s, s + least))
        found = {i for a, b in spans for i in range(a, b)}
        assert through <= found <= anywhere


def test_intervals_are_the_common_prefix_tree():
    tree = set(repeats.intervals([1, 3, 3, 0, 2]))
    assert tree == {(1, 3, 3), (0, 3, 1), (4, 5, 2), (0, 5, 0)}


@pytest.mark.parametrize("block", [2048, 7])
def test_rotation_codes(spark, monkeypatch, block):
    monkeypatch.setattr(rotation_codes, "BLOCK", block)
    rows = cases.vectors()
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and cases.usable(v)]
    links, union = {}, cases.Union({i for i, _, _ in rows if i is not None})
    for x, (i, a) in enumerate(good):
        n = 0
        for y, (j, b) in enumerate(good):
            ua, ub = a / np.abs(a).max(), b / np.abs(b).max()
            if x != y and len(a) == len(b) and ua @ ub / np.linalg.norm(ua) / np.linalg.norm(ub) >= 0.9:
                n += 1
                union.unite(i, j)
        links[i] = n
    for r in rotation_codes.classes(cases.embeddings(spark, rows)).collect():
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            root = union.root(r.vec_id)
            assert (r.n_links, r.component_id, r.kept) == (links.get(r.vec_id, 0), root, r.vec_id == root)


def test_rotation_codes_of_nothing(spark):
    assert rotation_codes.classes(cases.embeddings(spark, [])).count() == 0
    assert rotation_codes.classes(cases.embeddings(spark, [(1, None, 0)])).first().n_links == 0


def test_code_estimates_are_unbiased():
    draw = np.random.default_rng(2)
    a, b = draw.standard_normal((2, 64))
    a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
    found = []
    for r in range(60):
        x, y = a @ rotation_codes.rotation(64, r), b @ rotation_codes.rotation(64, r)
        code = np.sign(x) / 8
        found.append(code @ y / (code @ x))
    assert abs(np.mean(found) - a @ b) < 0.06


@pytest.mark.parametrize("group", [4096, 2])
def test_chains_find_shared_passages(spark, monkeypatch, group):
    monkeypatch.setattr(chains, "GROUP", group)
    rows = [(i, t) for i, t in cases.corpus() if i is not None]
    text = dict(rows)
    covered = {}
    for r in chains.passages(cases.documents(spark)).collect():
        own, other = cases.words(text[r.doc_a])[r.start_a : r.end_a], cases.words(text[r.doc_b])[r.start_b : r.end_b]
        assert min(len(own), len(other)) >= chains.LEAST and r.n_matched >= chains.ALIKE * max(len(own), len(other))
        assert r.n_edits or own == other
        assert r.n_edits >= abs(len(own) - len(other))
        for d, s, e in ((r.doc_a, r.start_a, r.end_a), (r.doc_b, r.start_b, r.end_b)):
            covered.setdefault(d, []).append((s, e))
    least = chains.LEAST
    places = {}
    for i, t in text.items():
        w = cases.words(t)
        for k in range(len(w) - least + 1):
            places.setdefault(tuple(w[k : k + least]), set()).add((i, t))
    for i, t in text.items():
        w = cases.words(t)
        if len(set(w)) < 10:
            continue
        for k in range(len(w) - least + 1):
            if len({i for i, _ in places[tuple(w[k : k + least])]}) > 1:
                assert any(s <= k and k + least <= e for s, e in covered.get(i, ())), (i, k)


def test_chains_of_nothing(spark):
    assert chains.passages(cases.documents(spark, [])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=9, unique=True))
def test_best_chain_equals_all_subsets(matches):
    def worth(chain):
        total = chains.WORTH
        for p, q in zip(chain, chain[1:], strict=False):
            if not (p[0] < q[0] and p[1] < q[1]):
                return -1
            total += chains.WORTH - chains.GAP * (q[0] - p[0] + q[1] - p[1])
        return total

    ordered = sorted(matches)
    best = max(worth([m for i, m in enumerate(ordered) if mask >> i & 1]) for mask in range(1, 1 << len(ordered)))
    found = chains.chained(matches)
    assert abs(worth([matches[i] for i in found[0]]) - best) < 1e-9
    assert sorted(i for c in found for i in c) == list(range(len(matches)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
def test_edits_between_seeds(x, y):
    def plain(a, b):
        if not a or not b:
            return len(a) + len(b)
        return min(plain(a[1:], b) + 1, plain(a, b[1:]) + 1, plain(a[1:], b[1:]) + (a[0] != b[0]))

    x, y = x[:6], y[:6]
    assert chains.edit_distance(x, y) == plain(x, y)
    assert chains.between(x, y)[1] >= plain(x, y)
