"""Classifiers, personal data, encodings, counts and mixing against plain versions."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from mapledger.llm import count_trees, mixing, piece_transducer, private, quality, textbytes
from tests.llm import cases

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def labelled(spark, size=400):
    """Plain prose against shouting and repeated words; a toxic word marks some."""
    draw = random.Random(9)
    docs, labels = [], []
    for i in range(size):
        text = cases.prose(draw, draw.randint(20, 80))
        kind = i % 8
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if kind == 1:
            text = " ".join(w for w in text.split()[:4] for _ in range(15))
        if kind == 2:
            text += " worthless clown " + cases.prose(draw, 5)
        docs.append((i, text))
        if i % 2 == 0 or kind < 3:
            labels.append((i, 0 if kind < 2 else 1, int(kind == 2)))
    labels += [(None, 1, 0), (3, None, None), (size + 5, 1, 1), labels[0]]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_scores_held_out_rows(spark):
    docs, labels = labelled(spark)
    found = {r.doc_id: r for r in quality.scored(cases.documents(spark, docs + [(9001, None), (9002, ""), (None, "x")]), labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.where("quality is not null and doc_id is not null").collect()}
    held = [i for i in truth if i in found and found[i].held_out]
    assert len(held) > 20 and np.mean([found[i].predicted == truth[i] for i in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found.values())
    assert found[9001].score == found[9002].score and not found[None].held_out


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = cases.documents(spark)
    assert {r.score for r in quality.scored(docs, labels).collect()} == {0.5}
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.scored(cases.documents(spark, []), labels).count() == 0


def test_quality_never_learns_from_held_out_rows(spark):
    _, labels = labelled(spark)
    taught = {r.doc_id for r in quality.labelled_quality(labels).collect()}
    import zlib
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in taught if i is not None)


PERSONAL = [
    (1, "a@b.c_x@y.z 1.2.3 4.5.6.7 00001.2.3.4 1.2.3.4.5 +1(2)3 45-678 +1 4111 1111 1111 1111"),
    (2, "é@a.b x@y.z-- 4111-1111-1111-1111 4111 1111 1111 1112 256.1.1.1 1.1.1.1 🎉 +49 (30) 1234-567"),
    (3, 'call (988) 555-2485; password=b7db7aa4a5fcc78305 token = "1eb9c654e721b4f812088970e66a6345cee33dd6"'),
    (4, "1" * 20000 + " a@" + "b" * 20000 + " c@d." + "e" * 100), (5, "an ordinary covid-19-related-sentence in prose"),
    (6, None), (7, ""), (1, "repeated id me@here.org"), (None, "10.0.0.1 and 10.0.0.1"), (8, "@ + . a@ @b +1 +12"),
]


def test_private_base_spans(spark):
    found = private.found(cases.documents(spark, PERSONAL)).collect()
    assert len(found) == len(PERSONAL)
    expected = sorted((str(i), *counts, hashlib.sha256(",".join(spans).encode()).hexdigest())
                      for i, t in PERSONAL for counts, spans in [cases.personal(t)])
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found) == expected
    for r in found:
        text = [t for i, t in PERSONAL if i == r.doc_id]
        listed = [s for s in r.spans.split(",") if s]
        assert any(set(cases.personal(t)[1]) <= set(listed) for t in text)
        order = [(private.KINDS.index(k), int(s)) for k, s, _ in (x.split(":") for x in listed)]
        assert order == sorted(order)


def test_private_adds_keys_and_leaves_prose(spark):
    rows = {r.doc_id: r.spans for r in private.found(cases.documents(spark, PERSONAL)).collect()}
    assert rows[3].count("secret:") == 2 and rows[5] == ""


def test_private_redacts_every_span(spark):
    docs = cases.documents(spark, PERSONAL)
    out = private.redacted(docs)
    assert out.columns == docs.columns and out.count() == len(PERSONAL)
    texts = {r.doc_id: r for r in out.where("doc_id in (2, 3, 5, 6)").collect()}
    assert texts[2].text.startswith("é@a.b <EMAIL> 4111") and "<IP>" in texts[2].text and texts[2].text.endswith("<PHONE>")
    assert "b7db7aa4" not in texts[3].text and texts[5].text == PERSONAL[4][1] and texts[6].text is None
    assert texts[2].n_chars == len(texts[2].text)
    assert private.redacted(cases.documents(spark, [])).count() == 0


def test_private_uses_no_python(spark):
    plan = private.found(cases.documents(spark, PERSONAL))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pieces_equal_the_library(spark):
    known = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    machine = piece_transducer.transducer(MODEL)
    draw = random.Random(4)
    letters = " abcdeéñüß日本🎉\n\t\0.,!?0123456789-=THE"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        assert machine.encode(text) == known.encode(text) and machine.decode(machine.encode(text)) == text
    for n in range(1, 70):
        assert machine.encode(" " * n) == known.encode(" " * n) and machine.encode("a" * n) == known.encode("a" * n)


def test_lightest_path_of_a_unigram_model():
    machine = piece_transducer.transducer(MODEL)
    scores = {"a": -1.0, "b": -1.5, "ab": -2.0, "aba": -4.4, "c": -9.0}
    model = type("M", (), {"merges": False, "scores": scores, "ids": {}, "bytes": {}, "unknown": 0})()
    small = piece_transducer.Transducer(model)
    assert small.path("abab") == ["ab", "ab"] and small.path("aba") == ["ab", "a"] and small.path("xab") == ["x", "ab"]
    assert machine.model.merges


def test_piece_round_trip_table(spark):
    rows = cases.corpus()
    found = piece_transducer.round_trip(cases.documents(spark, rows)).collect()
    known = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    def digest(t):
        ids = known.encode(t or "")
        return len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
    assert sorted((str(r.doc_id), r.n_pieces, r.ids_sha256) for r in found) == sorted((str(i), *digest(t)) for i, t in rows)
    assert all(r.same for r in found)
    assert piece_transducer.encoded_documents(cases.documents(spark, [])).count() == 0


@pytest.mark.parametrize("leaf", [2, 3, 64])
def test_count_trees_follow_edits(monkeypatch, leaf):
    monkeypatch.setattr(count_trees, "LEAF", leaf)
    counter = count_trees.counter(*count_trees.default_ranks())
    draw = random.Random(leaf)
    parts = ["a", "the ", " ", "  ", "\n", "'", "s", "'ll ", "12", ",", "é", "🎉", "\t", "Word", "\n\n"]
    full = counter._encoding.encode_ordinary
    for _ in range(500):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 120)))
        tree = count_trees.Tree.over(*counter.counts(text))
        assert tree.tokens == len(full(text))
        for _ in range(4):
            a = draw.randint(0, len(text))
            b = min(len(text), a + draw.choice((0, 0, 1, 5, 60)))
            new = "".join(draw.choice(parts) for _ in range(draw.choice((0, 1, 3, 80))))
            text = text[:a] + new + text[b:]
            tree.edit(text, a, b, len(new), counter)
            assert (tree.tokens, tree.chars) == (len(full(text)), len(text))
            tree = count_trees.Tree.read(tree.packed())


def test_count_trees_encode_only_touched_regions():
    counter = count_trees.counter(*count_trees.default_ranks())
    text = cases.prose(random.Random(1), 20000)
    tree = count_trees.Tree.over(*counter.counts(text))
    after = text[:60000] + "zzz" + text[60000:]
    assert tree.edit(after, 60000, 60000, 3, counter) < 3000


def test_recounted_table(spark):
    counter = count_trees.counter(*count_trees.default_ranks())
    full = counter._encoding.encode_ordinary
    rows = cases.corpus()
    docs = cases.documents(spark, rows)
    edits = {str((r.doc_id, r.text)): r.edits for r in docs.withColumn("edits", count_trees.revisions()).collect()}
    expected = []
    for i, t in rows:
        text = t or ""
        for e in sorted(edits[str((i, t))], key=lambda e: -e.start):
            text = text[: e.start] + (e.text or "") + text[e.end :]
        expected.append((str(i), len(full(t or "")), len(full(text)), len(text)))
    found = count_trees.recounted(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_after, r.n_chars_after) for r in found) == sorted(expected)


def test_edits_out_of_range_are_refused(spark):
    trees = count_trees.with_trees(spark.createDataFrame([(1, "short text")], "doc_id long, text string"))
    wrong = trees.withColumn("edits", F.expr("array(named_struct('start', 5, 'end', 99, 'text', 'x'))"))
    with pytest.raises(Exception, match="within the text"):
        count_trees.with_edits(wrong).collect()


def test_mixing_meets_targets(spark):
    docs, labels = labelled(spark)
    rows = mixing.mixed(cases.documents(spark, docs + [(9001, None), (9002, " ")]), labels).collect()
    shares = np.array([[r.p_clean, r.p_toxic, r.p_poor] for r in rows])
    tokens, rates = np.array([r.tokens for r in rows]), np.array([r.rate for r in rows])
    assert np.allclose(shares.sum(axis=1), 1) and (rates >= 0).all()
    total = (shares * (tokens * rates)[:, None]).sum(axis=0)
    assert np.allclose(total / tokens.sum(), mixing.TARGETS, atol=5e-3)
    assert all(r.rate == 1 and r.tokens == 0 for r in rows if r.doc_id in (9001, 9002))


def test_mixing_steps_equal_plain_projected_gradient(spark):
    draw = np.random.default_rng(6)
    shares = draw.dirichlet((0.4, 0.3, 0.3), 50)
    tokens = draw.integers(1, 400, 50)
    members = spark.createDataFrame(
        [(i, int(t), p.tolist()) for i, (t, p) in enumerate(zip(tokens, shares, strict=True))], "doc_id int, tokens long, posteriors array<double>")
    history = mixing.fitted_steps(members, (0.5, 0.3, 0.2), steps=60)
    found = np.array([r.rate for r in mixing.with_rates(members, history).orderBy("doc_id").collect()])
    weighted = shares * tokens[:, None]
    gram = shares.T @ weighted
    wanted = np.array((0.5, 0.3, 0.2)) * tokens.sum()
    rate = np.ones(50)
    for _ in range(6000):
        step = shares @ np.linalg.solve(gram, rate @ weighted - wanted) + mixing.PULL * (rate - 1)
        rate = np.maximum(0, rate - 0.9 * step)
    assert np.abs(found - rate).max() < 0.02


def test_thinned_mixture_has_its_shares(spark):
    draw = np.random.default_rng(8)
    domain = draw.choice(3, 3000, p=(0.8, 0.12, 0.08))
    logits = draw.normal(0, 1.5, (3000, 3))
    logits[np.arange(3000), domain] += 12
    shares = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    tokens = draw.integers(20, 400, 3000)
    members = spark.createDataFrame(
        [(i, int(t), p.tolist()) for i, (t, p) in enumerate(zip(tokens, shares, strict=True))], "doc_id int, tokens long, posteriors array<double>")
    history = mixing.thinned_steps(members, mixing.TARGETS)
    rates = np.array([r.rate for r in mixing.with_rates(members, history, 1.0).orderBy("doc_id").collect()])
    total = (shares * (tokens * rates)[:, None]).sum(axis=0)
    assert np.abs(total / total.sum() - mixing.TARGETS).max() < 1e-3
    assert rates[domain == 0].mean() > 0.995


def test_drawn_mixture_has_its_shares(spark):
    draw = np.random.default_rng(9)
    domain = draw.choice(3, 2500, p=(0.8, 0.12, 0.08))
    texts = [(i, " ".join(f"{'cfp'[d]}{w}" for w in draw.integers(0, 40, 30))) for i, d in enumerate(domain.tolist())]
    labels = spark.createDataFrame(
        [(i, int(d != 2), int(d == 1)) for i, d in enumerate(domain.tolist())], "doc_id long, quality int, toxic int")
    counts = np.bincount([domain[r.doc_id] for r in mixing.drawn(cases.documents(spark, texts), labels).collect()], minlength=3)
    wanted = np.array(mixing.TARGETS) / mixing.TARGETS[0] * counts[0]
    # Each is drawn by chance: three standard deviations.
    assert counts[0] >= 0.99 * np.count_nonzero(domain == 0)
    assert (np.abs(counts - wanted)[1:] <= 3 * np.sqrt(wanted[1:])).all()


def test_drawn_keeps_clean_documents(spark):
    docs, labels = labelled(spark)
    table = cases.documents(spark, docs)
    kept = mixing.drawn(table, labels)
    ids = {r.doc_id for r in kept.collect()}
    clean = {i for i, _ in docs if i % 8 > 2}
    toxic = {i for i, _ in docs if i % 8 == 2}
    assert kept.columns == table.columns and len(clean - ids) <= 0.03 * len(clean) and len(toxic - ids) > len(toxic) // 3
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.drawn(cases.documents(spark, []), empty).count() == 0


def test_words_and_hashes_of_bytes():
    data = np.frombuffer("Été  THE\tthe\n x".encode(), np.uint8)
    hashes = textbytes.word_hashes(data)
    assert len(hashes) == 4 and hashes[1] == hashes[2] and len(set(hashes.tolist())) == 3
    keys = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    least = textbytes.sliding_least(keys, 37)
    assert [int(x) for x in least] == [int(keys[i : i + 37].min()) for i in range(464)]
