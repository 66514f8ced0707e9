"""Prefix trie, BPE by pair index, and alignment against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mapledger.llm import alignment, pair_index, prefix_trie
from tests.llm import cases

PIECES = ("a", "b", " ", "  ", "\n", "'", "s", "ll", "re", "é", "中", "1", "٣", "_", "-", "▁", "😀", "<|endoftext|>", "the",
          " the", "Z", "\x00", "<s>", "<0x41>", "ﬁ", "\u0085", " ", "ǅ", "Å")


def odd_texts(seed=4, n=1500):
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 40))) for _ in range(n)]


# ---------------------------------------------------------------- trie

def conversations():
    """Shared beginnings, lent turns, copies, one deep conversation, nulls, ties, repeated rows, negative ids."""
    draw = random.Random(9)
    rows = []
    openings = [[("user", cases.prose(draw, 4)), ("assistant", cases.prose(draw, 5))] for _ in range(3)]
    for c in range(-45, 130):
        if c in (20, 41):
            continue
        own = list(draw.choice(openings)) if c % 3 else []
        own += [("user", draw.choice(["yes", "no", "go  on", ""])) for _ in range(draw.randint(0 if own else 1, 5))]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(own)]
    deep = [(200, t, "user", f"turn {t % 7}") for t in range(600)]
    rows += deep + [(203, t, r, x if t < 590 else "other") for _, t, r, x in deep]
    rows += [(c, t, "user", "same text") for c in range(300, 420) for t in range(2)]
    rows += [(500, None, None, None), (500, 0, "user", None), (500, 0, "user", "tie"), (500, 0, "bot", "tie"),
             (500, 0, "user", "tie"), (None, 0, "user", "x"), (61, 0, "user", "only")]
    return rows


def plain_trie(rows, rebuilt=True):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", hashlib.md5((x or "").encode()).digest(), x or ""))
    turns = {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        # The remainder has the sign of the id.
        leader = c - (abs(c) % 20 * (1 if c >= 0 else -1))
        paths[c] = turns.get(leader, [])[:h] + turns[c][h:] if rebuilt else turns[c]
    members = defaultdict(list)
    for c, p in sorted(paths.items()):
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    children, leaves, saved, ends = Counter(), Counter(), Counter(), defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * words
    for c, p in paths.items():
        ends[tuple(p)].append(c)
    return sorted((
        m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
        hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def as_table(spark, rows):
    kind = ("conv_id long, turn long, role string, text string, place long, node string, up long, position int, words long, "
            "digest string, h int, piece int, _piece int")
    return spark.createDataFrame([(*r, 1, "n", 2, 3, 4, "d", 5, 6, 7) for r in rows], kind)


@pytest.mark.parametrize("rebuilt", [True, False])
def test_trie_equals_plain_one(spark, monkeypatch, rebuilt):
    monkeypatch.setattr(prefix_trie, "SLICE", 7)
    rows = conversations()
    # The plain version holds every prefix, so deep conversations are cut for it.
    rows = [r for r in rows if r[0] not in (200, 203) or r[1] < 120]
    table = as_table(spark, rows).repartition(5)
    found = (prefix_trie.rebuilt_trie if rebuilt else prefix_trie.own_trie)(table)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_trie(rows, rebuilt), key=str)


def test_deep_conversations_take_few_levels(spark, monkeypatch):
    rows = [(c, t, "u", "w" if t < 550 else f"w{c}") for c in (1, 2) for t in range(600)]
    calls = []
    whole = prefix_trie.subtree_sums
    monkeypatch.setattr(prefix_trie, "subtree_sums", lambda *a: calls.append(1) or whole(*a))
    found = prefix_trie.own_trie(as_table(spark, rows)).orderBy("depth", "conv_id").collect()
    assert len(calls) == 4 and len(found) == 651
    assert [tuple(found[d])[:7] for d in (0, 1, 550)] == [
        (1, 0, None, 2, 1, 2, 550), (1, 1, 1, 2, 1, 2, 550), (1, 550, 1, 2, 2, 2, 1)]
    assert tuple(found[-1])[:7] == (2, 600, 2, 1, 0, 1, 0)


def test_trie_of_nothing(spark):
    assert prefix_trie.rebuilt_trie(as_table(spark, [])).collect() == []
    assert prefix_trie.rebuilt_trie(as_table(spark, [(None, 0, "user", "x")])).collect() == []
    # conversation 7 gives its only turn up, and its leader is absent
    lonely = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    row = prefix_trie.rebuilt_trie(as_table(spark, [(lonely, 0, "user", "x")])).collect()
    assert [tuple(r)[:7] for r in row] == [(lonely, 0, None, 1, 0, 1, 0)]
    assert row[0].ends_sha256 == hashlib.sha256(str(lonely).encode()).hexdigest()


def test_hot_parents_are_broadcast_and_others_joined(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HOT", 10)
    rows = [(c, t, "u", "a" if t == 0 else f"{c}") for c in range(100, 180) for t in range(2)]
    found = prefix_trie.own_trie(as_table(spark, rows)).collect()
    assert {(r.depth, r.parent_conv_id, r.n_children) for r in found} == {(0, None, 1), (1, 100, 80), (2, 100, 0)}


# ---------------------------------------------------------------- pair index

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(pair_index.default_path())


def test_encoding_and_decoding_equal_the_library(spark, library, monkeypatch):
    monkeypatch.setattr(pair_index, "BLOCK", 700)
    texts = odd_texts() + [t for _, t in cases.corpus()] + ["aaaa" * 300, "ab" * 2000, " " * 900, "x" + "\n" * 40 + "y"]
    rows = cases.documents(spark, list(enumerate(texts))).withColumn("ids", F.lit("mine"))
    found = {r.doc_id: r for r in pair_index.encoded(rows).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i].ids == ids
        assert found[i].decoded == library.decode(ids, skip_special_tokens=False) == (text or "")
    assert set(rows.columns) <= set(pair_index.encoded(rows).columns)


def test_special_strings_can_be_plain_text(spark, library):
    held = pair_index.Encoder(pair_index.vocabulary(pair_index.default_path()), specials=False)
    plain = Tokenizer.from_file(pair_index.default_path())
    plain.encode_special_tokens = True
    for text in ("<|endoftext|>", "a <|endoftext|> b"):
        assert held.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_every_assigned_character_has_the_librarys_class(library):
    draw = random.Random(3)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["x" + "".join(chr(draw.choice(points)) for _ in range(20)) for _ in range(2000)]
    ids, counts = pair_index.Encoder(pair_index.vocabulary(pair_index.default_path())).encode(texts)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for e in expected for i in e] and counts.tolist() == [len(e) for e in expected]


def test_remembered_words_are_bounded_and_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pair_index, "KNOWN", 4000)
    monkeypatch.setattr(pair_index, "BLOCK", 300)
    texts = [t or "" for _, t in cases.corpus()]
    held = pair_index.Encoder(pair_index.vocabulary(pair_index.default_path()))
    ids, _ = held.encode(texts)
    assert ids.tolist() == [i for e in library.encode_batch(texts, add_special_tokens=False) for i in e.ids]
    assert held.remembered.nbytes <= 4000


def test_digests_of_tokens(spark, library):
    rows = [*cases.corpus(), (None, None)]
    found = sorted(map(tuple, pair_index.digests(cases.documents(spark, rows)).collect()), key=str)
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)
    assert pair_index.digests(cases.documents(spark, [])).collect() == []


# ---------------------------------------------------------------- alignment

def plain_alignment(rows):
    first, second = alignment.default_paths()
    left = Tokenizer.from_file(first)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=second)
    letters = pair_index.byte_letters()
    docs = []
    for doc_id, text in rows:
        a, b, links, groups = [], [], [], []
        if text:
            a, b = left.encode(f" {text}", add_special_tokens=False).ids, right.encode(text)
            parts = [bytes(letters[c] for c in left.id_to_token(i)) for i in a]
            others = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i)
                      else right.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(parts) == b"".join(others) == f" {text}".encode():
                a, b = [], []
        if a:
            # the owner of every byte on both sides
            over_a = [k for k, p in enumerate(parts) for _ in p]
            over_b = [k for k, p in enumerate(others) for _ in p]
            links = [(a[x], b[y]) for x, y in sorted(set(zip(over_a, over_b, strict=True)))]
            ends_a, ends_b = set(np.cumsum([len(p) for p in parts])), set(np.cumsum([len(p) for p in others]))
            begin = 0
            for cut in sorted(ends_a & ends_b):
                span = range(begin, cut)
                groups.append((sorted({over_a[p] for p in span}), sorted({over_b[p] for p in span})))
                begin = cut
        docs.append((doc_id, a, b, groups, links))
    counts = Counter(p for d in docs for p in set(d[4]))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, a, b, groups, links in docs:
        line = ";".join(",".join(str(a[k]) for k in g) + "|" + ",".join(str(b[k]) for k in h) for g, h in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(line.encode()).hexdigest() if a else ""))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize(("block", "scope"), [(1 << 21, 1 << 25), (150, 2000)])
def test_alignment_equals_plain_one(spark, monkeypatch, block, scope):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "SCOPE", scope)
    rows = [*enumerate(odd_texts(n=600)), *cases.corpus(), (3, "the end"), (3, None), (None, "the end"), (None, "")]
    found = alignment.counted(cases.documents(spark, rows).repartition(3)).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain_alignment(rows), key=str)
    assert any(r[1] == 0 for r in found) and any(r[3] < min(r[1], r[2]) for r in found)


def test_alignment_of_nothing(spark):
    assert alignment.counted(cases.documents(spark, [])).collect() == []
    rows = alignment.counted(cases.documents(spark, [(1, None), (2, "")])).select(*COLUMNS).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_of_tokens(spark):
    rows = [(1, "tokenization of antidisestablishmentarianism"), (2, None), (3, "x y")]
    table = alignment.aligned(cases.documents(spark, rows))
    found = {r.doc_id: r for r in table.collect()}
    expected = {r[0]: r for r in plain_alignment(rows)}
    for doc_id, r in found.items():
        line = ";".join(
            ",".join(str(i) for i, x in zip(r.tokens_a, r.groups_a) if x == g) + "|"
            + ",".join(str(i) for i, x in zip(r.tokens_b, r.groups_b) if x == g) for g in sorted(set(r.groups_a)))
        assert (hashlib.sha256(line.encode()).hexdigest() if line else "") == expected[doc_id][-1]


def test_long_chains_are_followed_to_their_end():
    # ends that never meet but at the last place: one chain through all tokens
    a, b = np.append(np.arange(2, 2000, 2), 2001), np.append(np.arange(1, 2000, 2), 2001)
    left, right = alignment.components(a, b)
    assert not left.any() and not right.any()
    left, right = alignment.components(np.array([1, 3, 4]), np.array([1, 2, 4]))
    assert left.tolist() == [0, 1, 1] and right.tolist() == [0, 1, 1]
