"""Small tables with the awkward rows that every operator must take, and plain versions of what they compute."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np

_SYLLABLES = ("an", "the", "ti", "on", "er", "re", "st", "ou", "wh", "ha", "éa", "ñu", "ly", "ed")


def prose(draw, words):
    return " ".join("".join(draw.choice(_SYLLABLES) for _ in range(draw.randint(1, 4))) for _ in range(words))


def corpus(seed=5):
    """(doc_id, text) rows: copies, near copies, shared passages, nulls, blanks, repeated rows, one long text."""
    draw = random.Random(seed)
    base, passage = prose(draw, 120), prose(draw, 90)
    texts = [base, base, base.replace(" ", "  ", 3), base.upper()]
    words = base.split()
    for k in range(8):
        edited = list(words)
        edited[10 * k + 5] = "changed"
        texts.append(" ".join(edited))
    texts += [f"{prose(draw, 30)} {passage} {prose(draw, 40)}" for _ in range(6)]
    texts += [prose(draw, 60 + k) for k in range(20)]
    texts += [prose(draw, 3), "one two three", "ONE two\tthree", "", "   \n\t ", None, None, "word " * 300]
    texts.append(prose(draw, 4000) + " " + passage)
    rows = [(7 * i + 1, t) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[13], (None, base), (None, None)]


def documents(spark, rows=None):
    """The rows as a table with further columns whose names clash with those inside the operators."""
    kind = ("doc_id long, text string, lang string, source string, n_chars long, key string, grp long, rate double, "
            "tree string, posteriors string, band int, candidates string, t string, digits boolean, _kept int")
    full = [(i, t, "en", "src0", None if t is None else len(t), "k", 1, 0.5, "t", "p", 3, None, "t", True, 1)
            for i, t in (corpus() if rows is None else rows)]
    return spark.createDataFrame(full, kind)


class Union:
    """Plain union-find with least roots."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def unite(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]


def shingles(text, size=5):
    own = words(text)
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


def near_classes(rows, percent):
    """{doc_id: (set size, class)} over all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    union, ids = Union(sets), sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                union.unite(a, b)
    return {i: (len(sets[i]), union.root(i)) for i in sets}


def repeats(rows, least):
    """[(doc_id, bytes, removed, runs, digest)] by counting every window."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = defaultdict(int)
    for _, t in texts:
        for s in range(len(t) - least + 1):
            seen[t[s : s + least]] += 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - least + 1):
            if seen[t[s : s + least]] > 1:
                gone[s : s + least] = b"\1" * least
        runs = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    """Counts by kind, and the list of base spans."""
    def digits(m):
        return re.sub("[^0-9]", "", m)

    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    )
    counts, spans = [], []
    for kind, pattern, valid in rules:
        own = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if valid(m.group())]
        counts.append(len(own))
        spans += own
    return counts, spans


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def vectors(seed=3, size=400, width=64):
    """(vec_id, embedding, label) rows: random, near copies in a large group, copies, and unusable ones."""
    draw = np.random.default_rng(seed)
    rows = [v.tolist() for v in draw.standard_normal((size, width))]
    hub = draw.standard_normal(width)
    rows += [(hub + 0.18 * draw.standard_normal(width)).tolist() for _ in range(60)]
    rows += [rows[0], rows[1], [2 * x for x in rows[2]], [0.0] * width, None, [], [float("nan")] * width,
             [float("inf")] + [1.0] * (width - 1), [None] + [1.0] * (width - 1), [1.0, 2.0], [2.0, 4.0], [1e-200] * width]
    return [(5 * i, v, 0) for i, v in enumerate(rows)] + [(None, rows[0], 0), (0, rows[0], 0)]


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
