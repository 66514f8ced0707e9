"""Edit-aware token counting.

Every document keeps a segment tree over blocks of `LEAF` pre-tokens: a node holds the characters, tokens and
pre-tokens below it. An edit finds its leaf by descending the character sums, is re-encoded from a little before
its start (`CONTEXT` pre-tokens, because a run of white space is split by what follows it) until a pre-token ends
where, after the edit, an old leaf began. How a text splits from some place on depends only on what follows that
place, so from there everything is as before. The touched leaves become one, their neighbours' sums stay, and only
the sums above them are renewed.

Trees are small columns of bytes beside the texts (about a tenth of their size), so both building and editing are
narrow passes without an exchange. Edits are offsets into the text before all of them, in code points, end
exclusive; a document's edits may come in any order.

Defined results: a null text is empty and has an empty tree. Null edits are none. An edit whose offsets are null,
reversed or reach beyond the text raises an error, as do edits that overlap; two insertions at one place happen in
their given order. A null replacement deletes. Rows are counted each for itself.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 64
CONTEXT = 4
#: Pre-tokens whose counts a task remembers before it forgets all of them.
CACHE = 1 << 19


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as held:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in held if line.strip())}
        self._encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._split = regex.compile(pattern)
        self._known: dict[str, int] = {}

    def split(self, text: str, start: int = 0):
        """Pre-tokens from a place on, one by one."""
        return self._split.finditer(text, start)

    def count(self, piece: str) -> int:
        known = self._known.get(piece)
        if known is None:
            if len(self._known) >= CACHE:
                self._known.clear()
            known = self._known[piece] = len(self._encoding.encode_ordinary(piece))
        return known

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of each pre-token of a whole text."""
        pieces = self._split.findall(text)
        known, count = self._known.get, self.count
        tokens = [known(p) or count(p) for p in pieces]
        return np.fromiter(map(len, pieces), np.int64, len(pieces)), np.array(tokens, np.int64)


def _heap(leaves: np.ndarray) -> np.ndarray:
    """Leaves with all sums above them."""
    size = 1 << max(0, int(leaves.shape[1] - 1).bit_length())
    sums = np.zeros((3, 2 * size), np.int64)
    sums[:, size : size + leaves.shape[1]] = leaves
    level = size
    while level > 1:
        level //= 2
        sums[:, level : 2 * level] = sums[:, 2 * level : 4 * level : 2] + sums[:, 2 * level + 1 : 4 * level : 2]
    return sums


class Tree:
    """Sums over leaves in heap order: node i has the children 2i and 2i + 1, leaves are the second half.

    The rows of `sums` are characters, tokens and pre-tokens."""

    def __init__(self, sums: np.ndarray) -> None:
        self.sums = sums
        self.size = sums.shape[1] // 2

    @classmethod
    def over(cls, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        starts = np.arange(0, len(chars), LEAF)
        if not len(starts):
            return cls(np.zeros((3, 2), np.int64))
        return cls(_heap(np.stack((
            np.add.reduceat(chars, starts), np.add.reduceat(tokens, starts), np.minimum(LEAF, len(chars) - starts)))))

    @classmethod
    def read(cls, packed: bytes) -> Tree:
        return cls(np.frombuffer(packed, np.int32).reshape(3, -1).astype(np.int64))

    def packed(self) -> bytes:
        return self.sums.astype(np.int32).tobytes()

    @property
    def chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, row: int, place: int) -> tuple[int, int]:
        """The leaf that holds the place-th unit of a row of sums, and the characters before that leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if place >= self.sums[row, node]:
                place -= int(self.sums[row, node])
                before += int(self.sums[0, node])
                node += 1
        return node - self.size, before

    def units_before(self, row: int, leaf: int) -> int:
        """Sum of a row over the leaves before one."""
        node, total = leaf + self.size, 0
        while node > 1:
            if node % 2:
                total += int(self.sums[row, node - 1])
            node //= 2
        return total

    def replace(self, first: int, last: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """Put new pre-tokens in the place of leaves first..last, and renew the sums above.

        A few make one leaf, and the other touched ones become empty; many make leaves of the usual size, and the
        tree is laid out anew from its leaves."""
        if len(chars) > 4 * LEAF:
            new = Tree.over(chars, tokens).sums
            leaves = self.sums[:, self.size :]
            joined = np.concatenate((leaves[:, :first], new[:, new.shape[1] // 2 :], leaves[:, last + 1 :]), axis=1)
            self.sums = _heap(joined[:, joined[2] > 0])
            self.size = self.sums.shape[1] // 2
            return
        nodes = np.arange(first, last + 1) + self.size
        self.sums[:, nodes] = 0
        self.sums[:, nodes[0]] = chars.sum(), tokens.sum(), len(chars)
        while nodes[0] > 1:
            nodes = np.unique(nodes // 2)
            self.sums[:, nodes] = self.sums[:, 2 * nodes] + self.sums[:, 2 * nodes + 1]

    def edit(self, after: str, start: int, end: int, inserted: int, counter: Counter) -> int:
        """Follow one edit: characters start..end gave way to `inserted` new ones, and the text now is `after`.
        Returns the number of characters encoded again."""
        if not self.chars:
            self.sums = Tree.over(*counter.counts(after)).sums
            self.size = self.sums.shape[1] // 2
            return len(after)
        shift = inserted - (end - start)
        at_start, _ = self.leaf_at(0, min(max(start - 1, 0), self.chars - 1))
        context = max(0, self.units_before(2, at_start) - CONTEXT)
        # From the leaf whose first pre-token is at least CONTEXT before the leaf of the edit.
        first, begin = self.leaf_at(2, context)
        last, at = self.leaf_at(0, min(max(end, start), self.chars - 1))
        border = at + int(self.sums[0, last + self.size])
        chars, tokens, place = [], [], begin
        for match in counter.split(after, begin):
            while border + shift < place and last + 1 < self.size:
                last += 1
                border += int(self.sums[0, last + self.size])
            if place == border + shift and place >= start + inserted:
                break
            piece = match.group()
            chars.append(len(piece))
            tokens.append(counter.count(piece))
            place = match.end()
        else:
            last = self.size - 1
        self.replace(first, last, np.array(chars, np.int64), np.array(tokens, np.int64))
        return place - begin


@lru_cache(maxsize=4)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def default_ranks() -> tuple[str, str]:
    """Vocabulary file and pattern among the installed public tokenizers; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def with_trees(documents: DataFrame, ranks: tuple[str, str] | None = None) -> DataFrame:
    """Add `tree`, a document's packed segment tree, and `n_tokens`, the count at its root; own columns of these names
    give way."""
    path, pattern = ranks or default_ranks()

    @F.arrow_udf("struct<tree: binary, n_tokens: bigint>")
    def built(texts: pa.Array) -> pa.Array:
        held = counter(path, pattern)
        trees = [Tree.over(*held.counts(t or "")) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([t.packed() for t in trees], pa.binary()), pa.array([t.tokens for t in trees], pa.int64())],
            names=["tree", "n_tokens"])

    return documents.withColumn("_built", built("text")).select(
        *[F.col(f"`{c}`") for c in documents.columns if c not in ("tree", "n_tokens")], F.col("_built.tree").alias("tree"),
        F.col("_built.n_tokens").alias("n_tokens"))


def _applied(text: str, edits: list[dict], tree: Tree, held: Counter) -> tuple[str, int]:
    """Apply edits from the last to the first, so that offsets of those to come stay true."""
    order = sorted(range(len(edits)), key=lambda i: (edits[i]["start"], edits[i]["end"], i))
    left, encoded = len(text), 0
    for i in reversed(order):
        start, end, new = edits[i]["start"], edits[i]["end"], edits[i]["text"] or ""
        if start is None or end is None or not 0 <= start <= end <= left:
            raise ValueError("edits must lie within the text and must not overlap")
        text = text[:start] + new + text[end:]
        encoded += tree.edit(text, start, end, len(new), held)
        left = start
    return text, encoded


def with_edits(trees: DataFrame, edits: str = "edits", ranks: tuple[str, str] | None = None) -> DataFrame:
    """Replace `text`, `tree` and `n_tokens` by those after the edits of the row, and add `n_encoded`, the characters
    encoded again. `edits` names an array<struct<start, end, text>> column."""
    path, pattern = ranks or default_ranks()
    kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64()]

    @F.arrow_udf("struct<text: string, tree: binary, n_tokens: bigint, n_encoded: bigint>")
    def edited(texts: pa.Array, packed: pa.Array, lists: pa.Array) -> pa.Array:
        held, rows = counter(path, pattern), []
        for text, tree, own in zip(texts.to_pylist(), packed.to_pylist(), lists.to_pylist(), strict=True):
            grown = Tree.read(tree)
            after, encoded = _applied(text or "", own or [], grown, held)
            rows.append((after, grown.packed(), grown.tokens, encoded))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["text", "tree", "n_tokens", "n_encoded"])

    own = [F.col(f"`{c}`") for c in trees.columns if c not in ("text", "tree", "n_tokens")]
    return trees.withColumn("_edited", edited("text", "tree", edits)).select(
        *own, *[F.col(f"_edited.{c}").alias(c) for c in ("text", "tree", "n_tokens", "n_encoded")])


def revisions(text: str = "text") -> Column:
    """Edits of a text that follow from the text itself: a note before its middle third, every ninth part cut out of
    its second half, new last words. They stand for a revision of the corpus in the registered query."""
    n = f"coalesce(char_length({text}), 0)"
    return F.expr(f"""
      CASE WHEN {n} < 60 THEN array(named_struct('start', {n}, 'end', {n}, 'text', ' (short)'))
      ELSE array(
        named_struct('start', {n} div 3, 'end', {n} div 3, 'text', ' [revised] '),
        named_struct('start', {n} div 2, 'end', {n} div 2 + {n} div 18, 'text', cast(NULL AS string)),
        named_struct('start', {n} - 5, 'end', {n}, 'text', concat('  the end of ', {n}, ' characters.')))
      END""")


def recounted(documents: DataFrame, ranks: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_after, n_chars_after, n_encoded): counts before and after `revisions`."""
    trees = with_trees(documents.select("doc_id", "text"), ranks)
    before = trees.select("doc_id", "text", "tree", "n_tokens", F.col("n_tokens").alias("n_before"), revisions().alias("edits"))
    return with_edits(before, ranks=ranks).select(
        "doc_id", F.col("n_before").alias("n_tokens"), F.col("n_tokens").alias("n_after"),
        F.char_length("text").cast("long").alias("n_chars_after"), "n_encoded")
