"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers encode a text to tokens that cover the same bytes. Two tokens overlap where their byte ranges do.
Every token points to the farthest-right token that overlaps it: the other side's token over its last byte, if that one
ends later. Of two tokens that end together the first side's is the end of the chain. Doubling all pointers of a block
at once (`next = next[next]`) until none changes leaves each token at the last token of its component, and that token
labels the group. The rounds grow with the logarithm of the longest chain.

Links are all overlapping pairs. A pair of ids counts in how many documents it is linked. Each task keeps the distinct
pairs of a scope of about `SCOPE` bytes of text with their numbers of documents, and each document its links as numbers
into them. Only the scopes' distinct pairs are exchanged: to their pair, where they are summed, and back to their scope,
where the documents look them up. A frequent pair has one row in each scope, so no pair is hot, and a scope is bounded
by its bytes (or by one text). The highest count of each first id is broadcast: at most one row for an id of the
vocabulary.

Defined results: a text that is null or empty, or that one of the tokenizers changes (the joined bytes of its tokens are
not a space and the text), has no tokens, groups or links. Strings of special tokens are plain text. Repeated rows count
as documents of their own. Document columns named like those added give way to them.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapledger.llm import pair_index
from mapledger.llm.pair_index import spread
from mapledger.llm.steps import staged

#: Bytes of text that are aligned at once, and that share one list of pairs.
BLOCK = 1 << 20
SCOPE = 1 << 23


class Pieces:
    """The second tokenizer: ids of texts and the bytes of ids."""

    def __init__(self, path: str) -> None:
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, inner = [], re.compile("[^▁]▁")
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            if inner.search(piece):
                raise ValueError(f"a piece holds a space behind another sign: {piece}")
            pieces.append(bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode())
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self._flat = np.frombuffer(b"".join(pieces), np.uint8)
        self._at = np.cumsum(self.sizes) - self.sizes
        self._space = self._model.piece_to_id("▁")
        self.remembered = pair_index.Remembered(self._words)

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, which begin at places of joined bytes with a space each, and how many each has.

        No piece holds a space behind another sign (`Pieces` checks it), so a text parts before every run of spaces,
        and equal words are encoded once. The model adds a word's first space."""
        parts = data == 0x20
        parts[1:] &= data[:-1] != 0x20
        parts[starts] = True
        words = np.flatnonzero(parts)
        ids, counts = self.remembered.encode(data, words, np.append(words[1:], len(data)))
        upto = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(upto[np.searchsorted(words, np.append(starts, len(data)))])

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = data.tobytes()
        words = [whole[s + 1 : e].decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        # A lone space is the word that the model would leave empty.
        lists = [ids or [self._space] for ids in self._model.encode(words, num_threads=1)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum())), counts

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self._flat[spread(self._at[ids], self.sizes[ids])]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@dataclass
class Aligned:
    """Tokens of both sides of many texts, with groups numbered through all of them, and their links."""

    a: np.ndarray
    b: np.ndarray
    counts_a: np.ndarray
    counts_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def components(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of both sides, from the tokens' ends over the same bytes, by pointer jumping."""
    n = len(ends_a)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    over_a, over_b = _ended(ends_b)[ends_a - 1], _ended(ends_a)[ends_b - 1]
    ahead = np.concatenate((np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)), over_b))
    while True:
        further = ahead[ahead]
        if np.array_equal(further, ahead):
            break
        ahead = further
    last = ahead[:n] == np.arange(n)
    label = np.cumsum(last) - 1
    return label[ahead[:n]], label[ahead[n:]]


def _ended(ends: np.ndarray) -> np.ndarray:
    """How many tokens end at or before each place: the number of the token over the byte there."""
    marks = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
    marks[ends] = 1
    return np.cumsum(marks, dtype=np.int32)


def _same(octets: np.ndarray, sizes: np.ndarray, plain: list[bytes]) -> np.ndarray:
    """Which texts the joined bytes of their tokens give back."""
    ends = np.cumsum(sizes)
    return np.array([s == len(p) and octets[e - s : e].tobytes() == p for e, s, p in zip(ends, sizes, plain, strict=True)], bool)


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self._vocabulary = pair_index.vocabulary(path_a)
        self._encoder = pair_index.encoder(path_a, specials=False)
        self._pieces = pieces(path_b)

    def align(self, texts: list[str | None]) -> Aligned:
        used = [t for t in texts if t]
        plain = [b" " + t.encode() for t in used]
        joined = b"".join(plain)
        sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        data = np.frombuffer(joined, np.uint8)
        sides = []
        for ids, counts, table in ((*self._encoder.encode([f" {t}" for t in used]), self._vocabulary),
                                   (*self._pieces.encode(data, np.cumsum(sizes) - sizes), self._pieces)):
            upto = np.concatenate(([0], np.cumsum(table.sizes[ids])))
            place = np.concatenate(([0], np.cumsum(counts)))
            sides.append((ids, counts, _same(table.bytes_of(ids), np.diff(upto[place]), plain)))
        good = sides[0][2] & sides[1][2]
        ids, totals = [], []
        present = np.flatnonzero([bool(t) for t in texts])
        for side, counts, _ in sides:
            ids.append(side[np.repeat(good, counts)])
            total = np.zeros(len(texts), np.int64)
            total[present] = np.where(good, counts, 0)
            totals.append(total)
        ends_a, ends_b = np.cumsum(self._vocabulary.sizes[ids[0]]), np.cumsum(self._pieces.sizes[ids[1]])
        # Every stretch between two ends, of either side, is the overlap of one pair.
        cut = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, bool)
        cut[ends_a] = cut[ends_b] = True
        cuts = np.flatnonzero(cut) - 1
        return Aligned(*ids, *totals, *components(ends_a, ends_b), _ended(ends_a)[cuts], _ended(ends_b)[cuts])


def _blocks(texts: list[str | None], bound: int) -> Iterator[slice]:
    """Runs of texts of at most `bound` characters, or of one text."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and held + n > bound:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(texts):
        yield slice(start, len(texts))


@lru_cache(maxsize=1)
def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Six bytes for every id, its decimal digits before a place for a mark, and which of them count."""
    ids = np.arange(1 << 16)
    width = 1 + sum((ids >= 10**k).astype(np.int64) for k in (1, 2, 3, 4))
    digits = np.stack([ids // 10**k % 10 + 48 for k in (4, 3, 2, 1, 0)] + [0 * ids], axis=1).astype(np.uint8)
    return digits, np.arange(6) >= (5 - width)[:, None]


def _decimals(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id in decimal and its mark, as bytes one after the other, and the width of each."""
    digits, counts = _digits()
    rows, used = digits[ids], counts[ids]
    rows[:, 5] = marks
    return rows[used], used.sum(axis=1)


def group_lines(found: Aligned) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of every text: its groups in order, the ids of both sides in order."""
    side = np.concatenate((2 * found.group_a, 2 * found.group_b + 1))
    order = np.argsort(side, kind="stable")
    part = side[order]
    closes = np.append(part[1:] != part[:-1], True) if len(part) else np.zeros(0, bool)
    marks = np.where(closes, np.where(part % 2 == 0, ord("|"), ord(";")), ord(","))
    octets, widths = _decimals(np.concatenate((found.a, found.b))[order], marks)
    upto = np.concatenate(([0], np.cumsum(widths)))
    ends = upto[np.cumsum(found.counts_a + found.counts_b)]
    line = octets.tobytes()
    return [line[s : max(s, e - 1)] for s, e in zip(np.append(0, ends[:-1]), ends, strict=True)]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 byte place by byte place, so that the zeros of small ones stand together."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_COUNTED = ("n_a", "n_b", "n_groups", "n_links")
_PACKED = pa.schema([
    ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTED], ("groups_sha256", pa.string()), ("scope", pa.string()),
    ("links", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))])


class _Scope:
    """Documents that share one list of pairs."""

    def __init__(self) -> None:
        self.bytes = 0
        self._rows: list[list] = []
        self._blocks: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, ids: list, texts: list[str | None], aligner: Aligner) -> None:
        found = aligner.align(texts)
        self.bytes += sum(len(t) for t in texts if t)
        n = len(texts)
        doc_of = np.repeat(np.arange(n), found.counts_a)
        link_doc = doc_of[found.link_a]
        which, keys = pd.factorize(found.a[found.link_a].astype(np.int64) << 16 | found.b[found.link_b])
        order = np.argsort(keys)
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        keys, which = keys[order], place[which]
        size = max(len(keys), 1)
        own, times = np.unique(link_doc * size + which, return_counts=True)
        own_doc, own_pair = own // size, own % size
        self._blocks.append((keys, np.bincount(own_pair, minlength=len(keys))))
        first = np.append(True, doc_of[1:] != doc_of[:-1]) if len(doc_of) else np.zeros(0, bool)
        opens = first | np.append(True, found.group_a[1:] != found.group_a[:-1]) if len(doc_of) else first
        groups = np.bincount(doc_of[opens], minlength=n)
        links = np.bincount(link_doc, minlength=n)
        cut = np.searchsorted(own_doc, np.arange(n + 1))
        for i, line in enumerate(group_lines(found)):
            self._rows.append([
                ids[i], int(found.counts_a[i]), int(found.counts_b[i]), int(groups[i]), int(links[i]),
                hashlib.sha256(line).hexdigest() if line else "", own_pair[cut[i] : cut[i + 1]].astype(np.uint32),
                times[cut[i] : cut[i + 1]].astype(np.uint32), len(self._blocks) - 1])

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self._rows:
            return
        scope = uuid.uuid4().hex
        keys = np.unique(np.concatenate([k for k, _ in self._blocks]))
        places = [np.searchsorted(keys, k) for k, _ in self._blocks]
        held = np.zeros(len(keys), np.int64)
        for place, (_, n) in zip(places, self._blocks, strict=True):
            held[place] += n
        columns: list[list] = [[] for _ in _PACKED]
        for i, (*counts, digest, own, times, block) in enumerate(self._rows):
            steps = np.diff(places[block][own], prepend=0) if len(own) else own
            full = (*counts, digest, scope, _planes(steps), _planes(times), keys if i == 0 else None, held if i == 0 else None)
            for column, value in zip(columns, full, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACKED, strict=True)], schema=_PACKED)


def _looked_up(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over each document's links of a scope, whose pairs come with their counts."""
    order = np.argsort(pairs["pair"].to_numpy())
    counts, best = pairs["n_docs"].to_numpy()[order], pairs["is_best"].to_numpy()[order].astype(np.int64)
    n_best, count_sum = [], []
    for steps, times in zip(docs["links"].to_pylist(), docs["times"].to_pylist(), strict=True):
        own, n = np.cumsum(_from_planes(steps)), _from_planes(times)
        n_best.append(int(best[own] @ n) if len(own) else 0)
        count_sum.append(int(counts[own] @ n) if len(own) else 0)
    kept = docs.select(["doc_id", *_COUNTED, "groups_sha256"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def default_paths() -> tuple[str, str]:
    """The two vocabularies among the installed public tokenizers; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned(documents: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Add `tokens_a`, `groups_a`, `tokens_b`, `groups_b`: the ids of both sides, and the group of each, from 0 on."""
    path_a, path_b = paths or default_paths()
    names = ("tokens_a", "groups_a", "tokens_b", "groups_b")

    @F.arrow_udf("struct<tokens_a: array<int>, groups_a: array<int>, tokens_b: array<int>, groups_b: array<int>>")
    def grouped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            texts = batch.to_pylist()
            lists: list[list] = [[], [], [], []]
            for run in _blocks(texts, BLOCK):
                found = aligner.align(texts[run])
                at_a, at_b = np.cumsum(found.counts_a), np.cumsum(found.counts_b)
                for e, n, f, m in zip(at_a, found.counts_a, at_b, found.counts_b, strict=True):
                    base = found.group_a[e - n] if n else 0
                    for column, values in zip(lists, (found.a[e - n : e], found.group_a[e - n : e] - base,
                                                      found.b[f - m : f], found.group_b[f - m : f] - base), strict=True):
                        column.append(values)
            yield pa.StructArray.from_arrays([pa.array(c, pa.list_(pa.int32())) for c in lists], names=list(names))

    own = [F.col(f"`{c}`") for c in documents.columns if c not in names]
    return documents.withColumn("_grouped", grouped("text")).select(*own, *[F.col(f"_grouped.{c}") for c in names])


def counted(documents: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    path_a, path_b = paths or default_paths()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, scope = Aligner(path_a, path_b), _Scope()
        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            for run in _blocks(texts, BLOCK):
                scope.add(ids[run], texts[run], aligner)
                if scope.bytes >= SCOPE:
                    yield from scope.rows()
                    scope = _Scope()
        yield from scope.rows()

    counted = ", ".join(f"{c} long" for c in _COUNTED)
    docs = staged(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        packed, f"doc_id long, {counted}, groups_sha256 string, scope string, links binary, times binary, "
                "pairs array<long>, held array<long>"), "aligned")
    own = docs.where("pairs IS NOT NULL").select("scope", F.inline(F.arrays_zip("pairs", "held"))).select(
        "scope", F.col("pairs").alias("pair"), "held")
    pairs = staged(own.select("scope", "pair", F.sum("held").over(Window.partitionBy("pair")).alias("n_docs")), "pairs")
    # At most one row for each id of the first vocabulary.
    best = pairs.groupBy(F.expr("pair div 65536").alias("first")).agg(F.max("n_docs").alias("highest"))
    judged = pairs.join(F.broadcast(best), F.expr("pair div 65536") == F.col("first")).select(
        "scope", "pair", "n_docs", (F.col("n_docs") == F.col("highest")).alias("is_best"))
    return docs.drop("pairs", "held").groupBy("scope").cogroup(judged.groupBy("scope")).applyInArrow(
        _looked_up, f"doc_id long, {counted}, groups_sha256 string, n_best long, count_sum long")
