"""Byte-level BPE over an index of pair occurrences.

A block of a partition's texts is split into pre-tokens by arrays of character classes, and its distinct pre-tokens are
laid side by side. The index maps the rank of each adjacent pair to all places where that pair stands. Ranks are applied
in ascending order; one rank merges all its places, takes the neighbouring pairs out of their lists (a place whose pair
has changed since is passed over) and adds the new pairs to theirs. A pair made by a merge always has a later rank,
which `Vocabulary` checks, so one ascending pass settles the whole block. Encoded pre-tokens are remembered from block
to block in a worker, up to `KNOWN` bytes of them.

Blocks hold `BLOCK` characters; a longer text is cut before a run of white space, where pre-tokens always part. Memory
is bounded by a text and a block. Every row is encoded by itself, without an exchange.

Defined results: a null or empty text has no ids and decodes to an empty text. Strings of special tokens inside a text
become those tokens unless `specials` is false. Rows are encoded each for itself, repeated or not. A document column
named like one that is added (`ids`, `decoded`) gives way to it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers

from mapledger.llm.textbytes import mix, slice_hashes

BLOCK = 1 << 20
KNOWN = 1 << 25
LETTER, NUMBER, OTHER, WHITE = range(4)
#: Stands between pre-tokens; no pair holds it.
BORDER = 0xFFFF
SECOND = np.uint64(0xA0761D6478BD642F)


class Classes:
    """The class of each character as the tokenizers library's own expressions see it, by pages of 256."""

    def __init__(self) -> None:
        self._pages: dict[int, np.ndarray] = {}
        self._rules = [(kind, normalizers.Replace(Regex(pattern), "\0"))
                       for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s"))]

    def _page(self, page: int) -> np.ndarray:
        held = self._pages.get(page)
        if held is None:
            held = np.full(256, OTHER, np.uint8)
            if not 0xD8 <= page < 0xE0:
                text = "".join(map(chr, range(page << 8, (page + 1) << 8)))
                plain = np.arange(256) + (page << 8) != 0
                for kind, rule in self._rules:
                    seen = np.frombuffer(rule.normalize_str(text).encode("utf-32-le"), np.uint32)
                    held[(seen == 0) & plain] = kind
            self._pages[page] = held
        return held

    def of(self, points: np.ndarray) -> np.ndarray:
        pages, at = np.unique(points >> 8, return_inverse=True)
        return np.stack([self._page(int(p)) for p in pages])[at, points & 0xFF]


def pre_token_starts(points: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin: runs of letters, digits and other signs with a space before them, short English endings
    after an apostrophe, and white space, of which the last character parts from the rest. `first` marks where a text
    begins; what stands in different texts does not touch."""
    n = len(points)
    last = np.append(first[1:], True)
    turn = first.copy()
    turn[1:] |= kinds[1:] != kinds[:-1]
    starts = turn.copy()
    white = kinds == WHITE
    # The last white space of a run that something follows begins a pre-token of its own, and a space takes in
    # what follows.
    ends = np.flatnonzero(white[:-1] & ~white[1:] & ~last[:-1])
    starts[ends] = True
    starts[ends[points[ends] == 0x20] + 1] = False

    quotes = np.flatnonzero(starts & (points == 0x27) & ~last)
    after = points[quotes + 1]
    more = np.where(last[quotes + 1], 0, points[np.minimum(quotes + 2, n - 1)])
    size = np.where(np.isin(after, [ord(c) for c in "stmd"]), 1, 0)
    for pair in ("re", "ve", "ll"):
        size[(after == ord(pair[0])) & (more == ord(pair[1]))] = 2
    quotes, size = quotes[size > 0], size[size > 0]
    starts[quotes + 1] = False
    beyond = quotes + size + 1
    inside = (beyond < n) & ~last[quotes + size]
    starts[beyond[inside]] = True
    return starts


def byte_letters() -> dict[str, int]:
    """The printable sign that stands for each byte in byte-level vocabularies: visible Latin-1 signs stand for
    themselves, the other bytes, in order, for the signs from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """A byte-level vocabulary: bytes of each id, merges by rank, special tokens by their text."""

    path: str
    pieces: list[bytes] = field(init=False)
    specials: dict[str, int] = field(init=False)
    rank_of: dict[int, int] = field(init=False)
    merged: list[int] = field(init=False)
    byte_ids: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        with open(self.path, encoding="utf-8") as held:
            model = json.load(held)
        vocabulary, letters = model["model"]["vocab"], byte_letters()
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.pieces = [b""] * (1 + max([*vocabulary.values(), *self.specials.values()]))
        if len(self.pieces) > BORDER:
            raise ValueError("ids must be below 65535")
        for token, i in vocabulary.items():
            self.pieces[i] = bytes(letters[c] for c in token)
        for token, i in self.specials.items():
            self.pieces[i] = token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.merged = [vocabulary[left + right] for left, right in merges]
        self.rank_of, made = {}, {}
        for rank, (left, right) in enumerate(merges):
            if made.get(vocabulary[left], -1) >= rank or made.get(vocabulary[right], -1) >= rank:
                raise ValueError("a merge must come after the merges that make its parts")
            self.rank_of[vocabulary[left] << 16 | vocabulary[right]] = rank
            if self.merged[rank] in made:
                raise ValueError("two merges make one token")
            made[self.merged[rank]] = rank
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        pairs = np.full(65536, -1, np.int64)
        for a in range(256):
            for b in range(256):
                pairs[a << 8 | b] = self.rank_of.get(int(self.byte_ids[a]) << 16 | int(self.byte_ids[b]), -1)
        self._byte_pairs = pairs
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)
        self._flat = np.frombuffer(b"".join(self.pieces), np.uint8)
        self._at = np.cumsum(self.sizes) - self.sizes

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, one after the other."""
        return self._flat[spread(self._at[ids], self.sizes[ids])]

    def merge(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, given as slices of bytes, one after the other, and how many each has."""
        sizes = ends - starts
        places = spread(starts, sizes)
        # A border stands before each pre-token and after the last.
        borders = np.cumsum(sizes + 1) - sizes - 1
        total = int(sizes.sum()) + len(sizes) + 1
        ids = np.full(total, BORDER, np.int64)
        inner = np.ones(total, bool)
        inner[borders] = inner[-1] = False
        octets = data[places].astype(np.int64)
        ids[inner] = self.byte_ids[octets]
        now = np.full(total, -1, np.int64)
        at = np.flatnonzero(inner)
        if len(at) > 1:
            near = np.flatnonzero(at[1:] == at[:-1] + 1)
            now[at[near]] = self._byte_pairs[octets[near] << 8 | octets[near + 1]]
        # The index: places of each rank, in order.
        found = np.flatnonzero(now >= 0)
        order = found[np.argsort(now[found], kind="stable")]
        ranks, firsts = np.unique(now[order], return_index=True)
        index = dict(zip(ranks.tolist(), (p.tolist() for p in np.split(order, firsts[1:])), strict=True)) if len(ranks) else {}
        heap = ranks.tolist()
        heapify(heap)
        symbols, now = ids.tolist(), now.tolist()
        after, before = list(range(1, total + 1)), list(range(-1, total - 1))
        rank_of, gone = self.rank_of.get, []
        while heap:
            rank = heappop(heap)
            new = self.merged[rank]
            for place in sorted(index.pop(rank)):
                if now[place] != rank:
                    continue
                right = after[place]
                beyond, ahead = after[right], before[place]
                symbols[place] = new
                after[place], before[beyond] = beyond, place
                now[right] = -1
                gone.append(right)
                pair = now[place] = rank_of(new << 16 | symbols[beyond], -1)
                if pair >= 0:
                    if pair in index:
                        index[pair].append(place)
                    else:
                        index[pair] = [place]
                        heappush(heap, pair)
                pair = now[ahead] = rank_of(symbols[ahead] << 16 | new, -1)
                if pair >= 0:
                    if pair in index:
                        index[pair].append(ahead)
                    else:
                        index[pair] = [ahead]
                        heappush(heap, pair)
        inner[gone] = False
        kept = np.array(symbols, np.int64)
        counts = np.diff(np.append(np.cumsum(inner)[borders], int(inner.sum())))
        return kept[inner].astype(np.int32), counts


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of slices, one slice after the other."""
    total = int(sizes.sum())
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)


class Remembered:
    """Ids of slices of bytes that were encoded before, by two hashes, up to `KNOWN` bytes of them."""

    def __init__(self, encode: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> None:
        self._encode = encode
        self._forget()

    def _forget(self) -> None:
        self._keys, self._checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self._starts, self._counts, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    @property
    def nbytes(self) -> int:
        return self._ids.nbytes + 32 * len(self._keys)

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of slices, one slice after the other, and how many each has; equal slices are encoded once."""
        keys = slice_hashes(data, starts, ends)
        checks = slice_hashes(mix(data.astype(np.uint64) + SECOND), starts, ends)
        order = np.argsort(keys)
        new = np.ones(len(order), bool)
        new[1:] = (keys[order[1:]] != keys[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
        distinct = order[new]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        at = np.minimum(np.searchsorted(self._keys, keys[distinct]), max(len(self._keys) - 1, 0))
        known = np.zeros(len(distinct), bool)
        if len(self._keys):
            known = (self._keys[at] == keys[distinct]) & (self._checks[at] == checks[distinct])
        fresh = distinct[~known]
        ids, counts = self._encode(data, starts[fresh], ends[fresh])
        word_starts, word_counts = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        if known.any():
            word_starts[known], word_counts[known] = self._starts[at[known]], self._counts[at[known]]
        word_starts[~known] = len(self._ids) + np.cumsum(counts) - counts
        word_counts[~known] = counts
        store = np.concatenate((self._ids, ids))
        flat = store[spread(word_starts[which], word_counts[which])]
        if store.nbytes + 32 * (len(self._keys) + len(fresh)) > KNOWN:
            self._forget()
        else:
            held = [np.concatenate(p) for p in (
                (self._keys, keys[fresh]), (self._checks, checks[fresh]), (self._starts, word_starts[~known]), (self._counts, counts))]
            order = np.argsort(held[0], kind="stable")
            self._keys, self._checks, self._starts, self._counts = (h[order] for h in held)
            self._ids = store
        return flat, word_counts[which]


class Encoder:
    """Encodes texts block by block and remembers pre-tokens in between."""

    def __init__(self, vocabulary: Vocabulary, specials: bool = True) -> None:
        self.vocabulary = vocabulary
        self._classes = Classes()
        contents = sorted(vocabulary.specials, key=len, reverse=True) if specials else []
        self._special = re.compile("|".join(map(re.escape, contents))) if contents else None
        self.remembered = Remembered(vocabulary.merge)

    def _pieces(self, texts: list[str | None]) -> Iterator[tuple[int, str, int | None]]:
        """(text number, part of the text, id if the part is a special token)."""
        for number, text in enumerate(texts):
            at = 0
            for special in self._special.finditer(text or "") if self._special else ():
                yield from self._cut(number, text[at : special.start()])
                yield number, special.group(), self.vocabulary.specials[special.group()]
                at = special.end()
            yield from self._cut(number, (text or "")[at:])

    @staticmethod
    def _cut(number: int, text: str) -> Iterator[tuple[int, str, None]]:
        while len(text) > BLOCK:
            border = re.compile(r"(?<=\S)\s", re.ASCII).search(text, BLOCK // 2)
            if border is None:
                break
            yield number, text[: border.start()], None
            text = text[border.start() :]
        if text:
            yield number, text, None

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        ids, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        block: list[tuple[int, str]] = []
        held = 0

        def close() -> None:
            nonlocal block, held
            if block:
                got, sizes = self._block([part for _, part in block])
                ids.append(got)
                np.add.at(counts, [number for number, _ in block], sizes)
            block, held = [], 0

        for number, part, special in self._pieces(texts):
            if special is not None:
                close()
                ids.append(np.array([special], np.int32))
                counts[number] += 1
                continue
            if held and held + len(part) > BLOCK:
                close()
            block.append((number, part))
            held += len(part)
        close()
        return np.concatenate(ids), counts

    def _block(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(p) for p in parts], np.int64)
        first = np.zeros(len(points), bool)
        opening = np.cumsum(lengths) - lengths
        first[opening] = True
        starts = np.flatnonzero(pre_token_starts(points, self._classes.of(points), first))
        widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        offsets = np.concatenate(([0], np.cumsum(widths)))
        data = np.frombuffer("".join(parts).encode(), np.uint8)
        ids, counts = self.remembered.encode(data, offsets[starts], offsets[np.append(starts[1:], len(points))])
        upto = np.concatenate(([0], np.cumsum(counts)))
        word_at = np.searchsorted(starts, np.append(opening, len(points)))
        return ids, np.diff(upto[word_at])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement signs."""
        return self.vocabulary.bytes_of(ids).tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str, specials: bool = True) -> Encoder:
    """The encoder of a worker process; what it remembers is bounded, and tasks to come use it too."""
    return Encoder(vocabulary(path), specials)


def default_path() -> str:
    """The byte-level vocabulary among the installed public tokenizers; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(documents: DataFrame, path: str | None = None, specials: bool = True) -> DataFrame:
    """Add `ids`, the token ids of a document's whole text, and `decoded`, the text that these ids give."""
    path = path or default_path()

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = encoder(path, specials)
        for texts in batches:
            ids, counts = held.encode(texts.to_pylist())
            places = np.concatenate(([0], np.cumsum(counts)))
            decoded = [held.decode(ids[s:e]) for s, e in zip(places[:-1], places[1:], strict=True)]
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids)), pa.array(decoded, pa.string())],
                names=["ids", "decoded"])

    own = [F.col(f"`{c}`") for c in documents.columns if c not in ("ids", "decoded")]
    return documents.withColumn("_coded", coded("text")).select(*own, "_coded.ids", "_coded.decoded")


def digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return encoded(documents.select("doc_id", "text"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
