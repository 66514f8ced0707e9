"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file and composed with each input:
* the normaliser maps a space to the piece mark and puts one mark in front;
* the lexicon is a trie of pieces; reading a piece's characters ends in an arc that writes its id;
* byte fallback reads one character that no piece spells and writes its bytes' ids, at a high weight.

For a unigram model an arc weighs minus the piece's log probability, and the tropical shortest path through the
composition is the encoding. A merge model has no such weights: its scores order merges. There the lexicon is
composed with one more machine that only lets adjacent pieces pass if merging their joint text would not join
across or move the border between them. Exactly one path stays (a sequence is what merging yields if and only if
each adjacent pair is what merging yields), so the shortest path equals the merge result; every arc then weighs
one.

No piece spells a mark behind another character, so a normalised text falls apart at each mark that starts a
word, and words are composed and cached one by one; runs of marks stay whole.

Defined results: null encodes like the empty text, to no pieces. Decoding gives back the text exactly for every
text of valid UTF-8 that does not hold the mark character itself, which reads as a space. Repeated rows are
encoded each for itself; other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words and borders of which a worker remembers this many newest ones, and up to as many before them.
CACHE = 1 << 18
_FALLBACK = 1e6
_AHEAD = 8
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Model:
    """Pieces of a model file: ids, scores, byte ids, and whether scores order merges."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        read = proto.ModelProto()
        with open(path, "rb") as held:
            read.ParseFromString(held.read())
        rules = read.normalizer_spec
        if rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces:
            raise ValueError("only models that keep texts as they are, behind one added space, can be compiled")
        self.merges = read.trainer_spec.model_type == proto.TrainerSpec.BPE
        self.pieces = [p.piece for p in read.pieces]
        self.scores = {p.piece: p.score for p in read.pieces if p.type == p.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(read.pieces) if p.type == p.NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(read.pieces) if p.type == p.BYTE}
        self.unknown = next(i for i, p in enumerate(read.pieces) if p.type == p.UNKNOWN)
        self.spelled = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == p.BYTE else p.piece.encode() if p.type == p.NORMAL else b""
            for p in read.pieces]


class Transducer:
    """The compiled machines and their composition with words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._apart: dict[tuple[str, str], bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._read: dict[str, tuple] = {}
        #: Neighbours inside some piece; between other characters no piece reaches across.
        self._inside = {p[i : i + 2] for p in model.scores for i in range(len(p) - 1)}
        #: The lexicon: a node is a dict from character to (piece or None, its weight, next node).
        self.root: dict = {}
        for piece, score in model.scores.items():
            if not model.merges or self._merged(piece) == [piece]:
                node = self.root
                for c in piece[:-1]:
                    node = node.setdefault(c, [None, 0.0, {}])[2]
                node.setdefault(piece[-1], [None, 0.0, {}])[:2] = [piece, 1.0 if model.merges else -score]

    def _merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best pair first, the leftmost of equals."""
        parts, scores = list(text), self.model.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _passes(self, left: str, right: str) -> bool:
        """The border machine: these two may stand side by side."""
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) >= CACHE:
                self._apart.clear()
            known = self._apart[left, right] = self._merged(left + right) == [left, right]
        return known

    def _arcs(self, word: str, at: int) -> tuple[tuple[str, float], ...]:
        """Pieces that the lexicon reads from a position, longest first; a character without one falls back.

        Most readings end within a few characters, and are remembered by those."""
        ahead = word[at : at + _AHEAD]
        known = self._read.get(ahead)
        if known is not None:
            return known
        node, end, arcs = self.root, at, []
        while end < len(word) and (step := node.get(word[end])) is not None:
            end += 1
            if step[0] is not None:
                arcs.append((step[0], step[1]))
            node = step[2]
        if not arcs or len(arcs[0][0]) != 1:
            arcs.insert(0, (word[at], _FALLBACK))
        found = tuple(reversed(arcs))
        if end - at < _AHEAD:
            if len(self._read) >= CACHE // 4:
                self._read.clear()
            self._read[ahead] = found
        return found

    def path(self, word: str) -> list[str]:
        """The shortest path of the composition with one word: pieces, and characters left to byte fallback."""
        return self._only_path(word) if self.model.merges else self._lightest_path(word)

    def _lightest_path(self, word: str) -> list[str]:
        """Tropical shortest path; positions are in topological order."""
        best: list[tuple[float, str]] = [(0.0, "")] + [(float("inf"), "")] * len(word)
        for at in range(len(word)):
            for piece, weight in self._arcs(word, at):
                end, cost = at + len(piece), best[at][0] + weight
                if cost < best[end][0]:
                    best[end] = (cost, piece)
        out, at = [], len(word)
        while at:
            out.append(best[at][1])
            at -= len(out[-1])
        return out[::-1]

    def _only_path(self, word: str) -> list[str]:
        """With the border machine a position has one state at most (what merging makes of the text before it),
        and one path ends. Depth first, longest arc first; a position left in vain is never entered again."""
        passes, judge, arcs = self._apart, self._passes, self._arcs
        path, at, size, last = [], 0, len(word), ""
        todo, dead = [iter(arcs(word, 0))], set()
        while at < size:
            for piece, _ in todo[-1]:
                end = at + len(piece)
                if end in dead:
                    continue
                if last:
                    ok = passes.get((last, piece))
                    if ok is None:
                        ok = judge(last, piece)
                    if not ok:
                        continue
                path.append(piece)
                at, last = end, piece
                if at < size:
                    todo.append(iter(arcs(word, at)))
                break
            else:
                dead.add(at)
                todo.pop()
                at -= len(path.pop())
                last = path[-1] if path else ""
        return path

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word, remembered; a word is composed part by part where no piece can reach across."""
        known = self._words.get(word) or self._older.get(word)
        if known is None:
            inside, parts, start = self._inside, [], 0
            for i in range(1, len(word)):
                if word[i - 1 : i + 1] not in inside:
                    parts.append(word[start:i])
                    start = i
            if parts:
                parts.append(word[start:])
                known = tuple(chain.from_iterable([self._words.get(p) or self.word(p) for p in parts]))
            else:
                known = self._spelled(self.path(word))
        if len(self._words) >= CACHE:
            self._older, self._words = self._words, {}
        self._words[word] = known
        return known

    def forget(self) -> None:
        """Drop the words of a finished task: workers are reused, and what they hold counts in later stages."""
        self._words, self._older = {}, {}

    def _spelled(self, pieces: list[str]) -> tuple[int, ...]:
        ids: list[int] = []
        model, known = self.model, self.model.ids.get
        for piece in pieces:
            number = known(piece)
            if number is not None:
                ids.append(number)
            elif model.bytes:
                ids.extend(model.bytes[b] for b in piece.encode())
            else:
                ids.append(model.unknown)
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        normal = MARK + text.replace(" ", MARK)
        known, missed = self._words.get, self.word
        return list(chain.from_iterable([known(word) or missed(word) for word in _WORDS.findall(normal)]))

    def decode(self, ids: list[int]) -> str:
        spelled = self.model.spelled
        text = b"".join([spelled[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    """The compiled machines of a model file, once per worker process."""
    return Transducer(Model(path))


def default_model() -> str:
    """The piece model among the installed public vocabulary files; every executor has the same installation."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def with_ids(documents: DataFrame, model: str | None = None, name: str = "ids", text: str = "text") -> DataFrame:
    """Add array<int>: the piece ids of each whole text. `model` is a path that every executor can read."""
    path = model or default_model()

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        machine = transducer(path)
        rows = [np.array(machine.encode(t.as_py()), np.int32) for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))

    return documents.withColumn(name, encoded(text))


def with_text(encoded: DataFrame, model: str | None = None, name: str = "decoded", ids: str = "ids") -> DataFrame:
    """Add the text that each array of ids spells; a null array spells nothing."""
    path = model or default_model()

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        machine = transducer(path)
        offsets, values = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False)
        return pa.array([machine.decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())

    return encoded.withColumn(name, decoded(ids))


def _both_ways(path: str, digest: bool):
    """Ids of each text and whether they spell it again, encoded once; with `digest` a digest stands for the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            found, same = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                ids = machine.encode(text)
                same.append(machine.decode(ids) == text.replace(MARK, " "))
                found.append(np.array(ids, "<i4"))
            sizes = np.array([len(r) for r in found], np.int64)
            if digest:
                listed = pa.array([hashlib.sha256(r.tobytes()).hexdigest() for r in found], pa.string())
            else:
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                listed = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, "<i4"), *found])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), listed, pa.array(same, pa.bool_())],
                names=["doc_id", "n_pieces", "ids_sha256" if digest else "ids", "same"])
        machine.forget()

    return run


def round_trip(documents: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids_sha256, same): the digest is over the ids as little-endian 32-bit numbers, and `same`
    says that decoding gives back the text."""
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _both_ways(model or default_model(), True), "doc_id long, n_pieces long, ids_sha256 string, same boolean")


def encoded_documents(documents: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids, same): the ids of every document, and whether they decode to its text."""
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _both_ways(model or default_model(), False), "doc_id long, n_pieces long, ids array<int>, same boolean")
