"""Suffix-array dedup: maximal repeats from a common-prefix interval tree.

Every window of `least` bytes chooses one anchor inside it, the least of its k-gram hashes; equal windows choose
the same anchor, wherever they stand. A sparse suffix array over anchors therefore sees every repeat of at least
`least` bytes. Anchors whose k-gram occurs once are dropped; the rest carry the text around them that their
windows span, and meet by k-gram.

Within one k-gram the suffixes are sorted, common prefixes of neighbours computed, and a stack scan turns them into
the interval tree. In each interval the members are ordered by what stands to their left; a second stack scan
yields the left-diverse sets: groups that can be extended neither to the left nor to the right without losing a
member. Those are the maximal repeats with all their occurrences, and their spans cover exactly the repeated bytes.

Hot k-grams (more than `GROUP` anchors) never meet in one task. They are dealt at random, each task settles what
repeats within its share and sends one representative of each distinct window on, by hash of the window, packed
into arrays; what meets there is repeated. This gives the same spans without a tree.

Defined results: texts are UTF-8 bytes, null is empty, and shorter texts have no window. Rows with equal texts
collapse to one class before anything else: with two or more rows, all of a long enough text is repeated. Rows are
told apart by content, so null or repeated ids and extra columns change nothing. Window hashes of the hot path have
128 bits; everything else compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.llm.steps import staged
from mapledger.llm.textbytes import column_bytes, gram_hashes, group_starts, minimizers, runs_of_keys, slice_hashes

LEAST = 400
GRAM = 48
GROUP = 2000

_OTHER = np.random.default_rng(48).permutation(256).astype(np.uint8)
_WINDOW = np.dtype([("a", "<u8"), ("b", "<u8"), ("key", "V16"), ("start", "<i8"), ("sure", "?")])
_PLACE = np.dtype([("key", "V16"), ("start", "<i8")])


def anchors(data: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """k-gram hash and position of each anchor, and the first and last window start that chose it."""
    gram = min(GRAM, least)
    if len(data) < least:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at, first, last = minimizers(gram_hashes(data, gram), least - gram + 1)
    return slice_hashes(data, at, at + gram).astype(np.int64), at, first, last


def _anchored(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, owners = batch.column(0), [], []
            for i, data in enumerate(column_bytes(batch.column(1))):
                found = anchors(data, least)
                parts.append(found)
                owners.append(np.full(len(found[0]), i))
            if not parts:
                continue
            owner = pa.array(np.concatenate(owners).astype(np.int64))
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [keys.take(owner), *(pa.array(c.astype(np.int64)) for c in columns)],
                names=["key", "gram", "at", "first", "last"])

    return run


def _surrounded(least: int):
    """Anchors of one text with the bytes that their windows span."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("gram", pa.int64()), ("salt", pa.int32()), ("hot", pa.bool_()), ("key", pa.binary()),
                 ("first", pa.int64()), ("left", pa.int64()), ("around", pa.binary())]
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for key, places, data in zip(batch.column(0), batch.column(2), column_bytes(batch.column(1)), strict=True):
                key, text = key.as_py(), data.tobytes()
                for p in places.as_py():
                    around = text[p["first"] : p["last"] + least]
                    rows.append((p["gram"], p["salt"], p["hot"], key, p["first"], p["at"] - p["first"], around))
                    size += len(around)
                if size > 1 << 23:
                    yield _batch(rows, kinds)
                    rows, size = [], 0
            yield _batch(rows, kinds)

    return run


def _batch(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    low = 0
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def intervals(shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """The interval tree of a sorted list, children before parents: (first, last, common length), given the
    common lengths of neighbours. One scan with a stack."""
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*shared, -1]):
        left = i
        while stack and stack[-1][0] > length:
            deep, left = stack.pop()
            yield left, i, deep
        if length >= 0 and (not stack or stack[-1][0] < length):
            stack.append((length, left))


def maximal_groups(texts: list[bytes], lefts: list[int], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats through a common k-gram: (bytes to the left, bytes to the right, members).

    `texts` are distinct; `lefts` says where the k-gram starts in each.
    """
    after = [t[at:] for t, at in zip(texts, lefts, strict=True)]
    before = [t[:at][::-1] for t, at in zip(texts, lefts, strict=True)]
    order = sorted(range(len(texts)), key=after.__getitem__)
    rank = {m: i for i, m in enumerate(sorted(range(len(texts)), key=before.__getitem__))}
    longest = max(lefts)
    for first, last, right in intervals([common(after[x], after[y]) for x, y in zip(order, order[1:], strict=False)]):
        if right + longest < least:
            continue
        members = sorted(order[first : last + 1], key=rank.__getitem__)
        shared = [common(before[x], before[y]) for x, y in zip(members, members[1:], strict=False)]
        # A node of this second tree is left-diverse: its members differ one byte further left, or end there.
        for low, high, left in intervals(shared):
            if left + right >= least:
                yield left, right, members[low : high + 1]


def covered(texts: list[bytes], lefts: list[int], least: int) -> list[list[tuple[int, int]]]:
    """For each distinct text the spans of its own that occur in another one, in its own offsets."""
    spans: list[dict[int, int]] = [{} for _ in texts]
    for left, right, members in maximal_groups(texts, lefts, least):
        for m in members:
            start = lefts[m] - left
            spans[m][start] = max(spans[m].get(start, 0), lefts[m] + right)
    return [merged(sorted(s.items())) for s in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans united where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _windows(items: dict[bytes, list], least: int) -> np.ndarray:
    """All windows of distinct texts, with two hashes each."""
    parts = []
    for around, (place, *_more) in items.items():
        data = np.frombuffer(around, np.uint8)
        rows = np.zeros(len(data) - least + 1, _WINDOW)
        rows["a"], rows["b"] = gram_hashes(data, least), gram_hashes(_OTHER[data], least)
        rows["key"] = np.void(place[0])
        rows["start"] = place[1] + np.arange(len(rows))
        rows["sure"] = len(_more) > 0
        parts.append(rows)
    return np.concatenate(parts)


def _same_windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows sorted by hash, the first row of each distinct window, and how often each occurs."""
    rows = rows[np.lexsort((rows["start"], rows["b"], rows["a"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])
    starts = np.flatnonzero(new)
    return rows, starts, np.diff(np.append(starts, len(rows)))


def _united(places: np.ndarray, least: int) -> list[tuple[bytes, int, int]]:
    """Spans that the given windows cover, by text."""
    if not len(places):
        return []
    keys = np.ascontiguousarray(places["key"]).view("<u8").reshape(-1, 2)
    order = np.lexsort((places["start"], keys[:, 1], keys[:, 0]))
    keys, starts = keys[order], places["start"][order]
    new = np.ones(len(starts), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1) | (starts[1:] > starts[:-1] + least)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(starts)) - 1
    return [(keys[f].tobytes(), int(starts[f]), int(starts[x]) + least) for f, x in zip(firsts, lasts, strict=True)]


_FOUND = "part int, key binary, start long, end long, packed binary"
_FOUND_KINDS = [("part", pa.int32()), ("key", pa.binary()), ("start", pa.int64()), ("end", pa.int64()), ("packed", pa.binary())]


def _dealt(rows: np.ndarray, by: np.ndarray, parts: int) -> list[tuple]:
    """Packed rows, one per part that anything goes to."""
    order = np.argsort(by, kind="stable")
    edges = np.searchsorted(by[order], np.arange(parts + 1))
    return [(p, None, None, None, rows[order[edges[p] : edges[p + 1]]].tobytes())
            for p in range(parts) if edges[p] < edges[p + 1]]


def _searched(least: int, parts: int):
    """Spans of ordinary k-grams; of hot ones the spans settled here, and packed windows for the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["gram", "salt"]
        for table in runs_of_keys(batches, keys):
            starts = group_starts(table, keys)
            hot = table.column("hot").to_numpy()
            names, firsts, lefts, arounds = (table.column(c).to_pylist() for c in ("key", "first", "left", "around"))
            out: list[tuple] = []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2 and not hot[s]:
                    continue
                # Equal surroundings are one text; its places are known by text and start.
                items: dict[bytes, list] = {}
                left_of: dict[bytes, int] = {}
                for i in range(s, e):
                    places = items.setdefault(arounds[i], [])
                    left_of[arounds[i]] = lefts[i]
                    if (names[i], firsts[i]) not in places[-1:]:
                        places.append((names[i], firsts[i]))
                for around, places in items.items():
                    places[:] = dict.fromkeys(places)
                    if len(places) > 1:
                        out.extend((None, k, at, at + len(around), None) for k, at in places)
                if hot[s]:
                    rows, begins, counts = _same_windows(_windows(items, least))
                    twice = np.repeat(counts > 1, counts)
                    sure = np.logical_or.reduceat(rows["sure"], begins) | (counts > 1)
                    out.extend((None, k, a, b, None) for k, a, b in _united(rows[twice], least))
                    once = rows[begins]
                    once["sure"] = sure
                    out.extend(_dealt(once, (once["a"] % np.uint64(parts)).astype(np.int64), parts))
                elif len(items) > 1:
                    texts = list(items)
                    for around, spans in zip(texts, covered(texts, [left_of[t] for t in texts], least), strict=True):
                        if len(items[around]) == 1:
                            k, at = items[around][0]
                            out.extend((None, k, at + a, at + b, None) for a, b in spans)
            yield _batch(out, _FOUND_KINDS)

    return run


def _met(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Windows of one part: those met twice, packed by text."""
    for table in runs_of_keys(batches, ["part"]):
        starts = group_starts(table, ["part"])
        packed, out = table.column("packed").to_pylist(), []
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            rows, _, counts = _same_windows(np.frombuffer(b"".join(packed[s:e]), _WINDOW))
            open_ = rows[np.repeat(counts > 1, counts) & ~rows["sure"]]
            places = np.zeros(len(open_), _PLACE)
            places["key"], places["start"] = open_["key"], open_["start"]
            by = np.ascontiguousarray(places["key"]).view("<u8").reshape(-1, 2)[:, 0] % np.uint64(parts)
            out.extend(_dealt(places, by.astype(np.int64), parts))
        yield _batch(out, _FOUND_KINDS)


def _closed(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of_keys(batches, ["part"]):
            starts = group_starts(table, ["part"])
            packed, out = table.column("packed").to_pylist(), []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                places = np.frombuffer(b"".join(packed[s:e]), _PLACE)
                out.extend((None, k, a, b, None) for k, a, b in _united(places, least))
            yield _batch(out, _FOUND_KINDS)

    return run


def _cut(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts without their spans: removed bytes, runs, digest of the rest, the rest. All of a copied text goes."""
        for batch in batches:
            rows = []
            columns = (batch.column(0), column_bytes(batch.column(1)), batch.column(2), batch.column(3))
            for doc_id, data, copies, spans in zip(*columns, strict=True):
                runs = merged(sorted((x["start"], x["end"]) for x in spans.as_py() or ()))
                if copies.as_py() > 1 and len(data) >= least:
                    runs = [(0, len(data))]
                kept, at = [], 0
                for start, end in runs:
                    kept.append(data[at:start].tobytes())
                    at = end
                kept.append(data[at:].tobytes())
                rows.append((doc_id.as_py(), len(data), sum(e - s for s, e in runs), len(runs),
                             hashlib.sha256(b"".join(kept)).hexdigest(), "".join(k.decode("utf-8", "ignore") for k in kept)))
            yield _batch(rows, [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                                ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    return run


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        "doc_id", F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("key"), text.cast("binary").alias("data"))


def repeated_spans(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(classes, spans): `key, rows, one` of each distinct text, and `key, spans` of those with repeated bytes
    (sorted out by the caller; spans may overlap)."""
    spark = documents.sparkSession
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = _keyed(documents)
    classes = staged(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("one")), "classes")
    found = staged(
        keyed.where(F.octet_length("data") >= least).select("key", "data")
        .mapInArrow(_anchored(least), "key binary, gram long, at long, first long, last long")
        .dropDuplicates(["key", "at"]), "anchors")
    counts = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = F.col("n") > GROUP
    salt = F.when(hot, F.pmod(F.xxhash64("key", "at"), F.ceil(F.col("n") / GROUP))).otherwise(0).cast("int")
    twice = found.join(counts, "gram").groupBy("key").agg(
        F.collect_list(F.struct("gram", salt.alias("salt"), hot.alias("hot"), "at", "first", "last")).alias("places"))
    chosen = twice.join(classes, "key").select(F.col("key"), "one", "places")
    around = (
        keyed.join(chosen.hint("merge"), "key").where(F.col("doc_id").eqNullSafe(F.col("one"))).select("key", "data", "places")
        .mapInArrow(_surrounded(least), "gram long, salt int, hot boolean, key binary, first long, left long, around binary")
    )
    searched = staged(
        around.repartition("gram", "salt").sortWithinPartitions("gram", "salt").mapInArrow(_searched(least, parts), _FOUND),
        "repeats")
    met = (
        searched.where("part is not null").repartition(parts, "part").sortWithinPartitions("part")
        .mapInArrow(lambda batches: _met(batches, parts), _FOUND)
        .repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_closed(least), _FOUND)
    )
    spans = (
        searched.where("part is null").unionByName(met)
        .groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    return classes, spans


def without_repeats(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) of every row. `kept_text` is what is left of the
    text without the characters that a run cuts in two."""
    classes, spans = repeated_spans(documents, least)
    found = classes.select("key", "rows").join(spans, "key", "left")
    return (
        _keyed(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "key", "data").join(found.hint("merge"), "key")
        .select("doc_id", "data", "rows", "spans")
        .mapInArrow(_cut(least), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    )
