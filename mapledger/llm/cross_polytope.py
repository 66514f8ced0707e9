"""Approximate nearest neighbours by cross-polytope hashing.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform) turns a vector; its hash is the
signed axis nearest to the turned vector, one of twice as many as there are dimensions. `TABLES` independent
rotations give tables that hold every row. A query probes the axes of each table in the order of its own
coordinates; all rows found are ranked by exact inner products in double precision.

Inner products rank like angles only for vectors of one length, so where lengths differ, one coordinate is added
that lifts every row to the greatest length; queries get a zero there. How many axes a query probes is fitted:
`SAMPLE` queries are compared with all rows, and the least number of probes that finds `RECALL` of their true
neighbours is taken. The sample bounds the fit alone; every row is indexed.

Buckets are dealt over blocks of rows and of queries, so no task holds more than `BLOCK` of each. A task merges
what its buckets yield into packed lists; candidates never become rows.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows with a null vec_id. Vectors of different lengths are never compared. Rows with the query's own id are no
candidates of it; rows repeated with one id are one candidate, with its best score. Equal scores rank by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.llm.steps import staged
from mapledger.llm.textbytes import group_starts, runs_of_keys
from mapledger.llm.vectors import usable

TABLES = 6
BLOCK = 4096
SAMPLE = 96
RECALL = 0.97
_HELD = 1 << 20


def _turned(matrix: np.ndarray, number: int) -> np.ndarray:
    """Rows under table `number`'s pseudo-rotation, padded to a power of two of at least 16."""
    width = 1 << max(4, (matrix.shape[1] - 1).bit_length())
    turned = np.zeros((len(matrix), width))
    turned[:, : matrix.shape[1]] = matrix
    signs = np.random.default_rng((width, number)).choice((-1.0, 1.0), (3, width))
    for row in signs:
        turned *= row
        step = 1
        while step < width:
            halves = turned.reshape(len(turned), -1, 2, step)
            turned = np.stack((halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]), axis=2)
            turned = turned.reshape(len(matrix), width)
            step *= 2
    return turned


def _axes(matrix: np.ndarray, number: int) -> np.ndarray:
    """The nearest signed axis: its number, plus the width for the negative side."""
    turned = _turned(matrix, number)
    best = np.abs(turned).argmax(axis=1)
    return best + turned.shape[1] * (turned[np.arange(len(best)), best] < 0)


def _probe_order(matrix: np.ndarray, number: int) -> np.ndarray:
    """All signed axes of a table for each query, nearest first."""
    turned = _turned(matrix, number)
    return np.argsort(-np.concatenate((turned, -turned), axis=1), axis=1, kind="stable")


def _lifted(matrix: np.ndarray, top: float | None) -> np.ndarray:
    """Rows with the coordinate that makes all lengths equal to `top`; without one, as they are."""
    if top is None:
        return matrix
    scaled = matrix / top
    return np.hstack((scaled, np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1, keepdims=True)))))


def _asked(matrix: np.ndarray, top: float | None) -> np.ndarray:
    return matrix if top is None else np.hstack((matrix, np.zeros((len(matrix), 1))))


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed in one order, so equal vectors have equal scores in every task."""
    return np.ascontiguousarray(left * right).sum(axis=1)


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows: list[tuple[int, bytes, float]] = []
        for at, matrix in usable(batch.column(1)):
            for i, vector in zip(at, matrix, strict=True):
                if ids[i] is not None:
                    rows.append((ids[i], vector.tobytes(), float(np.linalg.norm(vector))))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.float64()), strict=True)],
            names=["vec_id", "vector", "norm"])


def _by_length(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.array([len(v) for v in raw], np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)


def _top(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Rows of a flat list that are the k best of their query, best first; an id counts once."""
    order = np.lexsort((ids, -scores, queries))
    q, x = queries[order], ids[order]
    again = np.lexsort((np.arange(len(order)), x, q))
    repeated = np.zeros(len(order), bool)
    repeated[again[1:]] = (q[again[1:]] == q[again[:-1]]) & (x[again[1:]] == x[again[:-1]])
    order, q = order[~repeated], q[~repeated]
    starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[rank < k]


def _block_best(asked: np.ndarray, asked_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids of one block for each query, ties included before the exact ranking."""
    found: tuple[list, list, list] = ([], [], [])
    by_id = np.argsort(ids, kind="stable")
    firsts = np.flatnonzero(np.concatenate(([True], ids[by_id[1:]] != ids[by_id[:-1]])))
    for at in range(0, len(asked), 1024):
        part, own = asked[at : at + 1024], asked_ids[at : at + 1024]
        rough = part @ rows.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        if len(firsts) > k:
            # An id's rows are one candidate: the bar is the k-th best id's best row.
            best = rough if len(firsts) == len(ids) else np.maximum.reduceat(rough[:, by_id], firsts, axis=1)
            bar = np.partition(best, len(firsts) - k, axis=1)[:, len(firsts) - k]
            scale = np.abs(part).sum(axis=1) * np.abs(rows).max()
            rough[rough < (bar - 1e-12 * scale)[:, None]] = -np.inf
        q, x = np.nonzero(np.isfinite(rough))
        scores = inner(part[q], rows[x])
        keep = _top(q, ids[x], scores, k)
        found[0].append(own[q[keep]])
        found[1].append(ids[x[keep]])
        found[2].append(scores[keep])
    return tuple(np.concatenate(f) for f in found)


def _packed(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    """One row per query from a list sorted by query."""
    starts = np.flatnonzero(np.concatenate(([True], queries[1:] != queries[:-1]))) if len(queries) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(starts, len(queries)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(queries[starts], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64())),
         pa.ListArray.from_arrays(offsets, pa.array(scores, pa.float64()))],
        names=["query_id", "ids", "scores"])


_PACKED = "query_id long, ids array<long>, scores array<double>"


class _Best:
    """Running best lists of a task, emptied whenever they hold more than a fixed number of entries."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.size, self.merged = k, [], 0, 0

    def add(self, part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.parts.append(part)
        self.size += len(part[0])
        if self.size > _HELD + self.merged:
            self.fold()
            if self.merged > _HELD:
                yield from self.drain()

    def fold(self) -> None:
        q, x, s = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        keep = _top(q, x, s, self.k)
        self.parts, self.size, self.merged = [(q[keep], x[keep], s[keep])], len(keep), len(keep)

    def drain(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self.fold()
            yield _packed(*self.parts[0])
        self.parts, self.size, self.merged = [], 0, 0


def _compared(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["length", "number", "axis", "row_block", "query_block"]
        best = _Best(k)
        for table in runs_of_keys(batches, keys):
            starts = group_starts(table, keys)
            ids, asks = table.column("vec_id").to_numpy(), table.column("asks").to_numpy()
            raw = table.column("vector").to_pylist()
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                matrix = np.frombuffer(b"".join(raw[s:e]), np.float64).reshape(e - s, -1)
                asking, own = asks[s:e], ids[s:e]
                if asking.any() and not asking.all():
                    yield from best.add(_block_best(matrix[asking], own[asking], matrix[~asking], own[~asking], k))
        yield from best.drain()

    return run


def _merged(k: int):
    """Lists of the same query, sorted by query, to ranked rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of_keys(batches, ["query_id"]):
            lists = table.column("ids").combine_chunks()
            q = np.repeat(table.column("query_id").to_numpy(), lists.value_lengths().to_numpy())
            x = lists.flatten().to_numpy()
            s = table.column("scores").combine_chunks().flatten().to_numpy()
            keep = _top(q, x, s, k)
            q = q[keep]
            starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
            rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q)))) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(rank, pa.int32()), pa.array(x[keep], pa.int64()),
                 pa.array(s[keep], pa.float64())], names=["query_id", "rank", "vec_id", "score"])

    return run


def _placed(top: float | None):
    """Each row's axis in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            axes: list = [None] * batch.num_rows
            for at, matrix in _by_length(batch.column(1).to_pylist()):
                lifted = _lifted(matrix, top)
                found = np.stack([_axes(lifted, t) for t in range(TABLES)], axis=1)
                for i, row in zip(at, found.tolist(), strict=True):
                    axes[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(axes, pa.list_(pa.int32()))], names=["vec_id", "vector", "axes"])

    return run


def _probing(top: float | None, probes: int):
    """The axes that each query probes: one (table, axis) struct for each."""
    kind = pa.list_(pa.struct([("number", pa.int32()), ("axis", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list = [None] * batch.num_rows
            for at, matrix in _by_length(batch.column(1).to_pylist()):
                asked = _asked(matrix, top)
                order = [_probe_order(asked, t)[:, :probes] for t in range(TABLES)]
                for j, i in enumerate(at):
                    lists[i] = [{"number": t, "axis": int(a)} for t in range(TABLES) for a in order[t][j]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, kind)], names=["vec_id", "vector", "probes"])

    return run


def fitted_probes(index: DataFrame, queries: DataFrame, top: float | None, k: int) -> int:
    """The least number of probes that finds RECALL of the true neighbours of sampled queries."""
    sample = queries.orderBy(F.xxhash64("vec_id", F.lit(17)), "vec_id").limit(SAMPLE).collect()
    if not sample:
        return 1
    asked = [(r.vec_id, bytes(r.vector)) for r in sample]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, matrix in _by_length(batch.column(1).to_pylist()):
                own = [(i, v) for i, v in asked if len(v) == 8 * matrix.shape[1]]
                if own:
                    part = np.frombuffer(b"".join(v for _, v in own), np.float64).reshape(len(own), -1)
                    yield from best.add(_block_best(part, np.array([i for i, _ in own]), matrix, ids[at], k))
        yield from best.drain()

    lists = index.select("vec_id", "vector").mapInArrow(run, _PACKED)
    truth = lists.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(
        _merged(k), "query_id long, rank int, vec_id long, score double")
    near = truth.join(index.select("vec_id", "axes"), "vec_id").select("query_id", "vec_id", "axes").collect()
    vectors = dict(asked)
    needed = []
    for query, vector in vectors.items():
        own = [r.axes for r in near if r.query_id == query]
        if own:
            matrix = _asked(np.frombuffer(vector, np.float64).reshape(1, -1), top)
            place = [np.argsort(_probe_order(matrix, t)[0]) for t in range(TABLES)]
            needed.extend(1 + min(place[t][axes[t]] for t in range(TABLES)) for axes in own)
    return int(np.sort(needed)[int(np.ceil(RECALL * len(needed))) - 1]) if needed else 1


def nearest(embeddings: DataFrame, asks: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row that `asks` is true for."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    plain = rows.mapInArrow(_plain, "vec_id long, vector binary, norm double")
    held = staged(plain.dropDuplicates(["vec_id", "vector"]), "vectors")
    span = held.agg(F.min("norm"), F.max("norm")).first()
    # Lengths that differ by rounding alone need no lifting.
    top = span[1] if span[0] is not None and span[1] > span[0] * (1 + 1e-6) else None
    index = staged(held.select("vec_id", "vector").mapInArrow(
        _placed(top), "vec_id long, vector binary, axes array<int>"), "index")
    queries = held.where(asks).select("vec_id", "vector")
    probes = fitted_probes(index, queries, top, k)
    asked = staged(queries.mapInArrow(
        _probing(top, probes), "vec_id long, vector binary, probes array<struct<number:int,axis:int>>"), "probes")
    length = F.octet_length("vector")
    bucket = ["length", "number", "axis"]
    rows = index.select("vec_id", "vector", length.alias("length"), F.posexplode("axes").alias("number", "axis"))
    asking = asked.select("vec_id", "vector", length.alias("length"), F.explode("probes").alias("p")).select(
        "vec_id", "vector", "length", "p.number", "p.axis")
    # Bucket sizes: at most tables * axes rows, whatever the data.
    row_blocks = rows.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("row_blocks"))
    query_blocks = asking.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("query_blocks"))
    sizes = staged(row_blocks.join(query_blocks, bucket), "buckets")
    dealt_rows = rows.join(sizes, bucket).select(
        *bucket, F.expr("cast(pmod(xxhash64(vec_id), row_blocks) as int)").alias("row_block"),
        F.explode(F.expr("sequence(0, query_blocks - 1)")).alias("query_block"), F.lit(False).alias("asks"), "vec_id", "vector")
    dealt_queries = asking.join(sizes, bucket).select(
        *bucket, F.explode(F.expr("sequence(0, row_blocks - 1)")).alias("row_block"),
        F.expr("cast(pmod(xxhash64(vec_id), query_blocks) as int)").alias("query_block"), F.lit(True).alias("asks"),
        "vec_id", "vector")
    keys = [*bucket, "row_block", "query_block"]
    lists = dealt_rows.unionByName(dealt_queries).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compared(k), _PACKED)
    return lists.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(
        _merged(k), "query_id long, rank int, vec_id long, score double")
