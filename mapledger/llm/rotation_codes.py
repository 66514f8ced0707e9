"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector o, rotated at random, is stored as the signs of its coordinates: the nearest corner x of a cube.
The stored factor <x, o> corrects the code, so that <x, q> / <x, o> estimates <o, q> without bias, with an error
whose bound follows from the same factor. Estimates decide which pairs need exact recomputation: only pairs whose
upper confidence bound reaches the wanted cosine are computed in double precision, and only those count.

The same signs are the search structure. Bands of `bits` signs from several rotations form tables; `plan` chooses
bits and tables from the number of vectors, so that a bucket stays small and a pair exactly at the threshold shares
no bucket with a probability of at most `MISS` (pairs above it with far less). A pair is counted in the first
table that it shares. Buckets of more than `BLOCK` vectors are dealt over blocks, pairs of blocks are separate
tasks, and each of them returns counts and a spanning set of links, never its pairs. Equal vectors collapse to
one weighted representative beforehand.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
neither do rows with a null vec_id; they have no links, are their own component and are kept. Vectors of
different lengths never link. Rows repeated with one id are copies of each other if their vectors are equal.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.llm.steps import connected, staged
from mapledger.llm.textbytes import group_starts, runs_of_keys
from mapledger.llm.vectors import padded, unit, usable

BLOCK = 2048
MISS = 0.003
#: Half-width of the confidence interval in standard errors.
CONFIDENCE = 4.5
#: Vectors that a bucket holds on average, about.
SHARE = 128


@dataclass(frozen=True)
class Plan:
    """Bits of a band, number of tables, the wanted cosine."""

    bits: int
    tables: int
    least: float

    def places(self, width: int) -> list[tuple[int, int]]:
        """(rotation, first sign) of every table's band."""
        each = width // self.bits
        return [(t // each, t % each * self.bits) for t in range(self.tables)]

    def rotations(self, width: int) -> int:
        return -(-self.tables // (width // self.bits))


def plan(vectors: int, least: float = 0.9) -> Plan:
    bits = min(48, max(6, math.ceil(math.log2(max(vectors, 2) / SHARE))))
    agree = (1 - math.acos(least) / math.pi) ** bits
    return Plan(bits, math.ceil(math.log(MISS) / math.log1p(-agree)), least)


@lru_cache(maxsize=64)
def rotation(width: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    basis, upper = np.linalg.qr(np.random.default_rng((width, number)).standard_normal((width, width)))
    return basis * np.sign(np.diag(upper))


def _vectors(kind: str):
    """Each row's digest, and its vector as bytes; both null where the vector takes no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            digests, held = [None] * len(ids), [None] * len(ids)
            for rows, matrix in usable(batch.column(1)):
                for row, vector in zip(rows, matrix.astype(kind), strict=True):
                    held[row] = vector.tobytes()
                    digests[row] = hashlib.blake2b(held[row], digest_size=16).digest()
            taken = ids.is_valid().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([d if t else None for d, t in zip(digests, taken, strict=True)], pa.binary()),
                 pa.array(held, pa.binary())],
                names=["vec_id", "digest", "vector"])

    return run


def _matrix(raw: list[bytes], kind: str) -> np.ndarray:
    """Stored vectors of one length, in double precision."""
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)


def _coded(chosen: Plan, kind: str):
    """Codes (packed signs of all rotations), factors and band keys of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            codes, factors, bands = [None] * len(raw), [None] * len(raw), [None] * len(raw)
            lengths = np.array([len(v) for v in raw])
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                wide = padded(unit(_matrix([raw[r] for r in rows], kind)))
                width = wide.shape[1]
                signs, scales = [], []
                for r in range(chosen.rotations(width)):
                    turned = wide @ rotation(width, r)
                    signs.append(turned > 0)
                    scales.append(np.abs(turned).sum(axis=1) / math.sqrt(width))
                packed = np.packbits(np.concatenate(signs, axis=1), axis=1)
                scale = np.stack(scales, axis=1).astype(np.float32)
                keys = _band_keys(packed, width, chosen)
                for i, row in enumerate(rows):
                    codes[row], factors[row], bands[row] = packed[i].tobytes(), scale[i].tobytes(), keys[i].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(codes, pa.binary()),
                 pa.array(factors, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["vec_id", "copies", "vector", "code", "factors", "bands"])

    return run


def _band_keys(packed: np.ndarray, width: int, chosen: Plan) -> np.ndarray:
    """The key of every table's bucket, by vector; the vector's length is part of it."""
    signs = np.unpackbits(packed, axis=1)
    weights = 1 << np.arange(chosen.bits, dtype=np.int64)
    keys = [signs[:, r * width + at : r * width + at + chosen.bits] @ weights for r, at in chosen.places(width)]
    return np.stack(keys, axis=1) + np.int64(width // 64) * (np.int64(1) << np.int64(chosen.bits))


def _linked(chosen: Plan, kind: str):
    """Inside one bucket (or pair of its blocks): estimate, recompute where needed, return counts and links."""

    def judge(number: int, home: np.ndarray, crossing: bool, vectors: np.ndarray, codes: np.ndarray,
              factors: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        exact = unit(vectors)
        wide = padded(exact)
        width = wide.shape[1]
        r, _ = chosen.places(width)[number]
        turned = wide @ rotation(width, r)
        signs = np.unpackbits(codes[:, r * width // 8 : (r + 1) * width // 8], axis=1).astype(np.float64) * 2 - 1
        scale = factors[:, r].astype(np.float64)
        error = CONFIDENCE * np.sqrt(np.maximum(1 - scale * scale, 0) / (scale * scale) / (width - 1))
        estimate = (signs @ turned.T) / (math.sqrt(width) * scale)[:, None]
        maybe = np.triu(estimate + error[:, None] >= chosen.least, 1)
        # The estimate from the other side's code must not rule the pair out either.
        maybe &= estimate.T + error[None, :] >= chosen.least
        if crossing:
            maybe &= home[:, None] != home[None, :]
        left, right = np.nonzero(maybe)
        if len(left):
            sure = np.einsum("ij,ij->i", exact[left], exact[right]) >= chosen.least
            left, right = left[sure], right[sure]
        if len(left) and number:
            keys = _band_keys(codes, width, chosen)[:, :number]
            first = ~(keys[left] == keys[right]).any(axis=1)
            left, right = left[first], right[first]
        count = np.zeros(len(vectors), np.int64)
        np.add.at(count, left, copies[right])
        np.add.at(count, right, copies[left])
        up = np.arange(len(vectors))
        while len(left):
            low = np.minimum(up[left], up[right])
            before = up.copy()
            np.minimum.at(up, left, low)
            np.minimum.at(up, right, low)
            up = up[up]
            if (before == up).all():
                break
        return count, up, np.flatnonzero(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["number", "key", "low", "high"]
        for table in runs_of_keys(batches, keys):
            starts = group_starts(table, keys)
            ids, copies = table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
            raw, codes, factors = (table.column(c).to_pylist() for c in ("vector", "code", "factors"))
            number, home = table.column("number").to_numpy(), table.column("home").to_numpy()
            low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
            out: tuple[list, list, list] = ([], [], [])
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2:
                    continue
                order = s + np.argsort(ids[s:e], kind="stable")
                lengths = np.array([len(raw[i]) for i in order])
                for length in np.unique(lengths):
                    part = order[lengths == length]
                    count, up, active = judge(
                        int(number[s]), home[part], low[s] != high[s],
                        _matrix([raw[i] for i in part], kind),
                        np.frombuffer(b"".join(codes[i] for i in part), np.uint8).reshape(len(part), -1),
                        np.frombuffer(b"".join(factors[i] for i in part), np.float32).reshape(len(part), -1),
                        copies[part])
                    out[0].extend(ids[part[active]])
                    out[1].extend(ids[part[up[active]]])
                    out[2].extend(count[active])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], names=["vec_id", "root", "links"])

    return run


def classes(embeddings: DataFrame, least: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    # Vectors travel in the precision they were given in; every product is formed in double precision.
    kind = "<f4" if rows.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    held = staged(rows.mapInArrow(_vectors(kind), "vec_id long, digest binary, vector binary"), "vectors")
    # The least id of equal vectors stands for them; ids may repeat, so (id, digest) picks the row.
    same = staged(
        held.where("digest is not null").groupBy("digest")
        .agg(F.min_by(F.struct("vec_id", "vector"), "vec_id").alias("x"), F.count(F.lit(1)).alias("copies"))
        .select("digest", "x.vec_id", "copies", "x.vector"), "distinct-vectors")
    chosen = plan(same.count(), least)
    index = staged(
        same.select("vec_id", "copies", "vector").mapInArrow(
            _coded(chosen, kind), "vec_id long, copies long, vector binary, code binary, factors binary, bands array<long>"),
        "codes")
    banded = index.select("vec_id", "copies", "vector", "code", "factors", F.posexplode("bands").alias("number", "key"))
    # Only buckets beyond one block need to know their size. Being a written table, this one's size is known when
    # the join is planned: it is sent to all tasks while it is small, and exchanged where it is not.
    blocks = staged(
        index.select(F.posexplode("bands").alias("number", "key")).groupBy("number", "key").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > BLOCK).select("number", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "blocks")
    dealt = (
        banded.join(blocks, ["number", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("home", F.expr("cast(pmod(xxhash64(vec_id), blocks) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("low", F.least("home", "other")).withColumn("high", F.greatest("home", "other"))
        .select("number", "key", "low", "high", "home", "vec_id", "copies", "vector", "code", "factors")
    )
    keys = ["number", "key", "low", "high"]
    links = staged(
        dealt.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_linked(chosen, kind), "vec_id long, root long, links long"), "links")
    counted = links.groupBy("vec_id").agg(F.sum("links").alias("_links"))
    component = connected(links.where("vec_id <> root"), "vec_id", "root").withColumnRenamed("node", "vec_id")
    known = (
        same.select("digest", "vec_id", "copies").join(counted, "vec_id", "left").join(component, "vec_id", "left")
        .select("digest", (F.col("copies") - 1 + F.coalesce("_links", F.lit(0))).alias("_n"),
                F.coalesce("component", "vec_id").alias("_class"))
    )
    return held.select("vec_id", "digest").join(known, "digest", "left").select(
        "vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_class", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
