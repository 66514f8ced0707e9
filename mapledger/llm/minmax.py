"""MinHash near-dedup by min-max hashing.

Every permutation of a document's word-shingle set yields two signature values, the least and the greatest
hash, so `PERMUTATIONS` hash evaluations give twice as many values. Rows of values are banded; documents that
agree on a band become candidates, candidates are confirmed on their full sets, and linked documents form
classes.

The work stays linear in the rows, whatever the size of a group:
* documents with the same shingle set collapse to one representative before anything is compared;
* a band bucket links each member to its least one if their signatures are similar, and only buckets where some
  are not are compared as a whole, each member with leaders. A bucket beyond `BUCKET` members is linked without
  comparing. The groups so linked hold all true links of documents that share a bucket;
* the resulting candidate groups are confirmed exactly on full sets in blocks of at most `BLOCK` documents.
  Blocks first unite what they hold; then only the documents that a group's largest class does not hold meet
  the other blocks. Within blocks, inverted lists count the shared shingles, so no pair of documents without
  a shared shingle is looked at.

Defined results: texts are lower-cased (A to Z only) and split at space and the controls 0x09 to 0x0D. With
fewer words than `size` the whole sequence is the only shingle. Null, empty and blank texts have no shingles
and stay alone. Rows are told apart by doc_id; rows repeated with one id count as copies of it, rows with a
null id are classes of their own. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.llm.steps import connected, staged
from mapledger.llm.textbytes import column_bytes, group_starts, mix, runs_of_keys, shingle_set

PERMUTATIONS = 50
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
SKETCH = 64
BUCKET = 4096
BLOCK = 1024
#: Shingles of one block, about: long documents come in smaller blocks.
HELD = 1 << 19
SIZE = 5
_GATHERED = 1 << 20

_MULTIPLIERS = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFTS = mix(np.arange(101, PERMUTATIONS + 101, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least and greatest value of every permutation, alternating by permutation so that bands mix both."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    greatest = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        for k in range(PERMUTATIONS):
            hashed = part * _MULTIPLIERS[k] + _SHIFTS[k]
            hashed ^= hashed >> np.uint64(32)
            hashed *= np.uint64(0xD6E8FEB86659FD93)
            least[k] = min(least[k], hashed.min())
            greatest[k] = max(greatest[k], hashed.max())
    return np.stack((least, greatest), axis=1).ravel()


def _set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, set digest, and for non-empty sets the band keys and a byte sketch of the signature."""
    for batch in batches:
        ids, sizes, digests, bands, sketches = batch.column(0), [], [], [], []
        for data in column_bytes(batch.column(1)):
            shingles = shingle_set(data, SIZE)
            sizes.append(len(shingles))
            digests.append(_set_digest(shingles) if len(shingles) else None)
            if not len(shingles):
                bands.append(None)
                sketches.append(None)
                continue
            values = signature(shingles)
            keys = np.zeros(BANDS, np.uint64)
            for column in values.reshape(BANDS, ROWS).T:
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
            bands.append(keys.astype(np.int64).tolist())
            sketches.append((values[:SKETCH] & np.uint64(0xFF)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            names=["doc_id", "n_shingles", "digest", "bands", "sketch"])


def _least_agreement(percent: int) -> int:
    """Equal sketch bytes of a pair worth confirming: four standard deviations below the wanted similarity."""
    wanted = percent / 100
    return max(1, int(SKETCH * wanted - 4 * (SKETCH * wanted * (1 - wanted)) ** 0.5))


def _star_links(percent: int):
    """Links from members of one band bucket to leaders whose sketches are near enough."""
    least = _least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of_keys(batches, ["band", "key"]):
            starts = group_starts(table, ["band", "key"])
            ids = table.column("doc_id").to_numpy()
            sketches = table.column("sketch").to_pylist()
            left, right = [], []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2:
                    continue
                if e - s == 2:
                    left.append(ids[s])
                    right.append(ids[s + 1])
                    continue
                rows = np.frombuffer(b"".join(sketches[s:e]), np.uint8).reshape(-1, SKETCH)
                free = np.arange(e - s)
                while len(free):
                    leader = free[0]
                    near = (rows == rows[leader]).sum(axis=1) >= least
                    near[leader] = False
                    others = np.flatnonzero(near)
                    left.extend([ids[s + leader]] * len(others))
                    right.extend(ids[s + others])
                    free = free[1:]
                    free = free[~near[free]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


class _Forest:
    """Union-find whose roots are the least members."""

    def __init__(self, size: int) -> None:
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def unite(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def unite_similar(sets: list[np.ndarray], percent: int, forest: _Forest, asked: np.ndarray) -> None:
    """Unite all documents of one block whose sets are similar enough, exactly.

    Inverted lists of the block's shared shingles compare one document with all others at once. Where all are
    asked for, only documents outside the largest class need that: every pair of two classes has one.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    holders = np.repeat(np.arange(len(sets)), sizes)
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    listed, ends = holders[np.argsort(codes, kind="stable")], np.cumsum(counts)
    begins = ends - counts
    firsts = np.concatenate(([0], np.cumsum(sizes)))
    roots = np.array([forest.root(x) for x in range(len(sets))])
    todo = asked.copy()
    while True:
        open_ = todo & (roots != np.bincount(roots).argmax()) if asked.all() else todo
        if not open_.any() or (roots == roots[0]).all():
            return
        i = int(np.flatnonzero(open_)[0])
        todo[i] = False
        own = codes[firsts[i] : firsts[i + 1]]
        own = own[counts[own] > 1]
        if not len(own):
            continue
        shared = np.zeros(len(sets), np.int64)
        # A slice of the lists at a time: long documents with many holders would gather too much at once.
        for part in np.split(own, np.flatnonzero(np.diff(np.cumsum(counts[own]) // _GATHERED)) + 1):
            lengths = counts[part]
            at = np.repeat(begins[part] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
            shared += np.bincount(listed[at], minlength=len(sets))
        linked = np.flatnonzero((100 * shared >= percent * (sizes + sizes[i] - shared)) & (roots != roots[i]))
        for j in linked:
            forest.unite(i, int(j))
        if len(linked):
            roots = np.array([forest.root(x) for x in range(len(sets))])


def _confirmed(percent: int):
    """One block of candidate documents: (group, doc_id, block, class so far)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of_keys(batches, ["grp", "block"]):
            starts = group_starts(table, ["grp", "block"])
            ids = table.column("doc_id").to_numpy()
            texts = list(column_bytes(table.column("text")))
            known = table.column("known").to_numpy()
            asked = table.column("asked").to_numpy()
            left, right = [], []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2:
                    continue
                order = s + np.argsort(ids[s:e], kind="stable")
                forest = _Forest(e - s)
                classes: dict[int, int] = {}
                for i, row in enumerate(order):
                    forest.unite(classes.setdefault(known[row], i), i)
                before = [forest.root(i) for i in range(e - s)]
                sets = [shingle_set(texts[row], SIZE) for row in order]
                unite_similar(sets, percent, forest, asked[order])
                for i, row in enumerate(order):
                    if (root := forest.root(i)) != before[i] or root != i and known[row] != known[order[root]]:
                        left.append(ids[order[root]])
                        right.append(ids[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    wide = rows.select("grp", "block", "doc_id", "text", "known", "asked")
    return (
        wide.repartition("grp", "block").sortWithinPartitions("grp", "block")
        .mapInArrow(_confirmed(percent), "a long, b long")
    )


def _near(percent: int):
    """Whether the sketches of two documents agree well enough."""
    least = _least_agreement(percent)

    @F.arrow_udf("boolean")
    def judge(left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.bool_())
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, SKETCH) for x in (left, right))
        return pa.array((a == b).sum(axis=1) >= least)

    return judge


def _candidates(reps: DataFrame, percent: int) -> DataFrame:
    """(node, component) of documents that may be linked: a superset of the true classes.

    Every bucket links its members to its least one where their sketches agree. Only buckets with a member that
    does not agree are looked at as a whole."""
    keyed = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    busy = (
        keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("hub")).where("n > 1")
    )
    members = staged(keyed.join(busy.hint("merge"), ["band", "key"]), "members")
    sketches = reps.select("doc_id", "sketch")
    pairs = members.where("doc_id > hub and n <= %d" % BUCKET).select("doc_id", "hub").distinct()
    judged = staged(
        pairs.join(sketches, "doc_id")
        .join(sketches.select(F.col("doc_id").alias("hub"), F.col("sketch").alias("_sketch")), "hub")
        .select("doc_id", "hub", _near(percent)("sketch", "_sketch").alias("near")), "judged")
    near = judged.where("near").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    # Buckets too large to compare in one task: every member is linked to the least, without looking.
    large = members.where("n > %d and doc_id > hub" % BUCKET).select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    mixed = members.where("n <= %d" % BUCKET).join(judged.where("not near").select("doc_id", "hub"), ["doc_id", "hub"]).select(
        "band", "key").distinct()
    compared = (
        members.join(mixed, ["band", "key"]).join(sketches, "doc_id").select("band", "key", "doc_id", "sketch")
        .repartition("band", "key").sortWithinPartitions("band", "key", "doc_id")
        .mapInArrow(_star_links(percent), "a long, b long")
    )
    return connected(near.union(large).union(compared))


def classes(documents: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): classes of documents linked at percent / 100 or more."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digested = staged(
        texts.mapInArrow(_digests, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary"),
        "signatures")
    filled = digested.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    # Rows of one set and rows of one id are the same thing to every later step.
    same_set = staged(filled.groupBy("digest").agg(F.min("doc_id").alias("rep")), "representatives")
    reps = staged(
        filled.join(same_set.select(F.col("rep").alias("doc_id"), F.col("digest").alias("_digest")), "doc_id")
        .where(F.col("digest") == F.col("_digest")).dropDuplicates(["doc_id", "digest"])
        .select("doc_id", "n_shingles", "bands", "sketch"), "sketches")
    groups = staged(_candidates(reps, percent).withColumnRenamed("node", "doc_id")
                    .withColumnRenamed("component", "grp"), "groups")
    # Full sets of candidates only. A group is dealt over blocks of about BLOCK documents or HELD shingles by a hash
    # of the id.
    sizes = reps.groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles"))
    counts = groups.join(sizes, "doc_id").groupBy("grp").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / HELD)).cast("int").alias("blocks"))
    placed = groups.join(counts, "grp").withColumn(
        "block", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)"))
    held = staged(texts.join(placed.hint("merge"), "doc_id").select("grp", "block", "blocks", "doc_id", "text"), "candidates")
    alone = held.withColumn("known", F.col("doc_id")).withColumn("asked", F.lit(True))
    links = staged(_in_blocks(alone, percent), "links")
    split = held.where("blocks > 1").select("grp", "blocks", "block", "doc_id")
    if not split.isEmpty():
        links = _across(held, links, percent)
    by_set = same_set.select("digest", F.col("rep").alias("node"))
    component = connected(links)
    labelled = by_set.join(component, "node", "left").select("digest", F.coalesce("component", "node").alias("_class"))
    # One id with several texts ties their classes together.
    joined = digested.join(labelled, "digest", "left")
    return joined.select(
        "doc_id", "n_shingles",
        F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("_class")), F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _across(held: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links between blocks of one group, until no pair of different classes is left unseen.

    First the least documents of each block's classes meet in one block, which unites what is plainly one
    class. Then every document outside its group's largest class meets every block."""
    large = held.where("blocks > 1")
    found = connected(links)

    def with_class(rows: DataFrame, known: DataFrame) -> DataFrame:
        named = known.select(F.col("node").alias("doc_id"), F.col("component").alias("_class"))
        return rows.join(named, "doc_id", "left").withColumn("known", F.coalesce("_class", "doc_id")).drop("_class")

    leaders = (
        with_class(large, found).groupBy("grp", "block", "known").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"))
        .where("n > 1").select("grp", "doc_id")
    )
    meeting = (
        large.join(leaders, ["grp", "doc_id"]).withColumn("asked", F.lit(True)).withColumn("known", F.col("doc_id"))
        # One block of leaders for each BLOCK of them.
        .withColumn("block", F.expr(f"cast(-1 - pmod(xxhash64(doc_id), ceil(blocks / {BLOCK})) as int)"))
    )
    links = staged(links.union(_in_blocks(meeting, percent)), "links")
    found = connected(links)
    classed = staged(with_class(large, found), "classed")
    totals = classed.groupBy("grp", "known").agg(F.count(F.lit(1)).alias("n"))
    largest = totals.groupBy("grp").agg(F.max_by("known", F.struct("n", -F.col("known"))).alias("most"))
    rest = classed.join(largest, "grp").where("known <> most").drop("most")
    # A document outside visits every block; many of them come in turns of about BLOCK, each with a copy of the block.
    turns = rest.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("turns"))
    visits = rest.join(turns, "grp").select(
        "grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"), F.col("block").alias("home"),
        F.expr("cast(pmod(xxhash64(doc_id, 1), turns) as int)").alias("turn"), "doc_id", "text", "known",
        F.lit(True).alias("asked")).where("at <> home").drop("home")
    homes = classed.join(turns, "grp").select(
        "grp", F.col("block").alias("at"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"),
        "doc_id", "text", "known", F.lit(False).alias("asked"))
    met = homes.unionByName(visits).withColumn("block", F.col("at").cast("long") * (1 << 32) + F.col("turn"))
    return staged(links.union(_in_blocks(met, percent)), "links")


def one_of_each(documents: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each class, the one with the least id, with its own columns. Rows without an id stay."""
    kept = classes(documents, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    # A document's own columns travel in one, so that no name clashes.
    own = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_own")
    whole = documents.select(F.col("doc_id").cast("long").alias("_id"), own)
    left = whole.join(kept, "_id").dropDuplicates(["_id"]).select("_own.*")
    return left.unionByName(documents.where(F.col("doc_id").isNull()))
