"""Prefix trie of conversations, rolled up in bands of depths.

A node is a distinct sequence of first turns. Its key is the exclusive or of one 128-bit value per turn (of place,
role and the text's digest), so keys come from running sums that are cut into pieces of `PIECE` turns, and no
conversation has to fit into one task. A node explodes only to its ancestors inside its band of `HEIGHT` depths.
The roots of the bands, with their band's sums, form a trie of their own that is summed in the same way; then the
complete sums of the roots go to the nodes of the band above them. A trie of depth D takes log(D) / log(HEIGHT)
such levels, each of two exchanges, and no row explodes to more than `HEIGHT` rows.

Hot nodes: sums, counts and least members are combined before every exchange. A parent with more than a thousandth of
all nodes below it is one of at most a thousand, which are broadcast; other parents join their children by key. The
sorted ends of a node are cut by range, so that they are spread over tasks, and joined to lists of `SLICE` ids there;
only these lists meet, one by one, in the running hash of the node.

Defined results: turns are ordered by `turn` (null first), then by role, then by the text's MD5; repeated rows are turns
of their own. Null roles and texts are empty. Rows without conv_id belong to no conversation. An empty table has no
nodes, not even a root. Further columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapledger.functions.ranking import with_position
from mapledger.llm.steps import staged

HEIGHT = 8
PIECE = 512
SLICE = 512
#: A parent with more than this part of all nodes as children is hot.
HOT = 1000
#: Followers take over at most this many turns.
HEAD = 3
NODE = "struct<a: bigint, b: bigint>"
WORD = r"[^\x20\x09-\x0D]+"


def _root() -> Column:
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position from 0, role, digest, words) of every turn."""
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.unhex(F.md5(text)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return with_position(turns, ["conv_id"], ["turn", "role", "digest"]).drop("turn")


def own_paths(turns: DataFrame) -> DataFrame:
    """The steps of conversations as they are, for `trie`."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    return _at_pieces(turns, sizes).select(
        "conv_id", (F.col("position") + 1).alias("place"), "role", "digest", "words",
        (F.col("position") + 1 == F.col("n")).alias("is_last"))


def _at_pieces(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Turns with the row of their conversation, which is repeated once for `PIECE` turns, so that no key is hot."""
    spread = sizes.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {PIECE}"))))
    return turns.withColumn("_piece", F.expr(f"position div {PIECE}")).join(spread, ["conv_id", "_piece"])


def rebuilt_paths(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps of the rebuilt conversations, and their ids with whether a turn is left.

    Conversation c gets the first h turns of conversation c - c % 20, then its own turns after its first h, where h is
    the unsigned crc32 of c in decimal, modulo 4."""
    turn = F.struct("position", "role", "digest", "words")
    known = staged(turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("position") < HEAD, turn))).alias("first")), "conversations")
    leaders = known.where("conv_id % 20 = 0").select(F.col("conv_id").alias("leader"), F.col("first").alias("lent"))
    heads = staged(
        known.select("conv_id", "n", F.expr("conv_id - conv_id % 20").alias("leader"),
                     (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h"))
        .join(leaders, "leader", "left")
        .withColumn("head", F.expr("slice(coalesce(lent, array()), 1, cast(h AS int))"))
        .withColumn("lent_n", F.size("head").cast("long"))
        .withColumn("length", F.expr("lent_n + greatest(n - h, 0)"))
        .select("conv_id", "n", "h", "head", "lent_n", "length"), "heads")
    borrowed = heads.select("conv_id", "length", F.posexplode("head").alias("place", "t")).select(
        "conv_id", (F.col("place") + 1).cast("long").alias("place"), "t.role", "t.digest", "t.words",
        (F.col("place") + 1 == F.col("length")).alias("is_last"))
    place = F.expr("lent_n + position + 1 - h")
    own = _at_pieces(turns, heads.drop("head")).where("position >= h").select(
        "conv_id", place.alias("place"), "role", "digest", "words", (place == F.col("length")).alias("is_last"))
    return borrowed.unionByName(own), heads.select("conv_id", (F.col("length") == 0).alias("is_empty"))


def _with_nodes(steps: DataFrame) -> DataFrame:
    """Steps with the key of their node and of its parent: (conv_id, place, node, up, words, is_last)."""
    keyed = steps.select(
        "conv_id", "place", "words", "is_last", F.expr(f"(place - 1) div {PIECE}").alias("piece"),
        F.xxhash64(F.lit(1), "place", "role", "digest").alias("x"),
        F.xxhash64(F.lit(2), "place", "role", "digest").alias("y"))
    inside = Window.partitionBy("conv_id", "piece").orderBy("place")
    local = keyed.select("*", *[F.bit_xor(c).over(inside).alias(f"to_{c}") for c in ("x", "y")])
    # One row for `PIECE` turns of a conversation carries what comes before it.
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("conv_id", "piece").agg(F.bit_xor("x").alias("all_x"), F.bit_xor("y").alias("all_y")).select(
        "conv_id", "piece",
        *[F.coalesce(F.bit_xor(f"all_{c}").over(before), F.lit(0).cast("long")).alias(f"from_{c}") for c in ("x", "y")])
    joined = local.join(starts, ["conv_id", "piece"])
    a, b = (F.col(f"to_{c}").bitwiseXOR(F.col(f"from_{c}")) for c in ("x", "y"))
    return joined.select(
        "conv_id", "place", F.struct(a.alias("a"), b.alias("b")).alias("node"),
        F.struct(a.bitwiseXOR(F.col("x")).alias("a"), b.bitwiseXOR(F.col("y")).alias("b")).alias("up"), "words", "is_last")


def _with_ups(paths: DataFrame) -> DataFrame:
    """Add `ups`: the ancestors from the last band root above a node down to its parent."""
    band = Window.partitionBy("conv_id", F.expr(f"(place - 1) div {HEIGHT}")).orderBy("place")
    return paths.withColumn("ups", F.collect_list("up").over(band.rowsBetween(Window.unboundedPreceding, 0)))


def _summed(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])


def subtree_sums(nodes: DataFrame, paths: DataFrame, sums: list[str]) -> DataFrame:
    """(node, sums over its subtree). `nodes` (node, place, ups, sums) holds every node once, the root with place 0;
    `paths` (conv_id, place, node, ups) every step of every conversation."""
    is_root = F.col("place") % HEIGHT == 0
    # The first of `ups` is a band root, and so is a node whose depth the height divides.
    inside = F.when(is_root, F.array("node")).otherwise(F.concat("ups", F.array("node")))
    band = staged(_summed(
        nodes.select(F.posexplode(inside).alias("at", "node"), *sums).withColumn("is_root", F.col("at") == 0),
        ["node", "is_root"], sums), "band-sums")
    upper_paths = staged(_with_ups(
        paths.where(is_root).select(
            "conv_id", (F.col("place") / HEIGHT).cast("long").alias("place"), "node", F.col("ups")[0].alias("up"),
            F.col("ups").alias("below"))), "band-roots")
    if upper_paths.isEmpty():
        return band.drop("is_root")
    roots = upper_paths.groupBy("node").agg(*[F.first(c).alias(c) for c in ("place", "ups", "below")])
    none = F.array().cast(f"array<{NODE}>")
    first = nodes.where("place = 0").select("node", "place", none.alias("ups"), none.alias("below"))
    upper = staged(
        roots.unionByName(first).join(band.where("is_root").drop("is_root"), "node"), "band-root-sums")
    complete = staged(subtree_sums(upper.drop("below"), upper_paths.drop("up", "below"), sums), "complete")
    # What lies below the next band's roots belongs to all of their band's nodes but its root, which is complete.
    passed = upper.select("node", "below").join(complete, "node").select(
        F.explode(F.expr("slice(below, 2, greatest(size(below) - 1, 0))")).alias("node"), *sums)
    others = _summed(band.where("NOT is_root").drop("is_root").unionByName(passed), ["node"], sums)
    return others.unionByName(complete)


def _parents(nodes: DataFrame) -> DataFrame:
    """(node, parent_conv_id) of every node but the root."""
    n = nodes.count()
    hot = nodes.where(F.col("n_children") * HOT > n).select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("place > 0").select("node", "up").join(F.broadcast(hot), "up", "left")
    rest = below.where("parent_conv_id IS NULL").drop("parent_conv_id").join(
        nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id")), "up")
    return below.where("parent_conv_id IS NOT NULL").unionByName(rest).select("node", "parent_conv_id")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order, comma-joined, up to `SLICE` of one node in a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, ids = (batch.column(i).to_numpy() for i in range(3))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        heads = np.flatnonzero(new)
        since = np.arange(len(a)) - heads[np.cumsum(new) - 1]
        starts = np.flatnonzero(new | (since % SLICE == 0))
        ends = np.append(starts[1:], len(a))
        held = ids.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[starts]), pa.array(b[starts]), pa.array(ids[starts]),
             pa.array([",".join(map(str, held[s:e])) for s, e in zip(starts, ends, strict=True)], pa.string())],
            names=["a", "b", "conv_id", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's lists, which come in order; one hash state is held from batch to batch."""
    node, state = None, None
    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
            if node != (a, b):
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digest_rows(done)
    if node is not None:
        yield _digest_rows([(*node, state.hexdigest())])


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
        names=["a", "b", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): the hash of a node's ids, ascending and comma-joined."""
    parts = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = ["a", "b", "conv_id"]
    sliced = ends.select("node.a", "node.b", "conv_id").repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    lists = sliced.mapInArrow(_lists, "a long, b long, conv_id long, ids string")
    hashed = lists.repartition("a", "b").sortWithinPartitions(*keys).mapInArrow(
        _digests, "a long, b long, ends_sha256 string")
    return hashed.select(F.struct("a", "b").alias("node"), "ends_sha256")


def trie(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    `steps` (conv_id, place from 1, role, digest, words, is_last), `conversations` (conv_id, is_empty)."""
    paths = staged(_with_ups(_with_nodes(steps)), "paths")
    found = paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        *[F.first(c).alias(c) for c in ("place", "words", "up", "ups")])
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        _root().alias("node"), "conv_id", "n_convs", F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("words"),
        F.lit(None).cast(NODE).alias("up"), F.array().cast(f"array<{NODE}>").alias("ups"))
    distinct = staged(found.unionByName(root), "distinct")
    children = distinct.where("place > 0").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(
        distinct.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "nodes")
    sums = subtree_sums(
        nodes.select("node", "place", "ups", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                     ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")),
        paths.select("conv_id", "place", "node", "ups"), ["n_leaves", "saved_tokens"])
    ends = end_digests(
        paths.where("is_last").select("node", "conv_id")
        .unionByName(conversations.where("is_empty").select(_root().alias("node"), "conv_id")))
    parts = [sums, _parents(nodes), ends]
    joined = reduce(lambda left, right: left.join(right, "node", "left"), parts, nodes.drop("up", "ups", "words"))
    return joined.select(
        "conv_id", F.col("place").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt_paths(ordered_turns(conversations)))


def own_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = ordered_turns(conversations)
    return trie(own_paths(turns), turns.select("conv_id").distinct().withColumn("is_empty", F.lit(False)))
