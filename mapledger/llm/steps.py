"""Shared steps: staged tables, dense row numbers, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapledger.session import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: later steps see the same rows, and a lost
    executor costs a read, not a recomputation."""
    spark = df.sparkSession
    folder = fresh_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def bucketed(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """Staged as a table bucketed by `key`: joins and groups by that column exchange their other side only."""
    spark = df.sparkSession
    folder = fresh_folder(spark, purpose)
    name = "mapledger_" + folder.rsplit("/", 1)[-1].replace("-", "_")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(parts, key).sortBy(key).option("path", folder).option("compression", "zstd").saveAsTable(name, format="parquet")
    return spark.table(name)


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): the least node reachable over undirected links, for every node that has one.

    Each round points every node at its least neighbour (a map-side combined minimum), then contracts
    the links to those targets. At least half of the linked nodes vanish in each round, so the rounds
    grow with the logarithm of the longest path; only the emptiness of the links reaches the driver.
    """
    def lower(df: DataFrame) -> DataFrame:
        return (
            df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b").distinct()
        )

    edges = staged(lower(links.select(F.col(left).alias("a"), F.col(right).alias("b"))), "links")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        target = staged(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("up"))
            .select("node", "up"), "targets",
        )
        levels.append(target)
        at_a, at_b = target.select(F.col("node").alias("a"), F.col("up").alias("ua")), target.select(
            F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = staged(
            lower(edges.join(at_a, "a").join(at_b, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b"))),
            "links",
        )
    if not levels:
        kind = links.schema[left].dataType
        return links.sparkSession.createDataFrame([], f"node {kind.simpleString()}, component {kind.simpleString()}")
    found = levels[-1].withColumnRenamed("up", "component")
    for level in reversed(levels[:-1]):
        # A target that no longer has links keeps its own name.
        found = (
            level.join(found.withColumnRenamed("node", "up"), "up", "left")
            .select("node", F.coalesce("component", "up").alias("component"))
        )
        found = staged(found, "components") if len(levels) > 3 else found
    return found
