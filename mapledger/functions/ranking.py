"""Consecutive positions inside groups of any size.

A row_number window sorts a whole group in one task. Here the rows are range
partitioned over all tasks first; each task numbers its own run, and one small
row per (task, group) carries the count of everything before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapledger.session import cut_lineage


def with_position(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    """Add the 0-based position of each row in its group, ordered by unique keys (ascending unless given as columns).

    Any single group may hold most of the rows: no task ever sees a whole group.
    The numbered rows are checkpointed, because task boundaries come from a sample.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [F.col(k).asc_nulls_first() if isinstance(k, str) else k for k in (*groups, *order)]
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # High 31 bits: the task; low 33 bits: the row inside it.
    stamped = cut_lineage(ranged.withColumn("_row", F.monotonically_increasing_id()))
    task = F.shiftright(F.col("_row"), 33)
    runs = stamped.groupBy(*groups, task.alias("_task")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    )
    # One row per (task, group): at most tasks + groups of them, whatever the data size.
    before = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    same = [F.col(f"s.{g}").eqNullSafe(F.col(f"o.{g}")) for g in groups]
    joined = stamped.withColumn("_task", task).alias("s").join(
        offsets.alias("o"), [*same, F.col("s._task") == F.col("o._task")]
    )
    position = F.col("o._before") + F.col("s._row") - F.col("o._first")
    return joined.select(*[F.col(f"s.{c}") for c in df.columns], position.alias(name))
