"""Batch numbers and size-bounded batches over inputs of any size."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.functions.ranking import with_position

# Size limits of one request.
RECORDS_PER_BATCH = 500
MAX_PAYLOAD_BYTES = 750 * 1024
ENVELOPE_BYTES = 15  # {"records": []}
SEPARATOR_BYTES = 2  # ", "

CHUNK_ROWS = 1 << 16
CHUNKS_PER_BLOCK = 1 << 10


def batch_plan(df: DataFrame, size: int, groups: Sequence[str] = ("campaign",), order: str = "dataset_id") -> DataFrame:
    """Consecutive batches of a fixed size in id order, numbered from 1 in each group."""
    if size <= 0:
        raise ValueError("batch_size must be greater than zero")
    numbered = with_position(df, groups, [order])
    return numbered.select(
        *df.columns,
        (F.floor(F.col("position") / F.lit(size)) + F.lit(1)).cast("bigint").alias("batch_no"),
        (F.col("position") % F.lit(size)).cast("bigint").alias("batch_pos"),
    )


def _next_start(sizes: np.ndarray, max_records: int, max_bytes: int) -> np.ndarray:
    """For each record, where the batch after one starting there would start."""
    n = len(sizes)
    upto = np.concatenate(([0], np.cumsum(sizes + SEPARATOR_BYTES)))
    room = max_bytes - ENVELOPE_BYTES + SEPARATOR_BYTES
    start = np.arange(n)
    by_bytes = np.searchsorted(upto, upto[:-1] + room, side="right") - 1
    return np.minimum(np.maximum(by_bytes, start + 1), start + max_records)


def _chunk_exits(sizes: np.ndarray, own: int, max_records: int, max_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Entry offset -> (offset into the next chunk, batches started), for the first records of a chunk."""
    following = _next_start(sizes, max_records, max_bytes)[:own]
    leave, started = [0] * own, [0] * own
    for i in range(own - 1, -1, -1):
        j = int(following[i])
        if j >= own:
            leave[i], started[i] = j - own, 1
        else:
            leave[i], started[i] = leave[j], started[j] + 1
    entries = min(max_records, own)
    out = np.zeros(max_records, dtype=np.int64)
    num = np.zeros(max_records, dtype=np.int64)
    out[:entries], num[:entries] = leave[:entries], started[:entries]
    # An entry past the end of a short last chunk passes through unchanged.
    out[entries:] = np.arange(entries, max_records) - own
    return out, num


def payload_batches(
    records: DataFrame, groups: Sequence[str], order: Sequence[str], size_col: str,
    max_records: int = RECORDS_PER_BATCH, max_bytes: int = MAX_PAYLOAD_BYTES,
) -> DataFrame:
    """Greedy, order-preserving batches limited by record count and request bytes.

    A batch closes when the next record would pass either limit; a record larger than
    the limit stands alone. The greedy rule is sequential, yet the result here is the
    exact sequence without any task reading a whole group: a batch reaches at most
    ``max_records`` ahead, so a chunk of consecutive records is fully described by a
    small table "entry offset -> exit offset, batches started". The tables of all
    chunks are chained in two levels, then every chunk numbers its own records.
    """
    if max_records <= 0:
        raise ValueError("batch_size must be greater than zero")
    if max_bytes <= 0:
        raise ValueError("max_payload_bytes must be greater than zero")
    chunk_rows = max(CHUNK_ROWS, max_records)
    # One text stands for the group, nulls included, so that no join below loses a group with a null key.
    keys = ["_group"]
    grouped = records.withColumn("_group", F.to_json(F.struct(*groups)) if groups else F.lit(""))
    numbered = with_position(grouped, keys, order)
    slim = numbered.select(
        *keys, F.col("position"), F.col(size_col).cast("bigint").alias("_size"),
        F.floor(F.col("position") / F.lit(chunk_rows)).cast("bigint").alias("_chunk"),
    )
    offset = F.col("position") - F.col("_chunk") * F.lit(chunk_rows)
    # The first records of a chunk also complete the batches of the chunk before it.
    ahead = slim.filter((offset < max_records) & (F.col("_chunk") > 0)).withColumn("_chunk", F.col("_chunk") - F.lit(1))
    work = slim.withColumn("_own", F.lit(True)).unionByName(ahead.withColumn("_own", F.lit(False)))
    key_schema = "`_group` string"

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position", kind="stable")
        out, num = _chunk_exits(pdf["_size"].to_numpy(np.int64), int(pdf["_own"].sum()), max_records, max_bytes)
        head = pdf.iloc[:1][[*keys, "_chunk"]].reset_index(drop=True)
        return head.assign(_exit=[out], _started=[num])

    maps = work.groupBy(*keys, "_chunk").applyInPandas(
        summarise, f"{key_schema}, _chunk bigint, _exit array<bigint>, _started array<bigint>"
    ).withColumn("_block", F.floor(F.col("_chunk") / F.lit(CHUNKS_PER_BLOCK)).cast("bigint"))

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        """Compose the chunk tables of one block into one."""
        pdf = pdf.sort_values("_chunk")
        at, total = np.arange(max_records), np.zeros(max_records, dtype=np.int64)
        for exits, started in zip(pdf["_exit"], pdf["_started"]):
            total = total + np.asarray(started)[at]
            at = np.asarray(exits)[at]
        return pdf.iloc[:1][[*keys, "_block"]].reset_index(drop=True).assign(_exit=[at], _started=[total])

    def walk(unit: str):
        """Entry offset and first batch number of each unit, following the chain from its start."""

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(unit)
            at = int(pdf["_in"].iloc[0]) if "_in" in pdf else 0
            total = int(pdf["_base"].iloc[0]) if "_base" in pdf else 0
            entry, base = [], []
            for exits, started in zip(pdf["_exit"], pdf["_started"]):
                entry.append(at)
                base.append(total)
                total += int(started[at])
                at = int(exits[at])
            return pdf[[*keys, unit]].assign(_in=entry, _base=base)

        return run

    blocks = maps.groupBy(*keys, "_block").applyInPandas(
        chain, f"{key_schema}, _block bigint, _exit array<bigint>, _started array<bigint>"
    )
    block_entry = blocks.groupBy(*keys).applyInPandas(walk("_block"), f"{key_schema}, _block bigint, _in bigint, _base bigint")
    chunk_entry = (
        maps.join(block_entry, [*keys, "_block"]).groupBy(*keys, "_block")
        .applyInPandas(walk("_chunk"), f"{key_schema}, _chunk bigint, _in bigint, _base bigint")
    )

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position", kind="stable")
        own = int(pdf["_own"].sum())
        following = _next_start(pdf["_size"].to_numpy(np.int64), max_records, max_bytes)
        at, base = int(pdf["_in"].iloc[0]), int(pdf["_base"].iloc[0])
        starts = np.zeros(own, dtype=np.int64)
        while at < own:
            starts[at] = 1
            at = int(following[at])
        mine = pdf.iloc[:own]
        return mine[[*keys, "position"]].assign(batch_no=base + np.cumsum(starts))

    batches = work.join(chunk_entry, [*keys, "_chunk"]).groupBy(*keys, "_chunk").applyInPandas(
        number, f"{key_schema}, position bigint, batch_no bigint"
    )
    return numbered.join(batches, [*keys, "position"]).select(*records.columns, "position", "batch_no")


def request_bodies(batches: DataFrame, groups: Sequence[str], record_col: str) -> DataFrame:
    """One request body per batch; a batch is bounded by the limits that formed it."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", record_col))), lambda r: r[record_col])
    return batches.groupBy(*groups, "batch_no").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.concat(F.lit('{"records": ['), F.array_join(ordered, ", "), F.lit("]}")).alias("body"),
    ).withColumn("n_bytes", F.octet_length("body").cast("bigint"))
