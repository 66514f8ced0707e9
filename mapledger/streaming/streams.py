"""The log and lease operators on unbounded input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.functions import logs, states


def status_stream(lines: DataFrame) -> DataFrame:
    """Reported statuses of a stream of log lines (run_id, line_no, line): stateless, any size."""
    hits = lines.filter(F.col("line").contains(logs.STATUS_MARK))
    m = hits.select("run_id", "line_no", F.posexplode(logs.status_matches(F.col("line"))).alias("match_no", "m"))
    return m.select("run_id", "line_no", "match_no", "m.status", "m.emitted_id")


def write_statuses(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer: each micro-batch owns one folder and a replay replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy("run_id", "emitted_id").agg(
            F.max(F.struct("line_no", "match_no", "status")).alias("last")
        )
        last.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def last_streamed_statuses(written: DataFrame, known: DataFrame) -> DataFrame:
    """The newest status per run and dataset from all written micro-batches.

    ``known`` maps emitted_id to dataset_id; unknown ids drop out here and stay in the files.
    """
    newest = written.groupBy("run_id", "emitted_id").agg(F.max("last").alias("last"))
    return newest.join(known, "emitted_id").select("run_id", "dataset_id", F.col("last.status").alias("status"))


def lease_stream(starts: DataFrame, finishes: DataFrame, lease_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Attempts that see no finish inside their lease, emitted as ABANDONED.

    A stream-stream outer join: both sides keep rows only as long as the lease plus the
    watermark delay, then an unmatched start is emitted and forgotten. ``starts`` has
    attempt_id, dataset_id, run_id, started_at; ``finishes`` has attempt_id, finished_at
    (both event times are timestamps).
    """
    s = starts.withWatermark("started_at", delay)
    f = finishes.select(F.col("attempt_id").alias("_id"), "finished_at").withWatermark("finished_at", delay)
    within = F.expr(
        f"_id = attempt_id and finished_at >= started_at and finished_at <= started_at + interval {int(lease_seconds)} seconds"
    )
    j = s.join(f, within, "left_outer")
    return j.filter(F.col("finished_at").isNull()).select(
        "attempt_id", "dataset_id", "run_id", "started_at", F.lit("ABANDONED").alias("status"),
        F.lit(states.LEASE_EXPIRED).alias("error_message"),
    )


def attempt_rates(attempts: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Attempts per tumbling window, campaign and status; late rows count until the watermark passes."""
    return (
        attempts.withWatermark("started_at", delay)
        .groupBy(F.window("started_at", window).alias("w"), "campaign", "status")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "campaign", "status", "n")
    )


def write_updates(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer for updated aggregates, replayable per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{path.rstrip('/')}/batch={batch_id}"
        )

    return write


def newest_updates(written: DataFrame, key: list[str], value: str) -> DataFrame:
    """The last written value per key."""
    return written.groupBy(*key).agg(F.max_by(value, "batch_id").alias(value))
