"""Catalog updates as changes of a keyed state: each reads the rows it may touch and returns those that change."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger import schemas
from mapledger.operators import publication, registration, selections
from mapledger.session import cut_lineage
from mapledger.sinks.keyed_state import CATALOG, Change, KeyedState, Reader, Table, changed_rows

_KEY = schemas.PRIMARY_KEYS["datasets"]

#: The last streamed status of each dataset, so that lines that come late change nothing.
MARKS = Table(("dataset_id",), T.StructType([
    T.StructField("dataset_id", T.StringType(), False), T.StructField("run_id", T.StringType()),
    T.StructField("line_no", T.LongType()), T.StructField("match_no", T.IntegerType()), T.StructField("status", T.StringType())]))

#: The catalog's tables and the marks of a streamed log.
STREAMED = {**CATALOG, "status_marks": MARKS}


def claim(
    run_id: str, now: dt.datetime, campaign: str | None = None, limit: int | None = None, timeout_seconds: int | None = None,
    exclude: DataFrame | None = None,
) -> Change:
    """A run claims its datasets, and closes the attempts of claims that ran out."""

    def change(read: Reader) -> dict[str, DataFrame]:
        # Claims and releases touch pending datasets only.
        held = selections.of_campaign(read("datasets"), campaign, "PENDING")
        after = publication.claim(held, run_id, now, campaign, limit, exclude, timeout_seconds)
        out = {"datasets": changed_rows(held, after, _KEY)}
        if timeout_seconds is not None:
            running = publication.expired_attempts(
                read("publication_attempts"), held, now, timeout_seconds, campaign).select(*schemas.ATTEMPTS.names)
            out["publication_attempts"] = publication.abandon_attempts(running, held, now, timeout_seconds, campaign)
        return out

    return change


def apply_outcomes(outcomes: DataFrame, now: dt.datetime) -> Change:
    """Final results of batches reach their datasets, deferred ones lose their claim, attempts are closed."""

    def change(read: Reader) -> dict[str, DataFrame]:
        datasets = read("datasets", outcomes.select("dataset_id"))
        released = outcomes.where("clears_claim AND new_status IS NULL").select("dataset_id", F.col("run_id").alias("claim_id"))
        after = publication.apply_results(
            publication.clear_claims(datasets, released), publication.final_results(outcomes))
        attempts = publication.attempts_of_outcomes(publication.last_outcomes(outcomes), now)
        return {"datasets": changed_rows(datasets, after, _KEY), "publication_attempts": attempts}

    return change


def register(changes: DataFrame, now: dt.datetime) -> Change:
    """Registered mapfiles: only datasets that are new or differ are written."""

    def change(read: Reader) -> dict[str, DataFrame]:
        held = read("datasets", changes.select("dataset_id"))
        return {"datasets": changed_rows(held, registration.register_upsert(held, changes, now), _KEY)}

    return change


def retry_failed(campaign: str | None = None, limit: int | None = None) -> Change:
    def change(read: Reader) -> dict[str, DataFrame]:
        held = selections.of_campaign(read("datasets"), campaign, "FAILED")
        return {"datasets": changed_rows(held, publication.retry_failed(held, campaign, limit), _KEY)}

    return change


def remove(ids: DataFrame) -> Change:
    """Datasets that leave the catalog, with their files."""

    def change(read: Reader) -> dict[str, DataFrame]:
        return {
            table: read(table).join(ids.select("dataset_id").distinct(), "dataset_id", "left_semi").withColumn("_deleted", F.lit(True))
            for table in ("datasets", "files")}

    return change


def status_updates(
    state: KeyedState, members: DataFrame, now: dt.datetime, name: str
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer: reported statuses of a micro-batch reach the datasets of the state.

    ``members`` (run_id, pos, dataset_id) says what each run publishes. A micro-batch is one commit under the name of
    the stream and its batch id, so a replay is found and left out. Of a dataset's statuses the one of the last run, line
    and match wins, whichever micro-batch brings it.
    """
    known = publication.aliases(members, ["run_id"])
    place = ("run_id", "line_no", "match_no")
    order = F.struct(*place)

    def write(lines: DataFrame, batch_id: int) -> None:
        told = publication.reported_statuses(lines, ["run_id"]).join(known, ["run_id", "emitted_id"])
        newest = cut_lineage(told.groupBy("dataset_id").agg(F.max(F.struct(*place, "status")).alias("_m")).select("dataset_id", "_m.*"))

        def change(read: Reader) -> dict[str, DataFrame]:
            seen = read("status_marks", newest).select("dataset_id", order.alias("_seen"))
            fresh = newest.join(seen, "dataset_id", "left").where(F.col("_seen").isNull() | (F.col("_seen") < order))
            datasets = read("datasets", newest).join(fresh.select("dataset_id"), "dataset_id", "left_semi")
            return {
                "datasets": publication.apply_results(datasets, fresh.select("dataset_id", "status")),
                "status_marks": fresh.select(*[f.name for f in MARKS.schema.fields])}

        state.update(change, now, job=f"{name}:{batch_id}")

    return write


def follow_log(
    lines: DataFrame, state: KeyedState, members: DataFrame, now: dt.datetime, name: str, checkpoint: str
):
    """Start the stream that keeps dataset state in step with publisher logs (run_id, line_no, line)."""
    return lines.writeStream.foreachBatch(status_updates(state, members, now, name)).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
