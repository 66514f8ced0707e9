"""The catalog's workflows as compositions of operators.

Each function returns the frames a caller writes. What several of them share is written once to the
shared checkpoint folder while the plan is built (`cut_lineage`); nothing else runs here."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.operators import (
    archive, batching, publication, reconcile, registration, reports, restore, selections, sync,
)
from mapledger.operators.specs import Spec
from mapledger.session import cut_lineage


@dataclass(frozen=True)
class Registration:
    datasets: DataFrame
    files: DataFrame
    rejected: DataFrame
    summary: DataFrame


def register(
    datasets: DataFrame, files: DataFrame, lines: DataFrame, fingerprints: DataFrame, campaign_roots: DataFrame,
    names: Spec, now: dt.datetime, include_files: bool = False, allow_empty: bool = False,
    scanned: DataFrame | None = None,
) -> Registration:
    """Mapfile lines to new dataset and file state.

    ``scanned`` (column campaign) names the campaigns that were scanned, empty scans included.
    The changes are written to the shared checkpoint folder once, and everything else reads them there."""
    scan = registration.scan_mapfiles(lines, include_files)
    changes = registration.registration_changes(scan, fingerprints, campaign_roots, names)
    if include_files:
        changes = changes.join(registration.repeated_paths(lines), "mapfile", "left").select(
            *[F.coalesce("error", "repeat_error").alias(c) if c == "error" else F.col(c) for c in changes.columns]
        )
    changes = cut_lineage(changes)
    good = changes.filter(F.col("error").isNull()).drop("error")
    state = registration.register_upsert(datasets, good, now)
    state = registration.retire(
        state, good.select("campaign", "dataset_id"), registration.scan_totals(changes, scanned), now, allow_empty
    )
    new_files = files
    if include_files:
        new_files = registration.replace_files(files, registration.file_rows(lines, registration.last_mapfiles(good)))
    rejected = changes.filter(F.col("error").isNotNull()).select("mapfile", "campaign", "error")
    return Registration(
        state, new_files, rejected, registration.registration_summary(datasets, changes, scanned, allow_empty)
    )


@dataclass(frozen=True)
class PublicationPlan:
    datasets: DataFrame
    attempts: DataFrame
    batches: DataFrame


def plan_publication(
    datasets: DataFrame, attempts: DataFrame, run_id: str, now: dt.datetime, campaign: str | None = None,
    limit: int | None = None, batch_size: int = 50, claim_timeout_seconds: int = 3600,
) -> PublicationPlan:
    """Release stale claims, claim pending datasets, open an attempt for each and number their batches."""
    history = publication.abandon_attempts(attempts, datasets, now, claim_timeout_seconds, campaign)
    state = publication.claim(datasets, run_id, now, campaign, limit, timeout_seconds=claim_timeout_seconds)
    state = cut_lineage(state)
    mine = state.filter(F.col("publication_claim_id") == run_id).select("campaign", "dataset_id", "mapfile")
    started = publication.new_attempts(mine.withColumn("run_id", F.lit(run_id)), now)
    return PublicationPlan(state, history.unionByName(started), batching.batch_plan(mine, batch_size))


@dataclass(frozen=True)
class PublicationResult:
    datasets: DataFrame
    new_attempts: DataFrame
    outcomes: DataFrame
    summary: DataFrame


def finish_publication(
    datasets: DataFrame, members: DataFrame, runs: DataFrame, log: DataFrame, now: dt.datetime,
    record_missing: bool = True, timeout_seconds: int = 600, attempts: DataFrame | None = None,
) -> PublicationResult:
    """Publisher output to outcomes, dataset state and history.

    With ``attempts`` the running attempts that the plan opened are closed by id, and only outcomes
    without one (unplanned members) come as new rows; without it every outcome is a new closed row."""
    outcomes = cut_lineage(publication.batch_outcomes(members, runs, log, record_missing, timeout_seconds))
    state = publication.apply_results(datasets, publication.final_results(outcomes))
    deferred = outcomes.filter(F.col("clears_claim") & F.col("new_status").isNull())
    state = publication.clear_claims(state, deferred.select("dataset_id", F.col("run_id").alias("claim_id")))
    closed = publication.attempts_of_outcomes(publication.last_outcomes(outcomes), now)
    history = closed
    if attempts is not None:
        finished = publication.finish_attempts(attempts, closed, now)
        history = finished.unionByName(closed.join(attempts.select("attempt_id"), "attempt_id", "left_anti").select(*attempts.columns))
    return PublicationResult(state, history, outcomes, publication.run_summary(outcomes))


@dataclass(frozen=True)
class Reconciliation:
    checks: DataFrame
    datasets: DataFrame
    report: DataFrame


def reconcile_catalog(
    datasets: DataFrame, attempts: DataFrame, responses: DataFrame, base_url: str, now: dt.datetime,
    campaign: str | None = None, scope: str = "all", limit: int | None = None,
) -> Reconciliation:
    chosen = selections.reconcile_scope(datasets, campaign, scope, limit)
    checks = reconcile.compare(chosen, attempts, responses, base_url, now)
    return Reconciliation(checks, reconcile.apply_checks(datasets, checks), reconcile.actionable(checks))


def plan_archive(
    datasets: DataFrame, campaigns: DataFrame, attempts: DataFrame, responses: DataFrame, base_url: str,
    names: Spec, now: dt.datetime, verify: bool = True, campaign: str | None = None, limit: int | None = None,
) -> DataFrame:
    """Archive tasks; with ``verify`` a campaign with any unconfirmed dataset gets none.

    Rows with a problem stay, so that it can be shown; ``archive.unless_refused`` gives what may be exported."""
    checks = None
    if verify:
        candidates = selections.archivable(datasets, campaign, limit).select("dataset_id")
        scope = selections.reconcile_scope(datasets, scope="successful", ids=candidates)
        checks = reconcile.compare(scope, attempts, responses, base_url, now)
    return archive.planned_tasks(datasets, campaigns, names, now, checks, campaign=campaign, limit=limit)


@dataclass(frozen=True)
class ArchiveImport:
    datasets: DataFrame
    tasks: DataFrame
    counts: DataFrame


def import_archive(datasets: DataFrame, tasks: DataFrame, results: DataFrame, now: dt.datetime) -> ArchiveImport:
    classified = archive.classified_results(results, tasks, datasets)
    return ArchiveImport(
        archive.import_into_datasets(datasets, classified, now),
        archive.import_into_tasks(tasks, classified, now),
        archive.import_counts(classified),
    )


def sync_batches(
    datasets: DataFrame, campaigns: DataFrame, attempts: DataFrame, snapshots: dict[str, DataFrame],
    max_records: int = batching.RECORDS_PER_BATCH, max_bytes: int = batching.MAX_PAYLOAD_BYTES,
    diagnostics: DataFrame | None = None,
) -> DataFrame:
    """Request bodies that bring a sheet up to date with the catalog reports, and with diagnostic rows where given.

    ``snapshots`` gives per sheet table its keys (record_no, record_id, key columns).
    """
    reports_by_table = {
        "Campaigns": reports.campaign_records(datasets, campaigns),
        "Datasets": reports.campaign_status(datasets, attempts),
        "Failures": reports.failures(datasets, attempts),
    }
    if diagnostics is not None:
        reports_by_table["Diagnostics"] = diagnostics.select(*schemas.DIAGNOSTICS.names)
    parts = []
    for table, rows in reports_by_table.items():
        key, _ = sync.TABLES[table]
        parts.append(sync.records(sync.upserts(rows, snapshots[table], key), table))
    everything = reduce(DataFrame.unionByName, parts)
    batched = batching.payload_batches(
        everything, ["table_name", "kind"], ["order_key", "record"], "n_bytes", max_records, max_bytes
    )
    return batching.request_bodies(batched, ["table_name", "kind"], "record")


@dataclass(frozen=True)
class Restore:
    problems: DataFrame
    coverage: DataFrame
    datasets: DataFrame
    new_attempts: DataFrame


def restore_catalog(
    datasets: DataFrame, attempts: DataFrame, snapshot: DataFrame, failures: DataFrame, now: dt.datetime
) -> Restore:
    """New state after a restore. Any problem (a blank, repeated or unknown id) refuses the whole restore:
    the state then stays as it is and no attempt is new."""
    problems = cut_lineage(restore.problems(snapshot, failures, datasets))
    return Restore(
        problems,
        restore.coverage(snapshot, failures, datasets),
        restore.restore_state(datasets, restore.unless(snapshot, problems), now),
        restore.new_attempts(restore.unless(failures, problems), attempts),
    )
