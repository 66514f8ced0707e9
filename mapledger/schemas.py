"""Fixed schemas and state domains of the catalog tables.

Nothing in the library infers a schema: readers and table builders use these.
Timestamps carry no zone, as in the catalog itself.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()


def _schema(required: str = "", **fields: T.DataType) -> T.StructType:
    not_null = set(required.split())
    return T.StructType([T.StructField(n, t, n not in not_null) for n, t in fields.items()])


# Names and columns of the catalog tables.
CAMPAIGNS = _schema(
    "name project activity institution mapfile_root",
    name=_S, project=_S, activity=_S, institution=_S, mapfile_root=_S,
    archive_root=_S, archive_depth=_S,
)

DATASETS = _schema(
    "dataset_id campaign project activity institution mapfile registration_status "
    "publication_status archive_status stac_status",
    dataset_id=_S, campaign=_S, project=_S, activity=_S, institution=_S, drs=_S,
    mapfile=_S, mapfile_checksum=_S, registration_status=_S, retired_at=_TS,
    publication_status=_S, publication_claim_id=_S, publication_claimed_at=_TS,
    archive_status=_S, archive_completed_at=_TS,
    stac_status=_S, stac_checked_at=_TS, stac_http_status=_I, registered_at=_TS,
)

FILES = _schema(
    "dataset_id file_path",
    dataset_id=_S, file_path=_S, file_size=_L, checksum=_S, mod_time=_S,
)

ATTEMPTS = _schema(
    "attempt_id",
    attempt_id=_S, dataset_id=_S, run_id=_S, started_at=_TS, finished_at=_TS,
    status=_S, exit_code=_I, log_file=_S, error_message=_S,
)

DIAGNOSTICS = _schema(
    "diagnostic_id diagnostic_run_id dataset_id campaign outcome",
    diagnostic_id=_S, diagnostic_run_id=_S, dataset_id=_S, campaign=_S,
    started_at=_TS, finished_at=_TS, outcome=_S, publisher_status=_S, exit_code=_I,
    http_status=_I, error_type=_S, schema_url=_S, rejected_value=_S,
    suggested_value=_S, summary=_S, server_instance=_S, log_file=_S, stac_file=_S,
)

ARCHIVE_TASKS = _schema(
    "task_id dataset_id campaign mapfile_checksum source_mapfile archive_path created_at status",
    task_id=_S, dataset_id=_S, campaign=_S, mapfile_checksum=_S, source_mapfile=_S,
    archive_path=_S, created_at=_TS, completed_at=_TS, status=_S, error_message=_S,
)

CHECKS = _schema(
    "check_id run_id dataset_id campaign collection_id item_id request_url started_at "
    "finished_at outcome publication_status",
    check_id=_S, run_id=_S, dataset_id=_S, campaign=_S, collection_id=_S, item_id=_S,
    request_url=_S, started_at=_TS, finished_at=_TS, outcome=_S, publication_status=_S,
    http_status=_I, response_item_id=_S, response_collection=_S, response_hash=_S,
    error_message=_S,
)

RESPONSES = _schema(
    "collection_id item_id attempt_no",
    collection_id=_S, item_id=_S, attempt_no=_I, http_status=_I, body=_S, error=_S,
)

TABLES = {
    "campaigns": CAMPAIGNS,
    "datasets": DATASETS,
    "files": FILES,
    "publication_attempts": ATTEMPTS,
    "diagnostic_attempts": DIAGNOSTICS,
    "archive_tasks": ARCHIVE_TASKS,
    "stac_reconciliation_attempts": CHECKS,
}

PRIMARY_KEYS = {
    "campaigns": ("name",),
    "datasets": ("dataset_id",),
    "files": ("dataset_id", "file_path"),
    "publication_attempts": ("attempt_id",),
    "diagnostic_attempts": ("diagnostic_id",),
    "archive_tasks": ("task_id",),
    "stac_reconciliation_attempts": ("check_id",),
}

# The state domains of the catalog.
REGISTRATION_STATES = ("ACTIVE", "RETIRED")
PUBLICATION_STATES = ("PENDING", "SUCCESS", "FAILED")
ARCHIVE_STATES = ("PENDING", "SUCCESS")
STAC_STATES = ("UNCHECKED", "WAITING", "PRESENT", "ABSENT", "MISMATCH", "ERROR")
TASK_STATES = ("PENDING", "SUCCESS", "ALREADY_EXISTS", "CONFLICT", "FAILED")

# The ordered identifier components when no vocabulary is supplied.
DRS_FIELDS = (
    "project", "activity", "institution", "source", "experiment",
    "member", "table", "variable", "grid", "version",
)

# Column order of the exported reports.
STATUS_FIELDS = (
    "dataset_id", "campaign", "publication_status", "last_attempt_status",
    "finished_at", "log_file",
)
SUMMARY_FIELDS = ("campaign", "total", "published", "failed", "pending")
FAILURE_FIELDS = (
    "dataset_id", "campaign", "run_id", "started_at", "finished_at", "status",
    "exit_code", "log_file", "error_message",
)
CAMPAIGN_RECORD_FIELDS = (
    "campaign", "project", "activity", "institution", "total", "published",
    "failed", "pending",
)
DRIFT_FIELDS = (
    "classification", "outcome", "publication_status", "dataset_id", "campaign",
    "collection_id", "item_id", "http_status", "request_url", "checked_at",
    "error_message",
)
TASK_FIELDS = ("task_id", "dataset_id", "mapfile", "mapfile_checksum", "archive_path")
RESULT_FIELDS = (
    "dataset_id", "task_id", "mapfile", "mapfile_checksum", "archive_path",
    "status", "error_message",
)
