"""Decision tables over catalog states, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts recorded on attempts.
LEASE_EXPIRED = "Publication claim lease expired"
UNREACHED = "Publisher emitted no status for this dataset"
GRACE_TEXT = "Publication is still within the STAC ingestion grace period"
MISMATCH_TEXT = "STAC response identity or type does not match the request"
NO_RESPONSE_TEXT = "STAC request failed"
RECOVERED_TEXT = "Previously failed dataset published successfully."
NO_STATUS_TEXT = "No recognizable PUB_STATUS was emitted; see diagnostic log."


def effective_status(registration_status: Column, publication_status: Column) -> Column:
    return F.when(registration_status == "RETIRED", F.lit("RETIRED")).otherwise(publication_status)


def drift_class(publication_status: Column, outcome: Column) -> Column:
    agrees = ((publication_status == "SUCCESS") & (outcome == "PRESENT")) | (
        publication_status.isin("FAILED", "PENDING") & (outcome == "ABSENT")
    )
    return (
        F.when(outcome == "ERROR", F.lit("API_ERROR"))
        .when(outcome == "WAITING", F.lit("WAITING"))
        .when(outcome == "MISMATCH", F.lit("DRIFT"))
        .when(agrees, F.lit("CONSISTENT"))
        .otherwise(F.lit("DRIFT"))
    )


def diagnostic_outcome(publisher_status: Column, item_valid: Column, http_status: Column) -> Column:
    failed = publisher_status == "FAILED"
    return (
        F.when(publisher_status == "SUCCESS", F.lit("RECOVERED"))
        .when(failed & (F.coalesce(item_valid, F.lit(True)) == F.lit(False)), F.lit("DIAGNOSED"))
        .when(failed & http_status.isNotNull(), F.lit("DIAGNOSED"))
        .when(failed, F.lit("UNCLASSIFIED"))
        .otherwise(F.lit("EXECUTION_ERROR"))
    )


def missing_status_text(
    error_text: Column, timed_out: Column, timeout_seconds: Column, exit_code: Column, output_length: Column
) -> Column:
    """Why a batch without any status line is deferred."""
    timeout = F.concat(F.lit("esgpublish timed out after "), timeout_seconds.cast("string"), F.lit(" seconds"))
    silent = F.concat(
        F.lit("esgpublish returned no recognizable PUB_STATUS line (exit code "), exit_code.cast("string"),
        F.lit(", output length "), output_length.cast("string"), F.lit(")"),
    )
    return F.when(timed_out, timeout).when(F.coalesce(error_text, F.lit("")) != "", error_text).otherwise(silent)


def response_hash(body: Column) -> Column:
    return F.sha2(F.coalesce(body.cast("binary"), F.lit(b"")), 256)


def retention_action(status: Column, retained: Column, staged: Column) -> Column:
    """What happens to a kept item file after a publication result."""
    return (
        F.when((status == "SUCCESS") & retained, F.lit("removed"))
        .when(status == "SUCCESS", F.lit("absent"))
        .when((status == "FAILED") & staged, F.lit("retained"))
        .when(status == "FAILED", F.lit("missing"))
        .otherwise(F.lit("ignored"))
    )
