"""Diagnostics of failed datasets: server errors, local verdicts, outcomes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import logs, states
from mapledger.functions.once import with_once
from mapledger.operators import publication


def server_errors(log: DataFrame, scope: list[str]) -> DataFrame:
    """The last structured server error of each scope, with its fields.

    Lines without the marker never meet the pattern, and each scope is reduced to
    one line before any of its JSON is read.
    """
    hit = logs.last_server_error(F.col("line"))
    lines = with_once(log.filter(F.col("line").contains(logs.SERVER_MARK)), _hit=hit).filter(F.col("_hit").isNotNull())
    last = lines.groupBy(*scope).agg(F.max_by("_hit", "line_no").alias("_hit"))
    last = last.select(*scope, F.col("_hit.status").alias("server_status"), F.col("_hit.body").alias("server_body"))
    return logs.server_fields(last).drop("server_status", "server_body")


def line_errors(log: DataFrame) -> DataFrame:
    """Structured fields of every single server error line."""
    lines = log.filter(F.col("line").contains(logs.SERVER_MARK))
    return logs.server_fields(lines, text="line").drop("server_status", "server_body")


def enum_failures(log: DataFrame) -> DataFrame:
    """Rejected value and suggestion of every line that names a rejected value."""
    hit = logs.last_server_error(F.col("line"))
    rows = with_once(log.filter(F.col("line").contains(logs.SERVER_MARK)), _body=hit["body"])
    rows = with_once(rows, _detail=F.get_json_object(F.col("_body"), "$.detail"))
    value, choices = logs.enum_parts(F.col("_detail"))
    rows = with_once(rows, _v=value, _c=choices).filter(F.col("_v").isNotNull())
    rows = logs.with_enum_verdict(rows, "_v", "_c", F.col("_body"))
    return rows.select(
        *[c for c in log.columns if c != "line"],
        F.col("_enum.rejected").alias("rejected_value"), F.col("_enum.suggested").alias("suggested_value"),
    )


def diagnose(
    datasets: DataFrame, statuses: DataFrame, errors: DataFrame, verdicts: DataFrame, run_id: str, now: dt.datetime,
    id_expr: Column | None = None,
) -> DataFrame:
    """Diagnostic rows of datasets (dataset_id, campaign).

    ``statuses``: dataset_id, status, exit_code, log_file. ``errors``: dataset_id and the
    fields of its last server error. ``verdicts``: dataset_id and its item verdict.
    """
    v = verdicts.select(
        "dataset_id", "valid", F.col("schema_url").alias("_v_schema"), F.col("rejected_value").alias("_v_rejected"),
        F.col("suggested_value").alias("_v_suggested"), F.col("summary").alias("_v_summary"),
        F.col("stac_file").alias("stac_file"),
    )
    j = (
        datasets.select("dataset_id", "campaign").join(statuses, "dataset_id", "left")
        .join(errors, "dataset_id", "left").join(v, "dataset_id", "left")
    )
    status = F.col("status")
    outcome = states.diagnostic_outcome(status, F.col("valid"), F.col("http_status"))
    local = (outcome == "DIAGNOSED") & (F.coalesce(F.col("valid"), F.lit(True)) == F.lit(False))
    server_text = F.coalesce(F.col("summary"), F.lit(logs.NO_SERVER_SUMMARY))
    summary = (
        F.when(outcome == "RECOVERED", F.lit(states.RECOVERED_TEXT))
        .when(local, F.col("_v_summary"))
        .when(outcome.isin("DIAGNOSED", "UNCLASSIFIED"), server_text)
        .otherwise(F.lit(states.NO_STATUS_TEXT))
    )
    moment = F.lit(now).cast("timestamp_ntz")
    columns = {
        "diagnostic_id": F.expr("uuid()") if id_expr is None else id_expr,
        "diagnostic_run_id": F.lit(run_id), "started_at": moment, "finished_at": moment,
        "outcome": outcome, "publisher_status": status, "exit_code": F.coalesce("exit_code", F.lit(-1)).cast("int"),
        "error_type": F.when(local, F.lit("local-stac-validation")).otherwise(F.col("error_type")),
        "schema_url": F.when(local, F.col("_v_schema")).otherwise(F.col("schema_url")),
        "rejected_value": F.when(local, F.col("_v_rejected")).otherwise(F.col("rejected_value")),
        "suggested_value": F.when(local, F.col("_v_suggested")).otherwise(F.col("suggested_value")),
        "summary": summary,
    }
    return j.select(*[columns.get(f.name, F.col(f.name)).alias(f.name) for f in schemas.DIAGNOSTICS.fields])


def diagnostic_counts(diagnostics: DataFrame) -> DataFrame:
    """Per run: selected datasets and the four outcomes."""
    outcome = F.col("outcome")
    return diagnostics.groupBy("diagnostic_run_id").agg(
        F.count(F.lit(1)).alias("selected"),
        F.count_if(outcome == "RECOVERED").alias("recovered"),
        F.count_if(outcome == "DIAGNOSED").alias("diagnosed"),
        F.count_if(outcome == "UNCLASSIFIED").alias("unclassified"),
        F.count_if(outcome == "EXECUTION_ERROR").alias("execution_errors"),
    )


def apply_diagnostics(datasets: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Dataset state after diagnostics: a recognised status counts as a publication result."""
    final = diagnostics.filter(F.col("publisher_status").isin("SUCCESS", "FAILED")).groupBy("dataset_id").agg(
        F.max_by("publisher_status", F.struct("finished_at", "diagnostic_id")).alias("status")
    )
    return publication.apply_results(datasets, final)


def diagnostic_attempts(diagnostics: DataFrame, now: dt.datetime, id_expr: Column | None = None) -> DataFrame:
    """History rows of the recognised results; a failure carries the summary as its error."""
    final = diagnostics.filter(F.col("publisher_status").isin("SUCCESS", "FAILED"))
    moment = F.lit(now).cast("timestamp_ntz")
    return final.select(
        (F.expr("uuid()") if id_expr is None else id_expr).alias("attempt_id"), "dataset_id",
        F.col("diagnostic_run_id").alias("run_id"), moment.alias("started_at"), moment.alias("finished_at"),
        F.col("publisher_status").alias("status"), "exit_code", "log_file",
        F.when(F.col("publisher_status") == "FAILED", F.col("summary")).alias("error_message"),
    )
