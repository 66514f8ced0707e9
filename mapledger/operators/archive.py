"""Archive tasks: planning, execution decision, import of results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import ids
from mapledger.operators import selections
from mapledger.operators.publication import updated
from mapledger.operators.specs import Spec, with_components

# Counters of an import and of an execution run.
IMPORT_LABELS = (
    "SUCCESS", "ALREADY_EXISTS", "CONFLICT", "FAILED", "UNKNOWN_DATASET", "INVALID_TASK", "UNKNOWN",
)
RUN_LABELS = ("WOULD_ARCHIVE", "SUCCESS", "ALREADY_EXISTS", "CONFLICT", "FAILED")


def with_paths(datasets: DataFrame, campaigns: DataFrame, names: Spec) -> DataFrame:
    """Datasets (dataset_id, campaign, mapfile, ...) with archive_path and path_error; the names of a campaign's
    project count where ``names`` is a table (project, names)."""
    c = campaigns.select(
        F.col("name").alias("campaign"), F.col("project").alias("_project"), F.col("activity").alias("_activity"),
        F.col("institution").alias("_institution"), "archive_root", "archive_depth",
    )
    j, own, missing = with_components(datasets.join(c, "campaign", "left"), names, "_project")
    path, error = ids.archive_destination(
        F.col("dataset_id"), F.col("mapfile"), F.col("_project"), F.col("_activity"), F.col("_institution"),
        F.col("archive_root"), F.col("archive_depth"), own, F.col("_parts"),
    )
    return j.select(
        *datasets.columns, F.when(missing.isNull(), path).alias("archive_path"), F.coalesce(missing, error).alias("path_error"))


def blockers(checks: DataFrame) -> DataFrame:
    """Checks that stand in the way of archiving."""
    return checks.filter(F.col("outcome") != "PRESENT")


def blocker_counts(checks: DataFrame) -> DataFrame:
    """Per campaign and outcome: number of blocking datasets and the first of them."""
    return blockers(checks).groupBy("campaign", "outcome").agg(
        F.count(F.lit(1)).alias("n"), F.min("dataset_id").alias("first_dataset")
    )


def blocker_examples(checks: DataFrame, campaign: str | None = None, limit: int = 5) -> DataFrame:
    rows = blockers(checks)
    if campaign is not None:
        rows = rows.filter(F.col("campaign") == campaign)
    return rows.orderBy(F.asc_nulls_last("dataset_id")).limit(limit).select("dataset_id", "outcome")


def planned_tasks(
    datasets: DataFrame, campaigns: DataFrame, names: Spec, now: dt.datetime,
    checks: DataFrame | None = None, fingerprints: DataFrame | None = None,
    campaign: str | None = None, limit: int | None = None, id_expr: Column | None = None,
) -> DataFrame:
    """Tasks for archivable datasets, as catalog rows plus ``problem``.

    With checks, a campaign with any blocker gets no task at all; a dataset without a check
    blocks too. A dataset without an archive path keeps its row with the reason, so the caller
    can refuse the whole set (``unless_refused``).
    """
    rows = selections.archivable(datasets, campaign, limit)
    if checks is not None:
        # Only datasets about to be archived can block; one row per blocked campaign.
        outcomes = checks.select("dataset_id", F.col("outcome").alias("_outcome"))
        missing_or_bad = ~F.coalesce(F.col("_outcome") == "PRESENT", F.lit(False))
        blocked = rows.join(outcomes, "dataset_id", "left").filter(missing_or_bad).select("campaign").distinct()
        rows = rows.join(blocked, "campaign", "left_anti")
    checksum = F.col("mapfile_checksum")
    if fingerprints is not None:
        rows = rows.join(fingerprints.select("mapfile", F.col("mapfile_checksum").alias("_late")), "mapfile", "left")
        checksum = F.coalesce(checksum, F.col("_late"))
    rows = with_paths(rows, campaigns, names)
    default_id = F.sha2(F.concat_ws("|", "dataset_id", "mapfile", F.coalesce(checksum, F.lit(""))), 256)
    return rows.select(
        (default_id if id_expr is None else id_expr).alias("task_id"), "dataset_id", "campaign",
        checksum.alias("mapfile_checksum"), F.col("mapfile").alias("source_mapfile"), "archive_path",
        F.lit(now).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit("PENDING").alias("status"), F.lit(None).cast("string").alias("error_message"),
        F.col("path_error").alias("problem"),
    )


def task_file(tasks: DataFrame) -> DataFrame:
    """Task rows in the columns handed to the archiving site."""
    return tasks.withColumnRenamed("source_mapfile", "mapfile").select(*schemas.TASK_FIELDS)


def execution_decisions(tasks: DataFrame, hashes: DataFrame) -> DataFrame:
    """What running each task would do, from an inventory of content hashes (path, sha256)."""
    source = hashes.select(F.col("path").alias("mapfile"), F.col("sha256").alias("_source"))
    target = hashes.select(F.col("path").alias("archive_path"), F.col("sha256").alias("_target"))
    j = tasks.join(source, "mapfile", "left").join(target, "archive_path", "left")
    gone, edited = F.col("_source").isNull(), F.col("_source") != F.col("mapfile_checksum")
    status = (
        F.when(gone | edited, F.lit("FAILED"))
        .when(F.col("_target").isNull(), F.lit("WOULD_ARCHIVE"))
        .when(F.col("_source") == F.col("_target"), F.lit("ALREADY_EXISTS"))
        .otherwise(F.lit("CONFLICT"))
    )
    # Message texts.
    text = (
        F.when(gone, F.concat(F.lit("Source mapfile does not exist: "), F.col("mapfile")))
        .when(edited, F.lit("Source mapfile checksum differs from generated task"))
        .when(status == "CONFLICT", F.lit("Destination exists but differs from source"))
        .otherwise(F.lit(""))
    )
    return j.withColumn("status", status).withColumn("error_message", text).select(*schemas.RESULT_FIELDS)


def _label_rows(spark: SparkSession, labels: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "label_no int, label string")


def _fixed_counts(rows: DataFrame, column: str, labels: tuple[str, ...]) -> DataFrame:
    """Counts per label with zeros kept, in label order."""
    counted = rows.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return _label_rows(rows.sparkSession, labels).join(counted, "label", "left").select(
        "label", F.coalesce("n", F.lit(0)).alias("n")
    )


def execution_counts(decisions: DataFrame) -> DataFrame:
    return _fixed_counts(decisions, "status", RUN_LABELS)


def matched_results(results: DataFrame, tasks: DataFrame) -> DataFrame:
    """Result rows with whether they name an existing task and agree with it."""
    t = tasks.select(
        "task_id", F.struct("dataset_id", "mapfile_checksum", "archive_path").alias("_task")
    )
    j = results.join(t, "task_id", "left")
    same = F.struct("dataset_id", "mapfile_checksum", "archive_path") == F.col("_task")
    return j.withColumn("valid_task", F.coalesce(same, F.lit(False))).select(*results.columns, "valid_task")


def classified_results(results: DataFrame, tasks: DataFrame, datasets: DataFrame) -> DataFrame:
    """Result rows (row_no in file order) with the counter each belongs to."""
    eligible = datasets.filter(
        (F.col("registration_status") == "ACTIVE") & (F.col("publication_status") == "SUCCESS")
    ).select("dataset_id", F.lit(True).alias("_known"))
    j = matched_results(results, tasks).join(eligible, "dataset_id", "left")
    status = F.col("status")
    label = (
        F.when(~F.col("valid_task"), F.lit("INVALID_TASK"))
        .when(status.isin("SUCCESS", "ALREADY_EXISTS") & F.col("_known").isNull(), F.lit("UNKNOWN_DATASET"))
        .when(status.isin("SUCCESS", "ALREADY_EXISTS", "CONFLICT", "FAILED"), status)
        .otherwise(F.lit("UNKNOWN"))
    )
    return j.withColumn("label", label).select(*results.columns, "label")


def import_counts(classified: DataFrame) -> DataFrame:
    return _fixed_counts(classified, "label", IMPORT_LABELS)


def last_task_results(classified: DataFrame) -> DataFrame:
    """The row that decides each task: the last one in file order that changes it."""
    moving = classified.filter(
        (F.col("label") != "INVALID_TASK") & F.col("status").isin("SUCCESS", "ALREADY_EXISTS", "CONFLICT", "FAILED")
    )
    return moving.groupBy("task_id").agg(
        F.max_by(F.struct("status", "error_message"), F.col("row_no")).alias("_r")
    ).select("task_id", "_r.status", "_r.error_message")


def import_into_tasks(tasks: DataFrame, classified: DataFrame, now: dt.datetime) -> DataFrame:
    """Task state after an import."""
    r = last_task_results(classified).select("task_id", F.struct("status", "error_message").alias("_r"))
    j = tasks.join(r, "task_id", "left").select(*tasks.columns, "_r")
    hit = F.col("_r").isNotNull()
    return updated(j, {
        "status": F.when(hit, F.col("_r.status")).otherwise(F.col("status")),
        "completed_at": F.when(hit, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("completed_at")),
        "error_message": F.when(hit, F.col("_r.error_message")).otherwise(F.col("error_message")),
    }, drop=("_r",))


def import_into_datasets(datasets: DataFrame, classified: DataFrame, now: dt.datetime) -> DataFrame:
    """Dataset state after an import."""
    done = classified.filter(F.col("label").isin("SUCCESS", "ALREADY_EXISTS")).select("dataset_id").distinct()
    j = datasets.join(done.withColumn("_done", F.lit(True)), "dataset_id", "left").select(*datasets.columns, "_done")
    hit = F.col("_done").isNotNull()
    return updated(j, {
        "archive_status": F.when(hit, F.lit("SUCCESS")).otherwise(F.col("archive_status")),
        "archive_completed_at": F.when(hit, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("archive_completed_at")),
    }, drop=("_done",))


def unless_refused(tasks: DataFrame) -> DataFrame:
    """The tasks, or none of them where any has a problem; the other side of the join is one row at most."""
    gate = tasks.filter(F.col("problem").isNotNull()).limit(1).select(F.lit(0).alias("_gate"))
    return tasks.withColumn("_gate", F.lit(0)).join(F.broadcast(gate), "_gate", "left_anti").drop("_gate", "problem")
