"""Reports over the catalog: latest attempts, rollups, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.functions.ranking import with_position
from mapledger.functions.states import effective_status
from mapledger.schemas import CAMPAIGN_RECORD_FIELDS, FAILURE_FIELDS


def latest_attempt(attempts: DataFrame) -> DataFrame:
    """The newest attempt of each dataset by finish, start and id, nulls last.

    A maximum over an ordering struct: each task keeps one row per dataset before
    the shuffle, so a dataset with very many attempts is no hot group. Nulls sort
    lowest in a struct, which is last in descending order.
    """
    newest = F.max(F.struct("finished_at", "started_at", "attempt_id", "status", "log_file")).alias("m")
    return attempts.groupBy("dataset_id").agg(newest).select(
        "dataset_id", F.col("m.attempt_id").alias("attempt_id"), F.col("m.status").alias("last_attempt_status"),
        F.col("m.started_at").alias("started_at"), F.col("m.finished_at").alias("finished_at"),
        F.col("m.log_file").alias("log_file"),
    )


def ranked_attempts(attempts: DataFrame) -> DataFrame:
    """Every attempt with its rank inside its dataset, newest first; a dataset may have any number."""
    newest = [F.desc_nulls_last(c) for c in ("finished_at", "started_at", "attempt_id")]
    ranked = with_position(attempts, ["dataset_id"], newest)
    return ranked.select(*attempts.columns, (F.col("position") + F.lit(1)).alias("rn"))


def campaign_status(datasets: DataFrame, attempts: DataFrame) -> DataFrame:
    """One row per dataset with its effective status and newest attempt."""
    d = datasets.select(
        "dataset_id", "campaign",
        effective_status(F.col("registration_status"), F.col("publication_status")).alias("publication_status"),
    )
    a = latest_attempt(attempts).select("dataset_id", "last_attempt_status", "finished_at", "log_file")
    return d.join(a, "dataset_id", "left").select(
        "dataset_id", "campaign", "publication_status", "last_attempt_status", "finished_at", "log_file"
    )


def by_campaign(report: DataFrame) -> DataFrame:
    """Report order: campaign, then dataset."""
    return report.orderBy(F.asc_nulls_last("campaign"), F.asc_nulls_last("dataset_id"))


def _status_counts() -> list[Column]:
    status = F.col("publication_status")
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "SUCCESS").alias("published"),
        F.count_if(status == "FAILED").alias("failed"),
        F.count_if(status == "PENDING").alias("pending"),
    ]


def active(datasets: DataFrame) -> DataFrame:
    return datasets.filter(F.col("registration_status") == "ACTIVE")


def campaign_summary(datasets: DataFrame) -> DataFrame:
    return active(datasets).groupBy("campaign").agg(*_status_counts())


def campaign_counts(datasets: DataFrame) -> DataFrame:
    return active(datasets).groupBy("campaign").agg(F.count(F.lit(1)).alias("datasets"))


def publication_counts(datasets: DataFrame) -> DataFrame:
    return active(datasets).groupBy("publication_status").agg(F.count(F.lit(1)).alias("datasets"))


def campaign_records(datasets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign rollup with descriptive columns; datasets of unknown campaigns drop out.

    The datasets are counted first, so the join sees one row per campaign.
    """
    c = campaigns.select(F.col("name").alias("campaign"), "project", "activity", "institution")
    return campaign_summary(datasets).join(c, "campaign").select(*CAMPAIGN_RECORD_FIELDS)


def failures(datasets: DataFrame, attempts: DataFrame, campaign: str | None = None) -> DataFrame:
    """Failed attempts with their campaign."""
    d = datasets.select("dataset_id", "campaign")
    if campaign:
        d = d.filter(F.col("campaign") == campaign)
    return attempts.filter(F.col("status") == "FAILED").join(d, "dataset_id").select(*FAILURE_FIELDS)


def newest_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc_nulls_last("started_at"))


def failed_publications(datasets: DataFrame) -> DataFrame:
    """Active datasets that are neither pending nor published."""
    status = F.col("publication_status")
    return active(datasets).filter((status != "PENDING") & (status != "SUCCESS")).select(
        "dataset_id", "publication_status", "mapfile"
    )


def latest_success(attempts: DataFrame) -> DataFrame:
    """Finish time of the last successful attempt; datasets without one keep a null."""
    return attempts.groupBy("dataset_id").agg(
        F.max(F.when(F.col("status") == "SUCCESS", F.col("finished_at"))).alias("latest_success")
    )


def examples(df: DataFrame, order: str, limit: int = 20) -> DataFrame:
    """The first rows by one column, each with the number of rows not shown."""
    top = df.orderBy(F.asc_nulls_last(order)).limit(limit)
    total = df.groupBy().agg(F.count(F.lit(1)).alias("_total"))
    more = F.greatest(total.scalar() - F.lit(limit), F.lit(0))
    return top.withColumn("not_shown", more)


def attempts_by_run(attempts: DataFrame) -> DataFrame:
    """Per run: results, successes and everything else."""
    done = attempts.filter(F.col("status").isin("SUCCESS", "FAILED"))
    return done.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(F.col("status") != "SUCCESS").alias("failed"),
    )
