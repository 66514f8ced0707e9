"""Dataset selections used by the workflows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.operators.reports import active

SCOPES = {"all": None, "successful": "SUCCESS", "failed": "FAILED", "pending": "PENDING"}


def first_by_id(df: DataFrame, limit: int | None) -> DataFrame:
    """The first rows in dataset order. ``None`` means all; the order then costs nothing."""
    return df if limit is None else df.orderBy(F.asc_nulls_last("dataset_id")).limit(limit)


def of_campaign(datasets: DataFrame, campaign: str | None, status: str) -> DataFrame:
    rows = active(datasets).filter(F.col("publication_status") == status)
    return rows if campaign is None else rows.filter(F.col("campaign") == campaign)


def pending(datasets: DataFrame, campaign: str | None, limit: int | None = None) -> DataFrame:
    """Pending datasets. A limit of 0 means no limit here."""
    return first_by_id(of_campaign(datasets, campaign, "PENDING"), limit or None).select("dataset_id", "mapfile")


def claimable(
    datasets: DataFrame, campaign: str | None, limit: int | None = None, exclude: DataFrame | None = None
) -> DataFrame:
    """Pending datasets nobody holds, without excluded ids."""
    rows = of_campaign(datasets, campaign, "PENDING").filter(F.col("publication_claim_id").isNull())
    if exclude is not None:
        rows = rows.join(exclude.select("dataset_id"), "dataset_id", "left_anti")
    return first_by_id(rows, limit).select("dataset_id", "mapfile", "publication_status")


def failed(datasets: DataFrame, campaign: str | None, limit: int | None = None) -> DataFrame:
    return first_by_id(of_campaign(datasets, campaign, "FAILED"), limit).select(
        "dataset_id", "mapfile", "publication_status"
    )


def archivable(datasets: DataFrame, campaign: str | None = None, limit: int | None = None) -> DataFrame:
    rows = of_campaign(datasets, campaign, "SUCCESS").filter(F.col("archive_status") == "PENDING")
    return first_by_id(rows, limit).select("dataset_id", "campaign", "mapfile", "mapfile_checksum", "archive_status")


def reconcile_scope(
    datasets: DataFrame, campaign: str | None = None, scope: str = "all",
    limit: int | None = None, ids: DataFrame | None = None,
) -> DataFrame:
    """Active datasets to compare with the remote catalog."""
    if scope not in SCOPES:
        raise ValueError(f"Unknown STAC reconciliation scope: {scope}")
    rows = active(datasets)
    if campaign is not None:
        rows = rows.filter(F.col("campaign") == campaign)
    if SCOPES[scope] is not None:
        rows = rows.filter(F.col("publication_status") == SCOPES[scope])
    if ids is not None:
        rows = rows.join(ids.select("dataset_id"), "dataset_id", "left_semi")
    return first_by_id(rows, limit).select("dataset_id", "campaign", "project", "publication_status")


def campaign_lookup(campaigns: DataFrame, name: str) -> DataFrame:
    """One campaign by name; an unknown name is an error when the frame runs."""
    found = campaigns.filter(F.col("name") == name)
    one = found.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") == 0, F.raise_error(F.lit(f"Unknown campaign: {name}"))).cast("string").alias("problem")
    )
    return found.unionByName(one.filter(F.col("problem").isNotNull()).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in campaigns.schema.fields]
    ))


def campaign_list(campaigns: DataFrame) -> DataFrame:
    return campaigns.select("name", "project", "activity", "institution", "mapfile_root")


def expired(datasets: DataFrame, now: dt.datetime, timeout_seconds: int, campaign: str | None = None) -> DataFrame:
    """Pending datasets whose claim is older than the lease."""
    cutoff = now - dt.timedelta(seconds=timeout_seconds)
    return of_campaign(datasets, campaign, "PENDING").filter(
        F.col("publication_claimed_at") < F.lit(cutoff).cast("timestamp_ntz")
    )
