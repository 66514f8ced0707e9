"""Catalog checks: state domains, keys, foreign keys, and the additive upgrade."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger import schemas

DATASET_DOMAINS = {
    "registration_status": schemas.REGISTRATION_STATES,
    "publication_status": schemas.PUBLICATION_STATES,
    "archive_status": schemas.ARCHIVE_STATES,
    "stac_status": schemas.STAC_STATES,
}


def invalid_states(datasets: DataFrame, limit: int | None = None) -> DataFrame:
    """Datasets with a state outside its domain; nulls pass."""
    outside = reduce(lambda a, b: a | b, [~F.col(c).isin(*v) for c, v in DATASET_DOMAINS.items()])
    bad = datasets.filter(outside).select("dataset_id", *DATASET_DOMAINS)
    return bad if limit is None else bad.orderBy(F.asc_nulls_last("dataset_id")).limit(limit)


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per required column, the number of null values found (columns without any are left out)."""
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in required]))
    return counts.select(pairs.alias("p")).select("p.*").filter(F.col("n_null") > 0)


def orphan_datasets(datasets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Datasets whose campaign does not exist."""
    known = campaigns.select(F.col("name").alias("campaign"))
    return datasets.join(known, "campaign", "left_anti").select("dataset_id", "campaign")


def _default(column: str) -> Column | None:
    # Column defaults of an upgraded catalog.
    return {
        "registration_status": F.lit("ACTIVE"),
        "archive_status": F.lit("PENDING"),
        "stac_status": F.lit("UNCHECKED"),
    }.get(column)


def upgrade_datasets(old: DataFrame) -> DataFrame:
    """Add the columns an older datasets table lacks and fill their defaults."""
    added = (
        "mapfile_checksum", "registration_status", "retired_at", "archive_status", "stac_status",
        "stac_checked_at", "stac_http_status", "publication_claim_id", "publication_claimed_at",
    )
    kinds = {f.name: f.dataType for f in schemas.DATASETS.fields}
    out = old
    for column in added:
        current = F.col(column) if column in old.columns else F.lit(None).cast(kinds[column])
        default = _default(column)
        out = out.withColumn(column, current if default is None else F.coalesce(current, default))
    return out


def upgrade_attempts(old: DataFrame, id_expr: Column | None = None) -> DataFrame:
    """Give every attempt an id; existing ids stay."""
    fresh = F.expr("uuid()") if id_expr is None else id_expr
    current = F.col("attempt_id") if "attempt_id" in old.columns else F.lit(None).cast("string")
    return old.withColumn("attempt_id", F.coalesce(current, fresh))
