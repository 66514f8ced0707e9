"""Upsert differences between catalog reports and a sheet's records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions.text import json_object

TABLES = {
    "Campaigns": (("campaign",), schemas.CAMPAIGN_RECORD_FIELDS),
    "Datasets": (("dataset_id",), schemas.STATUS_FIELDS),
    "Failures": (("dataset_id", "run_id"), schemas.FAILURE_FIELDS),
    "Diagnostics": (("diagnostic_id",), tuple(schemas.DIAGNOSTICS.names)),
}


def snapshot_keys(snapshot: DataFrame, key: Sequence[str]) -> DataFrame:
    """Record id per key; of several records with one key the last in sheet order counts.

    A single key ignores blanks; a compound key keeps nulls as values. ``snapshot`` has
    record_no, record_id and the key columns.
    """
    rows = snapshot
    if len(key) == 1:
        rows = rows.filter(F.col(key[0]).isNotNull() & (F.col(key[0]) != ""))
    return rows.groupBy(*key).agg(F.max_by("record_id", "record_no").alias("record_id"))


def upserts(rows: DataFrame, snapshot: DataFrame, key: Sequence[str]) -> DataFrame:
    """Report rows with the sheet record each one updates, or kind ``create``."""
    known = snapshot_keys(snapshot, key).select(*[F.col(k).alias(f"_{k}") for k in key], "record_id")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) if len(key) > 1 else F.col(k) == F.col(f"_{k}") for k in key]
    j = rows.join(known, same, "left")
    kind = F.when(F.col("record_id").isNull(), F.lit("create")).otherwise(F.lit("update"))
    return j.select(kind.alias("kind"), "record_id", *rows.columns)


def record_json(fields: Sequence[str], schema, record_id: Column | None = None) -> Column:
    """JSON text of one sheet record with the given fields."""
    types = {f.name: f.dataType for f in schema.fields}
    body = json_object({c: (F.col(c), types[c]) for c in fields})
    create = F.concat(F.lit('{"fields": '), body, F.lit("}"))
    if record_id is None:
        return create
    update = F.concat(F.lit('{"id": '), record_id.cast("string"), F.lit(', "fields": '), body, F.lit("}"))
    return F.when(record_id.isNull(), create).otherwise(update)


def send_order(table: str) -> Column:
    """Text that sorts records as their report does: by key, failures newest first."""
    if table == "Failures":
        newest = F.translate(F.date_format("started_at", "yyyyMMddHHmmssSSSSSS"), "0123456789", "9876543210")
        return F.coalesce(newest, F.lit("~"))
    return F.col(TABLES[table][0][0])


def records(changes: DataFrame, table: str) -> DataFrame:
    """Upsert rows as sheet records: table, kind, order, record text and its size."""
    _, fields = TABLES[table]
    text = record_json(fields, changes.schema, F.col("record_id"))
    return changes.select(
        F.lit(table).alias("table_name"), "kind", send_order(table).alias("order_key"), text.alias("record")
    ).withColumn("n_bytes", F.octet_length("record").cast("bigint"))


def sync_counts(campaigns: DataFrame, datasets: DataFrame, failures: DataFrame) -> DataFrame:
    """Rows per synced table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in (("campaigns", campaigns), ("datasets", datasets), ("failures", failures))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
