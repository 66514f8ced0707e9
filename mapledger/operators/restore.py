"""Restore publication state from a sheet snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger import schemas
from mapledger.functions.text import json_kind, member, normalize_id
from mapledger.operators.publication import updated


def restore_value(fields: Column, name: str, kind: T.DataType) -> Column:
    """A sheet cell as a catalog value: blanks are null, epoch seconds are UTC moments,
    whole floats are integers. ``fields`` is the record's parsed JSON."""
    cell = member(fields, f"$.{name}")
    text = F.nullif(F.try_variant_get(cell, "$", "string"), F.lit(""))
    number = json_kind(cell).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        micros = F.round(F.try_variant_get(cell, "$", "double") * F.lit(1_000_000.0)).cast("bigint")
        epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        moment = F.timestamp_add("MICROSECOND", micros, epoch)
        value = F.when(number, moment).otherwise(text.try_cast("timestamp_ntz"))
        if isinstance(kind, T.TimestampType):
            value = F.to_utc_timestamp(value.cast("timestamp"), F.current_timezone())
        return value
    if isinstance(kind, T.IntegralType):
        whole = F.try_variant_get(cell, "$", "double")
        return F.when(number & (whole == F.floor(whole)), F.try_variant_get(cell, "$", kind.simpleString())).otherwise(
            text.try_cast(kind)
        )
    return text.cast(kind)


def restored_rows(records: DataFrame, columns: tuple[str, ...], schema: T.StructType) -> DataFrame:
    """Sheet records (record_no, fields JSON) as typed catalog rows."""
    kinds = {f.name: f.dataType for f in schema.fields}
    parsed = records.withColumn("_f", F.try_parse_json("fields"))
    return parsed.select(
        "record_no", *[restore_value(F.col("_f"), c, kinds.get(c, T.StringType())).alias(c) for c in columns]
    )


def blank_ids(records: DataFrame) -> DataFrame:
    """Positions of rows without a dataset id; any such row blocks a restore."""
    return records.filter(normalize_id(F.col("dataset_id")) == "").select("record_no")


def duplicate_ids(records: DataFrame) -> DataFrame:
    """Dataset ids that occur more than once; any such id blocks a restore."""
    return records.groupBy(normalize_id(F.col("dataset_id")).alias("dataset_id")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter((F.col("dataset_id") != "") & (F.col("n") > 1)).select("dataset_id")


def _ids(df: DataFrame) -> DataFrame:
    return df.select(normalize_id(F.col("dataset_id")).alias("dataset_id"))


def referenced_ids(snapshot: DataFrame, failures: DataFrame) -> DataFrame:
    return _ids(snapshot).union(_ids(failures)).distinct()


def missing_local(snapshot: DataFrame, failures: DataFrame, datasets: DataFrame) -> DataFrame:
    return referenced_ids(snapshot, failures).join(_ids(datasets), "dataset_id", "left_anti")


def blocking_missing(snapshot: DataFrame, datasets: DataFrame) -> DataFrame:
    """Snapshot ids unknown here and not retired there. Failure rows never block."""
    retired = _ids(snapshot.filter(F.upper(F.coalesce("publication_status", F.lit(""))) == "RETIRED"))
    return _ids(snapshot).join(_ids(datasets), "dataset_id", "left_anti").join(
        retired, "dataset_id", "left_anti"
    ).distinct()


def local_only(snapshot: DataFrame, datasets: DataFrame) -> DataFrame:
    return _ids(datasets).join(_ids(snapshot), "dataset_id", "left_anti").distinct()


def matched(snapshot: DataFrame, datasets: DataFrame) -> DataFrame:
    return _ids(datasets).join(_ids(snapshot), "dataset_id", "left_semi").distinct()


def coverage(snapshot: DataFrame, failures: DataFrame, datasets: DataFrame) -> DataFrame:
    """Every id of any side once, with where it occurs.

    One aggregation over the three id lists; the set operations are filters on it.
    """
    def ids_with_retired(df: DataFrame) -> DataFrame:
        return df.select(
            normalize_id(F.col("dataset_id")).alias("dataset_id"), F.lit(True).alias("in_sheet"),
            F.lit(False).alias("in_failures"), F.lit(False).alias("in_catalog"),
            (F.upper(F.coalesce("publication_status", F.lit(""))) == "RETIRED").alias("retired"),
        )

    def plain(df: DataFrame, failures_side: bool) -> DataFrame:
        return df.select(
            normalize_id(F.col("dataset_id")).alias("dataset_id"), F.lit(False).alias("in_sheet"),
            F.lit(failures_side).alias("in_failures"), F.lit(not failures_side).alias("in_catalog"),
            F.lit(False).alias("retired"),
        )

    rows = ids_with_retired(snapshot).unionByName(plain(failures, True)).unionByName(plain(datasets, False))
    flags = rows.groupBy("dataset_id").agg(
        *[F.bool_or(c).alias(c) for c in ("in_sheet", "in_failures", "in_catalog", "retired")]
    )
    return flags.withColumn("blocks", F.col("in_sheet") & ~F.col("in_catalog") & ~F.col("retired"))


def status_counts(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows per status; blanks are shown as ``<NULL>``."""
    status = F.coalesce(F.nullif("publication_status", F.lit("")), F.lit("<NULL>"))
    return snapshot.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def new_attempts(failures: DataFrame, attempts: DataFrame) -> DataFrame:
    """Snapshot failures that equal no existing attempt in all shared columns, nulls equal; duplicates once."""
    columns = [c for c in schemas.FAILURE_FIELDS if c in attempts.columns and c in failures.columns]
    new = failures.select(*columns).dropDuplicates().alias("n")
    old = attempts.select(*columns).alias("o")
    return new.join(old, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in columns], "left_anti").select(*columns)


def restore_state(datasets: DataFrame, snapshot: DataFrame, now: dt.datetime) -> DataFrame:
    """Dataset state after a restore; ids unknown here are skipped. An id must not repeat in the snapshot (see
    ``problems``); if it does, rows do not multiply and retirement wins."""
    s = snapshot.select(
        normalize_id(F.col("dataset_id")).alias("dataset_id"),
        F.struct(
            (F.upper(F.coalesce("publication_status", F.lit(""))) == "RETIRED").alias("retired"),
            F.nullif("publication_status", F.lit("")).alias("status"),
        ).alias("_s"),
    ).groupBy("dataset_id").agg(F.max("_s").alias("_s"))
    j = datasets.join(s, "dataset_id", "left").select(*datasets.columns, "_s")
    hit = F.col("_s").isNotNull()
    gone, back = hit & F.col("_s.retired"), hit & ~F.col("_s.retired")
    return updated(j, {
        "registration_status": F.when(gone, F.lit("RETIRED")).when(back, F.lit("ACTIVE")).otherwise(F.col("registration_status")),
        "retired_at": F.when(gone, F.coalesce("retired_at", F.lit(now).cast("timestamp_ntz")))
        .when(~hit, F.col("retired_at")),
        "publication_status": F.when(back, F.col("_s.status")).otherwise(F.col("publication_status")),
    }, drop=("_s",))


def problems(snapshot: DataFrame, failures: DataFrame, datasets: DataFrame) -> DataFrame:
    """(reason, dataset_id): what refuses a restore. Reasons are blank, repeated and missing."""
    blank = snapshot.filter(normalize_id(F.col("dataset_id")) == "")
    found = blank.select(F.lit("blank").alias("reason"), F.lit(None).cast("string").alias("dataset_id"))
    found = found.unionByName(duplicate_ids(snapshot).select(F.lit("repeated").alias("reason"), "dataset_id"))
    blocked = coverage(snapshot, failures, datasets).filter("blocks AND dataset_id <> ''")
    return found.unionByName(blocked.select(F.lit("missing").alias("reason"), "dataset_id"))


def unless(rows: DataFrame, problems: DataFrame) -> DataFrame:
    """The rows, or none of them where there is any problem; the other side is one row at most."""
    gate = problems.limit(1).select(F.lit(0).alias("_gate"))
    return rows.withColumn("_gate", F.lit(0)).join(F.broadcast(gate), "_gate", "left_anti").drop("_gate")
