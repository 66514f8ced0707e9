"""Writers: CSV reports, history, state snapshots, request batches."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger.functions.text import csv_timestamp


def csv_form(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The given columns as report text; missing ones are blank."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in fields:
        if name not in kinds:
            out.append(F.lit(None).cast("string").alias(name))
        elif isinstance(kinds[name], (T.TimestampNTZType, T.TimestampType)):
            out.append(csv_timestamp(F.col(name)).alias(name))
        else:
            out.append(F.col(name).cast("string").alias(name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, fields: Sequence[str]) -> str:
    """Write a report with header; each task writes its own part."""
    # Texts keep the blanks at their ends.
    csv_form(df, fields).write.mode("errorifexists").options(
        header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def read_back(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    kind = T.StructType([T.StructField(c, T.StringType()) for c in fields])
    # Free texts may hold line breaks; each task of the writer left a file of its own to read.
    return spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").schema(kind).csv(path)


def append_history(df: DataFrame, path: str, run_column: str = "run_id", part: str | None = None) -> str:
    """Append history rows, one folder per run so that a run's rows are found without a scan.

    ``part`` names what is appended: a retried job of the same name replaces its own rows
    (a column ``part`` then stands beside the run). Without it a retry would repeat them.
    """
    if part is None:
        df.write.mode("append").partitionBy(run_column).parquet(path)
    else:
        df.withColumn("part", F.lit(part)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(run_column, "part").parquet(path)
    return path


_COMMIT = "version bigint, folder string, committed_at timestamp_ntz"


def write_state(df: DataFrame, root: str, version: int, now: dt.datetime) -> str:
    """Write a new snapshot beside the old ones, then publish it by one commit row.

    Readers follow the newest commit, so they see the old state until the commit row's
    file appears, and a failed write leaves nothing behind that anyone reads. One
    writer at a time.
    """
    folder = f"{root.rstrip('/')}/data/{version}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(folder)
    spark = df.sparkSession
    spark.createDataFrame([(version, folder, now)], _COMMIT).coalesce(1).write.mode("append").parquet(
        f"{root.rstrip('/')}/commits"
    )
    return folder


def current_folder(spark: SparkSession, root: str) -> str:
    """The folder the newest commit names."""
    commits = spark.read.schema(_COMMIT).parquet(f"{root.rstrip('/')}/commits")
    return commits.orderBy(F.desc("version")).first()["folder"]


def read_state(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(current_folder(spark, root))


def publish_together(parts: dict[str, DataFrame], root: str, version: int, now: dt.datetime) -> dict[str, str]:
    """Write several outputs so that they become visible together: all data first, one commit row last."""
    base = f"{root.rstrip('/')}/data/{version}-{uuid.uuid4().hex}"
    written = {}
    for name, df in parts.items():
        written[name] = f"{base}/{name}"
        if name.endswith(".csv"):
            write_csv(df, written[name], df.columns)
        else:
            df.write.mode("errorifexists").parquet(written[name])
    spark = next(iter(parts.values())).sparkSession
    spark.createDataFrame([(version, base, now)], _COMMIT).coalesce(1).write.mode("append").parquet(
        f"{root.rstrip('/')}/commits"
    )
    return written


def write_batches(bodies: DataFrame, path: str) -> str:
    """Request bodies keyed by table, kind and batch, one folder per table and kind."""
    bodies.write.mode("errorifexists").partitionBy("table_name", "kind").parquet(path)
    return path
