"""Recorded responses of a remote catalog, with their bytes as they came."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger import schemas

#: A body is bytes: hashes are byte-exact, and what is no UTF-8 stays what it is.
RECORDED = T.StructType([
    T.StructField(f.name, T.BinaryType() if f.name == "body" else f.dataType, f.nullable) for f in schemas.RESPONSES.fields])
_BUCKET = "item_bucket"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("item_id"), F.lit(buckets)).cast("int")


def write_responses(responses: DataFrame, path: str, buckets: int = 16) -> str:
    """Keep responses by collection and bucket of items, so that a few items are found without the others' bodies."""
    kinds = {f.name: f.dataType for f in RECORDED.fields}
    rows = responses.select(*[F.col(c).cast(kinds[c]).alias(c) for c in RECORDED.names]).withColumn(_BUCKET, _bucket(buckets))
    rows.repartition("collection_id", _BUCKET).sortWithinPartitions("collection_id", _BUCKET, "item_id", "attempt_no").write.mode(
        "errorifexists").partitionBy("collection_id", _BUCKET).parquet(path)
    return path


def read_responses(spark: SparkSession, path: str, items: DataFrame | None = None, buckets: int = 16) -> DataFrame:
    """Recorded responses; with ``items`` (collection_id, item_id) only theirs. The folders of other collections and
    buckets are not opened: their names, at most one for each collection and bucket, become a partition filter."""
    kind = T.StructType([*RECORDED.fields, T.StructField(_BUCKET, T.IntegerType())])
    rows = spark.read.schema(kind).parquet(path)
    if items is None:
        return rows.select(*RECORDED.names)
    wanted = items.select("collection_id", "item_id").distinct()
    folders = wanted.select("collection_id", _bucket(buckets).alias(_BUCKET)).distinct().collect()
    collections = sorted({f["collection_id"] for f in folders if f["collection_id"] is not None})
    rows = rows.where(F.col("collection_id").isin(collections) & F.col(_BUCKET).isin(sorted({f[_BUCKET] for f in folders})))
    return rows.join(wanted, ["collection_id", "item_id"], "left_semi").select(*RECORDED.names)


def body_text(body: Column) -> Column:
    """The text of a body; null where its bytes are no UTF-8."""
    text = body.cast("string")
    return F.when(F.is_valid_utf8(text), text)
