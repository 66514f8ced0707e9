"""Readers: mapfiles, logs, items, CSV files, sheet snapshots, catalog tables."""

from __future__ import annotations

import bz2
import gzip
import json
import os
import zlib
from collections.abc import Iterable, Iterator
from pathlib import PurePosixPath

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger import schemas
from mapledger.functions.text import basename
from mapledger.sources import listing, splits

_LINE_BREAK = r"\r\n|\n|\r"

# Columns each CSV must have.
RESULT_COLUMNS = ("task_id", "dataset_id", "mapfile_checksum", "archive_path", "status")
TASK_COLUMNS = ("task_id", "dataset_id", "mapfile", "mapfile_checksum", "archive_path")


def local_path(uri: Column) -> Column:
    """Path without the scheme a local file system puts before it."""
    return F.regexp_replace(uri, r"^file:(//(?=/))?", "")


# ---- mapfiles ---------------------------------------------------------------


def read_mapfiles(spark: SparkSession, root: str) -> DataFrame:
    """All ``*.map`` files below a root: mapfile, content. One file is one row."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.map").load(root)
    )
    return files.select(local_path(F.col("path")).alias("mapfile"), "content")


def mapfile_lines(mapfiles: DataFrame) -> DataFrame:
    """Numbered lines (from 1, blanks counted) of read mapfiles."""
    text = F.decode(F.col("content"), "UTF-8")
    return mapfiles.select("mapfile", F.posexplode(F.split(text, _LINE_BREAK, -1)).alias("n", "line")).select(
        "mapfile", (F.col("n") + F.lit(1)).cast("bigint").alias("line_no"), "line"
    )


def fingerprints(mapfiles: DataFrame) -> DataFrame:
    """SHA-256 of each mapfile's bytes."""
    return mapfiles.select("mapfile", F.sha2("content", 256).alias("mapfile_checksum"))


def unread_paths(inventory: DataFrame, root: str) -> DataFrame:
    """Inventory paths below a root that the file reader passes over: hidden names and empty files."""
    below = F.substr(F.col("path"), F.lit(len(root.rstrip("/")) + 2))
    hidden = F.exists(F.split(below, "/"), lambda x: x.startswith(".") | x.startswith("_"))
    rows = inventory.filter(F.col("path").startswith(root.rstrip("/") + "/") & F.col("path").endswith(".map"))
    return rows.filter(hidden | (F.col("length") == 0))


# ---- campaign configuration ----------------------------------------------------


def campaigns_from_yaml(texts: DataFrame, base_dir: str, env: dict[str, str] | None = None, home: str | None = None) -> DataFrame:
    """Campaign rows from configuration texts (column ``content``).

    Archive root and depth count only where archiving is enabled. Roots may use
    environment names and ``~``; relative ones lie below ``base_dir``.
    """
    variables = dict(os.environ if env is None else env)
    home_dir = home if home is not None else os.path.expanduser("~")

    def expand(path: str) -> str:
        for name in sorted(variables, key=len, reverse=True):
            path = path.replace("${" + name + "}", variables[name]).replace("$" + name, variables[name])
        if path == "~" or path.startswith("~/"):
            path = home_dir + path[1:]
        if not path.startswith("/"):
            path = str(PurePosixPath(base_dir) / path)
        return os.path.normpath(path)

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for pdf in batches:
            loaded = [(yaml.safe_load(text) or {}).get("campaigns", {}) for text in pdf["content"]]
            yield pd.DataFrame(
                [(name, expand(str(entry["mapfile_root"])), json.dumps(entry, default=str))
                 for campaigns in loaded for name, entry in campaigns.items()],
                columns=["name", "mapfile_root", "entry"])

    # Python only reads the YAML; what an entry means is told by columns.
    kind = "project string, activity string, institution string, archive struct<enabled: boolean, root: string, depth: string>"
    e = texts.select("content").mapInPandas(entries, "name string, mapfile_root string, entry string").withColumn(
        "e", F.from_json("entry", kind))

    def needed(member: str) -> Column:
        value = F.col("e")[member]
        told = F.concat(F.lit("campaign "), F.col("name"), F.lit(f" has no {member}"))
        return F.when(value.isNull(), F.raise_error(told).cast("string")).otherwise(value).alias(member)

    archived = F.coalesce(F.col("e.archive.enabled"), F.lit(False))
    return e.select(
        "name", needed("project"), needed("activity"), needed("institution"), "mapfile_root",
        F.when(archived, F.col("e.archive.root")).alias("archive_root"),
        F.when(archived, F.col("e.archive.depth")).alias("archive_depth"),
    ).select(*schemas.CAMPAIGNS.names)


def read_campaigns(spark: SparkSession, path: str, base_dir: str, **kwargs) -> DataFrame:
    texts = spark.read.text(path, wholetext=True).withColumnRenamed("value", "content")
    return campaigns_from_yaml(texts, base_dir, **kwargs)


# ---- catalog tables -------------------------------------------------------------


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One catalog table with its fixed schema."""
    return spark.read.schema(schemas.TABLES[table]).parquet(path)


# ---- CSV ------------------------------------------------------------------------


def missing_columns(found: Iterable[str], required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(found))


def read_csv(spark: SparkSession, path: str, required: Iterable[str], multiline: bool = True) -> DataFrame:
    """A CSV with header, all columns text, plus ``row_no``: an ordering value in file order.

    One file is read by many tasks, and quoted fields may hold line breaks (``splits.csv_records``). Files known to have
    none are parsed by the reader itself (``multiline=False``).
    """
    reader = spark.read.option("header", "true").option("escape", '"')
    head = reader.option("multiLine", str(multiline).lower()).csv(path).columns
    missing = missing_columns(head, required)
    if missing:
        raise ValueError(f"the CSV at {path} lacks the columns {', '.join(missing)}")
    kind = T.StructType([T.StructField(c, T.StringType()) for c in head])
    if multiline:
        parsed = splits.csv_records(spark, path).select(F.from_csv("text", ", ".join(f"`{c}` string" for c in head), {"escape": '"'}).alias("r"), "row_no")
        return parsed.select("r.*", "row_no")
    rows = spark.read.option("header", "true").option("escape", '"').option("enforceSchema", "true").schema(kind).csv(path)
    order = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select("*", order.alias("row_no"))


def read_archive_results(spark: SparkSession, path: str) -> DataFrame:
    rows = read_csv(spark, path, RESULT_COLUMNS)
    return rows if "error_message" in rows.columns else rows.withColumn("error_message", F.lit(""))


def read_archive_tasks(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TASK_COLUMNS)


# ---- publisher logs ----------------------------------------------------------------


def log_lines(texts: DataFrame) -> DataFrame:
    """Lines of a text scan as (run_id, file, block, seq, line); the run is the folder ``run_id=...`` or the file's name."""
    path = F.col("_metadata.file_path")
    named = F.col("run_id").cast("string") if "run_id" in texts.columns else F.regexp_replace(basename(path), r"\.log$", "")
    return texts.select(
        named.alias("run_id"), path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def with_batches(lines: DataFrame) -> DataFrame:
    """Lines with the batch they belong to: that of the last ``Batch:`` heading above.

    The heading is carried forward inside each split of a file, then from split to
    split, so one very long log spreads over as many tasks as it has splits.
    """
    heading = F.when(F.col("line").startswith("Batch: "), F.substr(F.col("line"), F.lit(8)))
    marked = lines.withColumn("_h", heading)
    inside = Window.partitionBy("file", "block").orderBy("seq")
    local = F.last("_h", ignorenulls=True).over(inside)
    tails = marked.groupBy("file", "block").agg(F.max_by("_h", F.when(F.col("_h").isNotNull(), F.col("seq"))).alias("_tail"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select("file", "block", F.last("_tail", ignorenulls=True).over(earlier).alias("_carry"))
    j = marked.withColumn("_local", local).join(carry, ["file", "block"])
    return j.select(
        "run_id", F.coalesce("_local", "_carry").alias("batch_no"),
        F.struct("block", "seq").alias("line_no"), "line",
    )


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Publisher logs as (run_id, batch_no, line_no, line)."""
    return with_batches(log_lines(spark.read.text(path)))


# ---- items -----------------------------------------------------------------------


#: Bytes and files that a task hands over at once.
DOC_BYTES, DOC_FILES = 1 << 22, 1 << 12
#: Packed files are told by their names, as Spark's reader tells them.
_UNPACKED = {
    ".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress,
    ".zst": lambda data: pa.CompressedInputStream(pa.BufferReader(data), "zstd").read(),
}


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name and bytes of listed files."""
    names: list[str] = []
    docs: list[bytes] = []
    held = 0

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(docs, pa.binary())], names=["file_name", "doc"])

    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open(path, "rb") as file:
                data = file.read()
            kind = os.path.splitext(path)[1]
            if kind in (".lz4", ".snappy"):
                raise ValueError(f"items packed as {kind} are not read: {path}")
            names.append(os.path.basename(path))
            docs.append(_UNPACKED[kind](data) if kind in _UNPACKED else data)
            held += len(docs[-1])
            if held >= DOC_BYTES or len(docs) >= DOC_FILES:
                yield packed()
                names, docs, held = [], [], 0
    if docs:
        yield packed()


def _listed_items(spark: SparkSession, path: str) -> DataFrame | None:
    """Listing of the files that a path or pattern names; none where the executors do not see them as files."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    given = hadoop.Path(path)
    store = given.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() != "file":
        return None
    pattern = hadoop.GlobPattern(given.getName())
    places = store.globStatus(given.getParent() if pattern.hasWildcard() else given) or []
    folders = [local for p in places if p.isDirectory() for local in [p.getPath().toUri().getPath()]]
    if not folders or len(folders) < len(places):
        return None
    entries = listing.list_folders(spark, *folders)
    if pattern.hasWildcard():
        entries = entries.where(basename(F.col("path")).rlike(f"^(?s:{pattern.compiled().pattern()})$"))
        entries = entries.unionByName(listing.inside(entries))
    name = basename(F.col("path"))
    hidden = name.startswith(".") | (name.startswith("_") & ~name.contains("=")) | name.endswith("._COPYING_")
    return entries.where(F.col("is_file") & (F.col("length") > 0) & ~hidden)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file: file_name, item_id (from the name), doc. Unreadable JSON stays a row.

    Empty and hidden files are passed over. Files of a folder that the executors share are listed and read by tasks, so
    the driver holds none of their names; in another store they are Spark's to list."""
    listed = _listed_items(spark, path)
    if listed is None or listed.isEmpty():
        # A path of nothing is refused here.
        rows = spark.read.option("wholetext", "true").text(path)
        rows = rows.select(F.url_decode(basename(F.col("_metadata.file_path"))).alias("file_name"), F.col("value").alias("doc"))
    else:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = listed.select("path").repartition(parts, "path").mapInArrow(_documents, "file_name string, doc binary")
    return rows.select(
        "file_name", F.regexp_replace("file_name", r"\.json$", "").alias("item_id"), F.col("doc").cast("string").alias("doc"))


def check_pattern(pattern: str) -> str:
    if not pattern or "/" in pattern or ".." in pattern:
        raise ValueError(f"not a pattern of file names in one folder: {pattern!r}")
    return pattern


def read_item_folder(spark: SparkSession, directory: str, pattern: str = "CMIP*.json") -> DataFrame:
    """Documents matching a filename pattern directly inside one folder."""
    return read_items(spark, f"{directory.rstrip('/')}/{check_pattern(pattern)}")


# ---- sheet snapshots ------------------------------------------------------------------

_RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("fields", T.StringType())])


def _record_rows(rows: DataFrame) -> DataFrame:
    """Keep records whose fields are an object (absent fields count as empty)."""
    fields = F.coalesce(F.col("fields"), F.lit("{}"))
    return rows.select("record_no", F.col("id").alias("record_id"), fields.alias("fields")).filter(
        F.substr(F.ltrim(fields), F.lit(1), F.lit(1)) == "{"
    )


def sheet_records(documents: DataFrame) -> DataFrame:
    """Records of snapshot documents (column ``content``): record_no, record_id, fields JSON."""
    kind = T.StructType([T.StructField("records", T.ArrayType(_RECORD))])
    parsed = documents.select(F.from_json("content", kind).alias("p"))
    records = F.coalesce(
        F.col("p.records"), F.raise_error(F.lit("Unexpected sheet response: missing records list"))
    )
    rows = parsed.select(F.posexplode(records).alias("n", "r"))
    return _record_rows(rows.select(F.col("n").cast("bigint").alias("record_no"), "r.id", "r.fields"))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot saved as one JSON document."""
    return sheet_records(spark.read.text(path, wholetext=True).withColumnRenamed("value", "content"))


def read_sheet_split(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot saved as one JSON document whose first member is the records list: read by many tasks."""
    records = splits.document_records(spark, path, "records").select("record_no", F.from_json("text", _RECORD).alias("r"))
    return _record_rows(records.select("record_no", "r.id", "r.fields"))


def read_sheet_lines(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot saved as one record per line: splits over tasks at any size."""
    rows = spark.read.schema(_RECORD).json(path)
    order = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return _record_rows(rows.select(order.alias("record_no"), "id", "fields"))


def sheet_keys(records: DataFrame, key: Iterable[str]) -> DataFrame:
    """Key columns of sheet records as text, for matching with report rows."""
    return records.select(
        "record_no", "record_id", *[F.get_json_object("fields", f"$.{k}").alias(k) for k in key]
    )
