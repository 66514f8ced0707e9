"""Large CSV files and JSON documents read by many tasks, although fields hold line breaks.

A file is read in pieces that end at a separator, each with the byte range (`block`) it was read in. Whether a piece
begins inside a quoted field, or how deep inside a document, follows from everything before it: a sum inside its block,
and a sum over the earlier blocks of its file, of which there is one short row each. Records then are runs of pieces,
whatever blocks they stand in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE = ("file", "block", "seq")


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, seq, value): the text between separators; `seq` grows inside a block."""
    rows = spark.read.option("lineSep", separator).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")


def with_sum_before(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the sum of a value over all pieces of a file before each one."""
    marked = df.withColumn("_v", value.cast("bigint"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each block.
    carried = marked.groupBy("file", "block").agg(F.sum("_v").alias("_sum")).select(
        "file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carried"))
    local = marked.withColumn("_local", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return local.join(carried, ["file", "block"]).select(*df.columns, (F.col("_carried") + F.col("_local")).alias(name))


def with_last_before(df: DataFrame, mark: Column, name: str) -> DataFrame:
    """Add the last mark (null where a piece has none) at or before each piece of a file."""
    marked = df.withColumn("_m", mark)
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    order = F.when(F.col("_m").isNotNull(), F.col("seq"))
    carried = marked.groupBy("file", "block").agg(F.max_by("_m", order).alias("_tail")).select(
        "file", "block", F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    local = marked.withColumn("_local", F.last("_m", ignorenulls=True).over(inside))
    return local.join(carried, ["file", "block"]).select(*df.columns, F.coalesce("_local", "_carried").alias(name))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _joined(df: DataFrame, separator: str) -> DataFrame:
    """One text for each run of pieces, which share `start`; a run is bounded by its record."""
    run = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    return df.groupBy("file", "start").agg(F.array_join(F.transform(run, lambda p: p["value"]), separator).alias("text"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(row_no, text) of every record of CSV files but the headers, with the line breaks of quoted fields.

    A field that holds a quote has to be quoted, as writers do. Blank lines between records are none."""
    lines = with_sum_before(pieces(spark, path, "\n"), _count(F.col("value"), '"'), "quotes")
    opens = F.col("quotes") % 2 == 0
    even = _count(F.col("value"), '"') % 2 == 0
    # Nearly all records are one line, and need no grouping.
    alone = lines.where(opens & even).select("file", F.struct("block", "seq").alias("start"), F.col("value").alias("text"))
    started = with_last_before(lines, F.when(opens, F.struct("block", "seq")), "start")
    broken = _joined(started.where(~(opens & even)), "\n")
    rows = alone.unionByName(broken.select("file", "start", "text")).withColumn("text", F.rtrim("text", F.lit("\r")))
    heads = rows.where("start.block = 0").groupBy("file").agg(F.min("start").alias("_head"))
    return rows.join(heads, "file").where("start > _head AND text <> ''").select(
        F.struct("file", "start.block", F.col("start.seq").alias("row")).alias("row_no"), "text")


def document_records(spark: SparkSession, path: str, member: str) -> DataFrame:
    """(record_no, text) of the objects in the array that is the first member of each JSON document.

    Pieces end at closing braces. The strings in a piece are known once it is known whether it begins inside one; the
    braces and brackets outside strings then give the depth, and a record ends where it falls back to the array's."""
    raw = pieces(spark, path, "}")
    # An escape never stands before a closing brace, so no piece parts one.
    plain = F.regexp_replace("value", r"\\.", "")
    quoted = with_sum_before(raw, _count(plain, '"'), "quotes")
    inside = F.col("quotes") % 2 == 1
    outer = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), plain)).otherwise(plain), r'(?s)"[^"]*(?:"|\z)', "")
    ends_inside = (F.col("quotes") + _count(plain, '"')) % 2 == 1
    change = _count(outer, "{") + _count(outer, "[") - _count(outer, "]") - F.when(ends_inside, 0).otherwise(1)
    marked = with_sum_before(quoted.withColumn("change", change).withColumn("closes", ~ends_inside), F.col("change"), "depth")
    # Below the document and its array, an object is at depth 3; its own closing brace leads back to 2.
    ends = F.col("closes") & (F.col("depth") + F.col("change") == 2)
    numbered = with_sum_before(marked.withColumn("ends", ends), F.col("ends"), "start")
    head = rf'^\s*\{{\s*"{member}"\s*:\s*\['
    first = (F.col("depth") == 0) & (F.col("block") == 0) & F.col("value").rlike(r'\S')
    value = F.when(F.col("depth") == 0, F.regexp_replace("value", head, "")).otherwise(F.col("value"))
    # Of the last piece of a document, nothing belongs to a record. Fixed text, as of a document read whole.
    wanted = F.when(
        first & ~F.col("value").rlike(head), F.raise_error(F.lit(f"Unexpected sheet response: missing {member} list")).cast("boolean")
    ).otherwise((F.col("depth") >= 2) | (F.col("depth") + F.col("change") >= 2) | F.col("ends"))
    own = numbered.where(wanted).withColumn("value", value)
    texts = _joined(own, "}").select(
        "file", F.col("start").alias("n"), F.concat(F.regexp_replace("text", r"^[\s,]+", ""), F.lit("}")).alias("text"))
    return texts.where(F.col("text").startswith("{")).select(F.struct("file", "n").alias("record_no"), "text")
