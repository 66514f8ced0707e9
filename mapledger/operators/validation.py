"""Pre-publication checks: mapfiles, referenced files, path rewriting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.functions import mapfile
from mapledger.functions.text import strip


def line_problems(lines: DataFrame, inventory: DataFrame) -> DataFrame:
    """Malformed lines and lines naming a file the inventory does not have.

    Line numbers count blank lines and start at 1.
    """
    p = lines.select("mapfile", "line_no", strip(F.col("line")).alias("line")).filter(F.col("line") != "")
    cells = F.split("line", r"\|", -1)
    p = p.select("mapfile", "line_no", F.when(F.size(cells) >= 3, strip(F.get(cells, 1))).alias("path"))
    # One pass over the lines. Malformed ones have no path: each gets a key of its own, which no path equals,
    # so they match nothing and do not meet in one task.
    alone = F.concat(F.lit("\0"), F.xxhash64("mapfile", "line_no").cast("string"))
    known = inventory.filter(F.col("path").isNotNull()).select(F.col("path").alias("_key"))
    lost = p.withColumn("_key", F.coalesce("path", alone)).join(known, "_key", "left_anti")
    number = F.concat(F.lit("Line "), F.col("line_no").cast("string"), F.lit(": "))
    # Message formats.
    problem = F.when(F.col("path").isNull(), F.concat(number, F.lit("malformed mapfile row"))).otherwise(
        F.concat(number, F.lit("missing file "), F.col("path"))
    )
    return lost.select("mapfile", "line_no", problem.alias("problem"))


def mapfile_problems(datasets: DataFrame, mapfiles: DataFrame) -> DataFrame:
    """Per dataset the reason its mapfile cannot be read; null when it can.

    ``mapfiles`` is an inventory (path, is_file, length).
    """
    j = datasets.select("dataset_id", "mapfile").join(
        mapfiles.select(F.col("path").alias("mapfile"), "is_file", "length", F.lit(True).alias("_there")),
        "mapfile", "left",
    )
    # Message texts.
    problem = (
        F.when(F.col("_there").isNull(), F.lit("Mapfile does not exist"))
        .when(~F.col("is_file"), F.lit("Mapfile is not a file"))
        .when(F.col("length") == 0, F.lit("Mapfile is empty"))
    )
    return j.select("dataset_id", "mapfile", problem.alias("problem"))


def dataset_problems(
    datasets: DataFrame, lines: DataFrame, inventory: DataFrame, mapfiles: DataFrame
) -> DataFrame:
    """All problems as rows (dataset_id, line_no, problem); an unreadable mapfile hides its lines."""
    heads = mapfile_problems(datasets, mapfiles)
    readable = heads.filter(F.col("problem").isNull()).select("dataset_id", "mapfile")
    below = readable.join(line_problems(lines, inventory), "mapfile").select("dataset_id", "line_no", "problem")
    above = heads.filter(F.col("problem").isNotNull()).select(
        "dataset_id", F.lit(0).cast("bigint").alias("line_no"), "problem"
    )
    return above.unionByName(below)


def validation_report(
    datasets: DataFrame, lines: DataFrame, inventory: DataFrame, mapfiles: DataFrame
) -> DataFrame:
    """PASS or FAIL per dataset with its number of problems and the first of them.

    The full list stays in ``dataset_problems``: a mapfile may have any number of bad lines.
    """
    found = dataset_problems(datasets, lines, inventory, mapfiles).groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_problems"), F.min(F.struct("line_no", "problem"))["problem"].alias("first_problem")
    )
    return datasets.select("dataset_id").join(found, "dataset_id", "left").select(
        "dataset_id",
        F.when(F.col("n_problems").isNull(), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("verdict"),
        F.coalesce("n_problems", F.lit(0)).alias("n_problems"), "first_problem",
    )


def rewrite_report(lines: DataFrame, mappings: Iterable[tuple[str, str]]) -> DataFrame:
    """Per mapfile: paths seen, paths changed and the first changed pair."""
    cells = F.split(F.col("line"), r"\|", -1)
    p = lines.filter(F.size(cells) >= 2).select("mapfile", "line_no", strip(F.get(cells, 1)).alias("path"))
    p = p.withColumn("mapped", mapfile.mapped_path(F.col("path"), mappings))
    changed = F.col("path") != F.col("mapped")
    first = F.min(F.when(changed, F.struct("line_no", "path", "mapped")))
    return p.groupBy("mapfile").agg(
        F.count_if(changed).alias("changed"), F.count(F.lit(1)).alias("total"), first.alias("_first")
    ).select("mapfile", "changed", "total", F.col("_first.path").alias("example_from"), F.col("_first.mapped").alias("example_to"))
