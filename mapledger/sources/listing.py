"""Listing of a folder tree in tasks: every file, hidden and empty ones too."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapledger.session import cut_lineage

_ENTRY = "path string, is_file boolean, is_folder boolean, length long, modified timestamp_ntz"
#: Entries that a task hands over at once.
ROWS = 1 << 14


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of folders. A link to a file is a file; links to folders are not followed. A folder that went away
    meanwhile has none, one that may not be read raises an error."""
    kinds = [pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.timestamp("us")]
    names = ["path", "is_file", "is_folder", "length", "modified"]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        rows: list[tuple] = []
        for folder in batch.column(0).to_pylist():
            try:
                with os.scandir(folder) as entries:
                    for entry in entries:
                        try:
                            known = entry.stat()
                        except FileNotFoundError:
                            continue
                        rows.append((entry.path, entry.is_file(), entry.is_dir(follow_symlinks=False), known.st_size, int(known.st_mtime * 1e6)))
                        if len(rows) >= ROWS:
                            yield packed(rows)
                            rows = []
            except FileNotFoundError:
                continue
        if rows:
            yield packed(rows)


def list_folders(spark: SparkSession, *folders: str) -> DataFrame:
    """Entries directly inside folders that the executors share, listed in tasks whenever they are asked for."""
    names = spark.createDataFrame([(f,) for f in folders], "path string")
    return names.repartition(max(1, len(folders)), "path").mapInArrow(_listed, _ENTRY)


def inside(entries: DataFrame) -> DataFrame:
    """Entries directly inside listed folders."""
    return entries.where("is_folder").select("path").mapInArrow(_listed, _ENTRY)


def list_tree(spark: SparkSession, *roots: str) -> DataFrame:
    """(path, length, modified) of all files below folders that the executors share.

    The tree is walked breadth first: each round lists one depth, its folders dealt over the tasks, and keeps what it
    found in the checkpoint folder. The driver only asks whether folders are left.
    """
    paths = [r.removeprefix("file://").removeprefix("file:").rstrip("/") or "/" for r in roots]
    frontier = spark.createDataFrame([(p,) for p in paths], "path string")
    found = spark.createDataFrame([], _ENTRY)
    while True:
        entries = cut_lineage(frontier.repartition("path").mapInArrow(_listed, _ENTRY))
        found = found.unionByName(entries.where("is_file"))
        frontier = entries.where("is_folder").select("path")
        if frontier.isEmpty():
            return found.select("path", "length", "modified")
