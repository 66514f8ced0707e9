"""Shared arguments of the registered queries."""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import functions as F

from mapledger.fixtures.projection import CLAIM_NOW, NOW
from mapledger.schemas import DRS_FIELDS

NOW_TS = dt.datetime.fromisoformat(NOW)
CLAIM_TS = dt.datetime.fromisoformat(CLAIM_NOW)
LEASE = 3600
BASE_URL = "https://stac.example"
MAPPINGS = [("/data/1", "/mnt/one/"), ("/data/", "/mnt/data"), ("/other", "/mnt/other")]
STRICT_MAPPINGS = [("/data", "/mnt/strict/"), ("/other", "/mnt/other")]

DATASET_COLUMNS = (
    "dataset_id, campaign, project, activity, institution, drs, mapfile, mapfile_checksum, registration_status, "
    "retired_at, publication_status, publication_claim_id, publication_claimed_at, archive_status, "
    "archive_completed_at, stac_status, stac_checked_at, stac_http_status, registered_at"
)

#: Component names of two projects, one of which names one more.
PROJECT_NAMES = [("CMIP6", list(DRS_FIELDS)), ("CMIP6Plus", [*DRS_FIELDS[:3], "subproject", *DRS_FIELDS[3:]])]


def by_project(c):
    """Datasets whose second project has a component more; some lack it, and some belong to a project without names."""
    k = F.col("o_orderkey")
    longer = F.regexp_replace("dataset_id", r"^((?:[^.]+\.){3})", "$1sub.")
    return c.datasets.withColumn("dataset_id", F.when((F.col("project") == "CMIP6Plus") & (k % 9 != 0), longer).otherwise(F.col("dataset_id")))


def project_specs(c):
    return c.spark.createDataFrame(PROJECT_NAMES, "project string, names array<string>")


BY_PROJECT = r"""own as (select * replace (case when project = 'CMIP6Plus' and o_orderkey % 9 <> 0 then regexp_replace(dataset_id, '^(([^.]+\.){3})', '\1sub.') else dataset_id end as dataset_id) from datasets),
  cut as (select *, string_split(dataset_id, '.') as raw, case project when 'CMIP6' then 10 else 11 end as wanted from own),
  parts as (select *, case when len(raw) = wanted - 1 then list_concat(raw[1:-2], [split_part(raw[-1], '#', 1), 'v' || split_part(raw[-1], '#', 2)]) else raw end as p from cut)"""


def catalog_columns(df):
    """Only the catalog's own dataset columns, without the fixture's order key."""
    return df.select(*[c.strip() for c in DATASET_COLUMNS.split(",")])


def set_columns(changes: dict[str, str], prefix: str = "d.") -> str:
    """A DuckDB select list of all dataset columns with some replaced."""
    return ", ".join(
        f"{changes[c]} as {c}" if c in changes else f"{prefix}{c}"
        for c in (x.strip() for x in DATASET_COLUMNS.split(","))
    )


#: Folders that written files are dealt over by name: in one alone the tasks wait for each other.
SHELVES = 64


def _place(folder: str) -> Callable[[str], Path]:
    """Where a file of a name lies below a folder that the executors share."""
    top = Path(folder.removeprefix("file://").removeprefix("file:"))
    return lambda name: top / f"{zlib.crc32(name.encode()) % SHELVES:02d}" / name


def written_files(df, folder: str) -> str:
    """Write (name, text) rows as one file each, as a publisher would. Returns the pattern of the folders they lie in."""
    place = _place(folder)

    def write(batches):
        for batch in batches:
            for name, text in zip(batch["name"], batch["text"]):
                path = place(name)
                try:
                    path.write_text(text, encoding="utf-8")
                except FileNotFoundError:
                    path.parent.mkdir(parents=True, exist_ok=True)
                    path.write_text(text, encoding="utf-8")
            yield batch[["name"]]

    df.select("name", "text").mapInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    return f"{folder}/*"


def removed_files(df, folder: str) -> None:
    """Remove the files that were written for (name) rows, by tasks."""
    place = _place(folder)

    def remove(batches):
        for batch in batches:
            for name in batch["name"]:
                place(name).unlink(missing_ok=True)
            yield batch[["name"]]

    df.select("name").mapInPandas(remove, "name string").write.format("noop").mode("overwrite").save()
