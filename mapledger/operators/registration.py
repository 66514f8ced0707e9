"""Registration: mapfile lines to catalog changes, upsert, retirement."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import ids, mapfile
from mapledger.functions.once import with_once
from mapledger.functions.text import strip
from mapledger.operators.specs import Spec, with_components


def parsed_lines(lines: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Mapfile lines (mapfile, line_no, line) with their fields; blank lines only on request."""
    out = lines.select("mapfile", "line_no", strip(F.col("line")).alias("line"))
    if not keep_blank:
        out = out.filter(F.col("line") != "")
    out = with_once(out, _f=mapfile.fields(F.col("line")))
    well_formed = F.size("_f") >= 3
    f = F.col("_f")
    return out.select(
        "mapfile", "line_no", "line", well_formed.alias("well_formed"),
        F.when(well_formed, mapfile.field(f, 0)).alias("dataset_id"),
        F.when(well_formed, mapfile.field(f, 1)).alias("file_path"),
        F.when(well_formed, mapfile.field(f, 2)).alias("size_text"),
        F.when(well_formed, mapfile.metadata(f, "checksum")).alias("checksum"),
        F.when(well_formed, mapfile.metadata(f, "mod_time")).alias("mod_time"),
    )


def scan_mapfiles(lines: DataFrame, include_files: bool = False) -> DataFrame:
    """One row per mapfile: its dataset id, or the error that rejects it.

    Lines are condensed per (mapfile, id) before anything is shuffled, so the
    exchange carries about one row per mapfile. Errors follow file order: whichever
    faulty line comes first names the problem.
    """
    p = parsed_lines(lines, keep_blank=True)
    bad_size = mapfile.size_error(F.col("size_text")) if include_files else F.lit(None).cast("string")
    per_id = p.groupBy("mapfile", "dataset_id").agg(
        F.min(F.when(F.col("well_formed"), F.col("line_no"))).alias("first_line"),
        F.min(F.when(~F.col("well_formed") & (F.col("line") != ""), F.struct("line_no", "line"))).alias("malformed"),
        F.min(F.when(bad_size.isNotNull(), F.struct("line_no", bad_size.alias("text")))).alias("bad_size"),
        F.count_if("well_formed").alias("n_lines"),
    )
    # Normally one row per mapfile is left here. The running first value streams over them.
    in_file = Window.partitionBy("mapfile").orderBy(F.asc_nulls_last("first_line"))
    per_id = per_id.withColumn("head_id", F.first("dataset_id").over(in_file))
    f = per_id.groupBy("mapfile").agg(
        F.min("head_id").alias("head_id"),
        F.min(F.when(F.col("dataset_id") != F.col("head_id"), F.col("first_line"))).alias("second_line"),
        F.min("malformed").alias("malformed"),
        F.min("bad_size").alias("bad_size"),
        F.sum("n_lines").alias("n_files"),
    )
    name = F.col("mapfile")
    # Message formats.
    problems = F.array_compact(F.array(
        F.when(
            F.col("malformed").isNotNull(),
            F.struct(
                F.col("malformed.line_no").alias("line_no"), F.lit(0).alias("step"),
                F.concat(F.lit("Malformed mapfile line in "), name, F.lit(": "), F.col("malformed.line")).alias("text"),
            ),
        ),
        F.when(
            F.col("second_line").isNotNull(),
            F.struct(
                F.col("second_line").alias("line_no"), F.lit(1).alias("step"),
                F.concat(F.lit("Multiple dataset IDs found in "), name).alias("text"),
            ),
        ),
        F.when(
            F.col("bad_size").isNotNull(),
            F.struct(
                F.col("bad_size.line_no").alias("line_no"), F.lit(2).alias("step"),
                F.col("bad_size.text").alias("text"),
            ),
        ),
    ))
    error = F.coalesce(
        F.get(F.array_sort(problems), 0)["text"],
        F.when(F.col("head_id").isNull(), F.concat(F.lit("No dataset found in "), name)),
    )
    return f.select(
        "mapfile",
        F.when(error.isNull(), F.col("head_id")).alias("dataset_id"),
        F.when(error.isNull(), F.col("n_files")).alias("n_files"),
        error.alias("error"),
    )


def file_rows(lines: DataFrame, accepted: DataFrame | None = None) -> DataFrame:
    """File rows of accepted mapfiles (all well-formed lines when no list is given)."""
    p = parsed_lines(lines).filter("well_formed")
    if accepted is not None:
        p = p.join(accepted.select("mapfile"), "mapfile", "left_semi")
    return p.select(
        "dataset_id", "file_path", mapfile.size_value(F.col("size_text")).alias("file_size"), "checksum", "mod_time"
    )


def registration_changes(
    scan: DataFrame, fingerprints: DataFrame, campaign_roots: DataFrame, names: Spec
) -> DataFrame:
    """Scan rows with campaign columns, components and checksum; error rows keep their reason.

    ``fingerprints`` has (mapfile, mapfile_checksum); ``campaign_roots`` has (mapfile,
    campaign, project, activity, institution). ``names`` are the component names of all
    identifiers, or a table (project, names).
    """
    rows = scan.join(fingerprints, "mapfile", "left").join(campaign_roots, "mapfile", "left")
    rows, own, missing = with_components(rows, names, "project")
    dataset_id, parts = F.col("dataset_id"), F.col("_parts")
    return rows.select(
        "dataset_id", "campaign", "project", "activity", "institution",
        ids.drs_json(dataset_id, own, parts).alias("drs"), "mapfile", "mapfile_checksum",
        F.coalesce(F.col("error"), missing, ids.components_error(dataset_id, own, parts)).alias("error"),
    )


def register_upsert(datasets: DataFrame, changes: DataFrame, now: dt.datetime) -> DataFrame:
    """New dataset state after registering changes.

    Unchanged content keeps its publication, claim, archive and catalog state; changed
    content starts over. Several mapfiles of one id apply in mapfile order.
    """
    described = ("campaign", "project", "activity", "institution", "drs", "mapfile", "mapfile_checksum")
    c = changes.groupBy("dataset_id").agg(
        F.max_by(F.struct(*described), F.col("mapfile")).alias("new"),
        F.min_by("mapfile_checksum", "mapfile").alias("first_sum"),
        (F.min("mapfile_checksum") == F.max("mapfile_checksum")).alias("one_sum"),
    ).withColumn("is_new", F.lit(True))
    d = datasets.withColumn("is_old", F.lit(True))
    j = d.join(c, "dataset_id", "full_outer")
    old, new = F.col("is_old").isNotNull(), F.col("is_new").isNotNull()
    same = F.col("mapfile_checksum").isNull() | (F.col("mapfile_checksum") == F.col("first_sum"))
    keep = old & (~new | (same & F.col("one_sum")))

    def held(column: str, reset: Column) -> Column:
        kind = dict((f.name, f.dataType) for f in schemas.DATASETS.fields)[column]
        return F.when(keep, F.col(column)).otherwise(reset.cast(kind)).alias(column)

    null = F.lit(None)
    columns = {
        "dataset_id": F.col("dataset_id"),
        **{x: F.when(new, F.col("new")[x]).otherwise(F.col(x)).alias(x) for x in described},
        "registration_status": F.when(new, F.lit("ACTIVE")).otherwise(F.col("registration_status")),
        "retired_at": F.when(~new, F.col("retired_at")),
        "publication_status": held("publication_status", F.lit("PENDING")),
        "publication_claim_id": held("publication_claim_id", null),
        "publication_claimed_at": held("publication_claimed_at", null),
        "archive_status": held("archive_status", F.lit("PENDING")),
        "archive_completed_at": held("archive_completed_at", null),
        "stac_status": held("stac_status", F.lit("UNCHECKED")),
        "stac_checked_at": held("stac_checked_at", null),
        "stac_http_status": held("stac_http_status", null),
        "registered_at": F.when(old, F.col("registered_at")).otherwise(F.lit(now).cast("timestamp_ntz")),
    }
    return j.select(*[columns[f.name].alias(f.name) for f in schemas.DATASETS.fields])


def replace_files(files: DataFrame, new_files: DataFrame) -> DataFrame:
    """File rows after replacing those of every dataset that brings new ones."""
    names = [f.name for f in schemas.FILES.fields]
    kept = files.join(new_files.select("dataset_id").distinct(), "dataset_id", "left_anti")
    return kept.select(*names).unionByName(new_files.select(*names))


def stale_datasets(datasets: DataFrame, current: DataFrame) -> DataFrame:
    """Active datasets missing from the scan of their campaign; ``current`` has (campaign, dataset_id)."""
    scanned = current.select("campaign").distinct()
    rows = datasets.filter(F.col("registration_status") == "ACTIVE").select("dataset_id", "campaign")
    return rows.join(scanned, "campaign", "left_semi").join(
        current.select("campaign", "dataset_id"), ["campaign", "dataset_id"], "left_anti"
    )


def retire(
    datasets: DataFrame, current: DataFrame, scans: DataFrame, now: dt.datetime, allow_empty: bool = False
) -> DataFrame:
    """Retire active datasets their campaign's scan no longer has.

    ``scans`` has one row per scanned campaign (campaign, scanned, failed). A campaign
    with failures, or with an empty scan unless allowed, is left alone.
    """
    trusted = scans.filter((F.col("failed") == 0) & ((F.col("scanned") > 0) | F.lit(allow_empty)))
    d = (
        datasets
        .join(trusted.select("campaign", F.lit(True).alias("_trusted")), "campaign", "left")
        .join(
            current.select("campaign", "dataset_id").distinct().withColumn("_seen", F.lit(True)),
            ["campaign", "dataset_id"], "left",
        )
    )
    gone = (
        (F.col("registration_status") == "ACTIVE") & F.col("_trusted").isNotNull() & F.col("_seen").isNull()
    )
    d = d.withColumn("_gone", gone)
    g = F.col("_gone")
    changes = {
        "registration_status": F.when(g, F.lit("RETIRED")).otherwise(F.col("registration_status")),
        "retired_at": F.when(g, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("retired_at")),
        "publication_claim_id": F.when(~g, F.col("publication_claim_id")),
        "publication_claimed_at": F.when(~g, F.col("publication_claimed_at")),
    }
    return d.select(*[changes.get(f.name, F.col(f.name)).alias(f.name) for f in schemas.DATASETS.fields])


def scan_totals(changes: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """Per campaign: scanned and failed mapfiles, from registration changes.

    ``campaigns`` (column campaign) names what was scanned, so that a campaign whose scan
    found nothing has a row too. A failed mapfile of no known campaign may belong to any:
    it counts as a failure of each.
    """
    found = changes.groupBy("campaign").agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("error").isNotNull()).alias("failed")
    )
    if campaigns is not None:
        named = campaigns.select("campaign").filter(F.col("campaign").isNotNull()).distinct()
        found = found.join(named, "campaign", "full_outer")
    # One row per campaign is left here, so the window is small.
    homeless = F.sum(F.when(F.col("campaign").isNull(), F.col("failed"))).over(Window.partitionBy(F.lit(0)))
    return found.select(
        "campaign", F.coalesce("scanned", F.lit(0)).cast("bigint").alias("scanned"),
        (F.coalesce("failed", F.lit(0)) + F.when(F.col("campaign").isNull(), F.lit(0)).otherwise(F.coalesce(homeless, F.lit(0))))
        .cast("bigint").alias("failed"),
    )


def last_mapfiles(changes: DataFrame) -> DataFrame:
    """Of several mapfiles of one dataset the last, in the order that state changes apply."""
    return changes.groupBy("dataset_id").agg(F.max("mapfile").alias("mapfile")).select("mapfile")


def repeated_paths(lines: DataFrame) -> DataFrame:
    """(mapfile, repeat_error) of mapfiles that list a file more than once."""
    p = parsed_lines(lines).filter("well_formed")
    twice = p.groupBy("mapfile", "file_path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy("mapfile").agg(F.min("file_path").alias("_path")).select(
        "mapfile", F.concat(F.lit("File listed more than once in "), F.col("mapfile"), F.lit(": "), F.col("_path")).alias("repeat_error")
    )


def registration_summary(
    datasets: DataFrame, changes: DataFrame, campaigns: DataFrame | None = None, allow_empty: bool = False
) -> DataFrame:
    """Per campaign: succeeded and failed mapfiles, current ids, and datasets to retire."""
    good = changes.filter(F.col("error").isNull())
    totals = changes.groupBy("campaign").agg(
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )
    if campaigns is not None:
        blocked = scan_totals(changes, campaigns).select("campaign", F.col("failed").alias("_blocked"))
        totals = blocked.join(totals, "campaign", "left").na.fill(0, ["succeeded", "failed"])
        if allow_empty:
            return _summary_of_all(datasets, good, totals)
    ids_now = good.select("campaign", "dataset_id").distinct()
    current = ids_now.groupBy("campaign").agg(F.count(F.lit(1)).alias("current"))
    stale = stale_datasets(datasets, ids_now).groupBy("campaign").agg(F.count(F.lit(1)).alias("stale"))
    j = totals.join(current, "campaign", "left").join(stale, "campaign", "left")
    retired = F.when(F.col("failed") == 0, F.coalesce(F.col("stale"), F.lit(0))).otherwise(F.lit(0))
    return j.select(
        "campaign", "succeeded", "failed", F.coalesce("current", F.lit(0)).alias("current"), retired.alias("retired")
    )


def _summary_of_all(datasets: DataFrame, good: DataFrame, totals: DataFrame) -> DataFrame:
    """The summary where an empty scan retires all of a campaign."""
    ids_now = good.select("campaign", "dataset_id").distinct()
    current = ids_now.groupBy("campaign").agg(F.count(F.lit(1)).alias("current"))
    active = datasets.filter(F.col("registration_status") == "ACTIVE").select("campaign", "dataset_id")
    stale = active.join(ids_now, ["campaign", "dataset_id"], "left_anti").groupBy("campaign").agg(F.count(F.lit(1)).alias("stale"))
    j = totals.join(current, "campaign", "left").join(stale, "campaign", "left").na.fill(0, ["current", "stale"])
    return j.select(
        "campaign", "succeeded", "failed", "current",
        F.when(F.col("_blocked") == 0, F.col("stale")).otherwise(F.lit(0)).alias("retired"),
    )


def replace_campaigns(campaigns: DataFrame, loaded: DataFrame) -> DataFrame:
    """Insert or replace campaigns by name."""
    names = [f.name for f in schemas.CAMPAIGNS.fields]
    kept = campaigns.join(loaded.select("name"), "name", "left_anti")
    return kept.select(*names).unionByName(loaded.select(*names))


def files_per_dataset(files: DataFrame) -> DataFrame:
    return files.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("file_size").alias("total_size")
    )
