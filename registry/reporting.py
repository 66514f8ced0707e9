"""Registered queries: tables, reports, selections, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions.states import effective_status
from mapledger.operators import integrity, registration, reports, selections
from mapledger.sinks import outputs
from mapledger.session import drop_folder, fresh_folder, shuffles_freed
from registry.common import CLAIM_TS, LEASE, catalog_columns

Q, SQL = {}, {}

_LATEST = """latest as (select dataset_id, status as last_attempt_status, started_at, finished_at, log_file, attempt_id,
  row_number() over (partition by dataset_id order by finished_at desc nulls last, started_at desc nulls last, attempt_id desc nulls last) as rn
  from publication_attempts)"""

# ---- tables and latest attempts ----


def _tables(c):
    """Row counts and key fingerprints of all seven catalog tables, written and read back with their fixed schemas."""
    from mapledger.operators import reconcile
    from mapledger.sources.files import read_table
    from registry.items import _checks
    from registry.publishing import _diagnosed

    folder = fresh_folder(c.spark, "tables")

    def kept(df, path):
        with shuffles_freed(c.spark):
            df.write.option("compression", "zstd").parquet(f"{folder}/{path}")
        return c.spark.read.schema(df.schema).parquet(f"{folder}/{path}")

    checks = reconcile.check_rows(_checks(c), "stac-1", F.sha2("dataset_id", 256))
    frames = {"campaigns": lambda: c.campaigns, "datasets": lambda: c.datasets, "files": lambda: c.files,
              "publication_attempts": lambda: c.publication_attempts,
              "diagnostic_attempts": lambda: _diagnosed(c, lambda df, purpose: kept(df, f"parts/{purpose}")),
              "archive_tasks": lambda: c.archive_tasks, "stac_reconciliation_attempts": lambda: checks}
    rows = []
    for name, frame in frames.items():
        df = frame()
        kept(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[name].fields]), name)
        key = F.md5(F.concat_ws("|", *schemas.PRIMARY_KEYS[name]).cast("binary"))
        counted = read_table(c.spark, f"{folder}/{name}", name).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.conv(F.substr(key, F.lit(1), F.lit(8)), 16, 10).cast("bigint")).alias("key_sum"))
        rows.append((name, *counted.first()))
        # Each table goes before the next one is written: the disk holds one at a time.
        drop_folder(c.spark, folder)
    return c.spark.createDataFrame(rows, "table_name string, n_rows bigint, key_sum bigint")


def _tables_sql() -> str:
    from registry.items import SQL as items_sql
    from registry.publishing import SQL as publishing_sql

    keys = {t: " || '|' || ".join(schemas.PRIMARY_KEYS[t]) for t in schemas.TABLES}
    sources = {t: t for t in ("campaigns", "datasets", "files", "publication_attempts", "archive_tasks")} | {
        "diagnostic_attempts": f"({publishing_sql['diagnostic_outcome']}) q", "stac_reconciliation_attempts": f"({items_sql['check_history']}) q"}
    return " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows, cast(sum(cast('0x' || substr(md5({keys[t]}), 1, 8) as bigint)) as bigint) as key_sum from {sources[t]}"
        for t in schemas.TABLES)


Q["catalog_tables"] = _tables
SQL["catalog_tables"] = _tables_sql()

Q["latest_attempt"] = lambda c: reports.latest_attempt(c.publication_attempts)
SQL["latest_attempt"] = f"with {_LATEST} select dataset_id, attempt_id, last_attempt_status, started_at, finished_at, log_file from latest where rn = 1"

Q["ranked_attempts"] = lambda c: reports.ranked_attempts(c.publication_attempts).select("attempt_id", "dataset_id", "rn")
SQL["ranked_attempts"] = f"with {_LATEST} select attempt_id, dataset_id, rn from latest"

Q["status_latest_attempt"] = lambda c: reports.campaign_status(c.datasets, c.publication_attempts)
SQL["status_latest_attempt"] = f"""with {_LATEST}
select d.dataset_id, d.campaign, case when d.registration_status = 'RETIRED' then 'RETIRED' else d.publication_status end as publication_status,
  a.last_attempt_status, a.finished_at, a.log_file
from datasets d left join latest a on a.dataset_id = d.dataset_id and a.rn = 1"""

Q["effective_status"] = lambda c: c.datasets.select(
    "dataset_id", effective_status(F.col("registration_status"), F.col("publication_status")).alias("status"))
SQL["effective_status"] = "select dataset_id, case when registration_status = 'RETIRED' then 'RETIRED' else publication_status end as status from datasets"

# ---- reports ----

Q["failures"] = lambda c: reports.failures(c.datasets, c.publication_attempts)
SQL["failures"] = """select p.dataset_id, d.campaign, p.run_id, p.started_at, p.finished_at, p.status, p.exit_code, p.log_file, p.error_message
from publication_attempts p join datasets d on d.dataset_id = p.dataset_id where p.status = 'FAILED'"""

_SUMMARY = """count(*) as total, count(*) filter (where publication_status = 'SUCCESS') as published,
  count(*) filter (where publication_status = 'FAILED') as failed, count(*) filter (where publication_status = 'PENDING') as pending"""

Q["campaign_summary_status"] = lambda c: reports.campaign_summary(c.datasets)
SQL["campaign_summary_status"] = f"select campaign, {_SUMMARY} from datasets where registration_status = 'ACTIVE' group by campaign"

Q["campaign_counts"] = lambda c: reports.campaign_counts(c.datasets)
SQL["campaign_counts"] = "select campaign, count(*) as datasets from datasets where registration_status = 'ACTIVE' group by campaign"

Q["publication_counts"] = lambda c: reports.publication_counts(c.datasets)
SQL["publication_counts"] = "select publication_status, count(*) as datasets from datasets where registration_status = 'ACTIVE' group by publication_status"

Q["campaign_records"] = lambda c: reports.campaign_records(c.datasets, c.campaigns)
SQL["campaign_records"] = f"""select d.campaign, c.project, c.activity, c.institution, {_SUMMARY.replace('publication_status', 'd.publication_status')}
from datasets d join campaigns c on c.name = d.campaign where d.registration_status = 'ACTIVE' group by all"""

Q["campaign_rollup_join"] = lambda c: reports.active(c.datasets).join(
    c.campaigns.select(F.col("name").alias("campaign"), F.col("archive_root")), "campaign").select("dataset_id", "campaign", "archive_root")
SQL["campaign_rollup_join"] = """select d.dataset_id, d.campaign, c.archive_root from datasets d join campaigns c on c.name = d.campaign
where d.registration_status = 'ACTIVE'"""

Q["latest_success"] = lambda c: reports.latest_success(c.publication_attempts)
SQL["latest_success"] = "select dataset_id, max(case when status = 'SUCCESS' then finished_at end) as latest_success from publication_attempts group by dataset_id"

Q["files_per_dataset"] = lambda c: registration.files_per_dataset(c.files)
SQL["files_per_dataset"] = "select dataset_id, count(*) as n_files, cast(sum(file_size) as bigint) as total_size from files group by dataset_id"

Q["recent_failures"] = lambda c: reports.newest_first(reports.failures(c.datasets, c.publication_attempts)).select(
    "dataset_id", "run_id", "started_at")
SQL["recent_failures"] = """select p.dataset_id, p.run_id, p.started_at from publication_attempts p join datasets d on d.dataset_id = p.dataset_id
where p.status = 'FAILED' order by p.started_at desc nulls last"""

Q["examples"] = lambda c: reports.examples(
    c.datasets.filter(F.col("publication_status") == "FAILED").select("dataset_id"), "dataset_id", 20)
SQL["examples"] = """select dataset_id, greatest((select count(*) from datasets where publication_status = 'FAILED') - 20, 0) as not_shown
from datasets where publication_status = 'FAILED' order by dataset_id limit 20"""

# ---- selections ----

Q["pending"] = lambda c: selections.pending(c.datasets, None)
SQL["pending"] = "select dataset_id, mapfile from datasets where registration_status = 'ACTIVE' and publication_status = 'PENDING'"

Q["pending_zero_limit"] = lambda c: selections.pending(c.datasets, "camp-3", 0)
SQL["pending_zero_limit"] = SQL["pending"] + " and campaign = 'camp-3'"


def _excluded(c):
    return c.datasets.filter(F.col("o_orderkey") % 3 == 0)


Q["claimable"] = lambda c: selections.claimable(c.datasets, None, exclude=_excluded(c))
SQL["claimable"] = """select dataset_id, mapfile, publication_status from datasets where registration_status = 'ACTIVE'
and publication_status = 'PENDING' and publication_claim_id is null
and dataset_id not in (select dataset_id from datasets where o_orderkey % 3 = 0)"""

Q["ordered_limit"] = lambda c: selections.claimable(c.datasets, "camp-5", limit=40)
SQL["ordered_limit"] = """select dataset_id, mapfile, publication_status from datasets where registration_status = 'ACTIVE'
and publication_status = 'PENDING' and publication_claim_id is null and campaign = 'camp-5' order by dataset_id limit 40"""

Q["failed_datasets"] = lambda c: selections.failed(c.datasets, None)
SQL["failed_datasets"] = "select dataset_id, mapfile, publication_status from datasets where registration_status = 'ACTIVE' and publication_status = 'FAILED'"

Q["archivable"] = lambda c: selections.archivable(c.datasets)
SQL["archivable"] = """select dataset_id, campaign, mapfile, mapfile_checksum, archive_status from datasets
where registration_status = 'ACTIVE' and publication_status = 'SUCCESS' and archive_status = 'PENDING'"""

Q["reconcile_scope"] = lambda c: selections.reconcile_scope(c.datasets, scope="successful", ids=_excluded(c))
SQL["reconcile_scope"] = """select dataset_id, campaign, project, publication_status from datasets
where registration_status = 'ACTIVE' and publication_status = 'SUCCESS' and o_orderkey % 3 = 0"""

Q["failed_publications"] = lambda c: reports.failed_publications(c.datasets)
SQL["failed_publications"] = """select dataset_id, publication_status, mapfile from datasets
where registration_status = 'ACTIVE' and publication_status <> 'PENDING' and publication_status <> 'SUCCESS'"""

Q["campaign_lookup"] = lambda c: selections.campaign_lookup(c.campaigns, "camp-7")
SQL["campaign_lookup"] = "select name, project, activity, institution, mapfile_root, archive_root, archive_depth from campaigns where name = 'camp-7'"

Q["campaign_list"] = lambda c: selections.campaign_list(c.campaigns)
SQL["campaign_list"] = "select name, project, activity, institution, mapfile_root from campaigns"

Q["expired_claims_selection"] = lambda c: selections.expired(c.datasets, CLAIM_TS, LEASE).select("dataset_id", "publication_claim_id")
SQL["expired_claims_selection"] = """select dataset_id, publication_claim_id from datasets where registration_status = 'ACTIVE'
and publication_status = 'PENDING' and publication_claimed_at < timestamp '2024-01-30 23:00:00'"""

# ---- integrity ----


def _damaged(c):
    k = F.col("o_orderkey")
    return c.datasets.withColumns({
        "publication_status": F.when(k % 211 == 0, F.lit("LOST")).when(k % 223 == 0, F.lit(None)).otherwise(F.col("publication_status")),
        "stac_status": F.when(k % 227 == 0, F.lit("?")).otherwise(F.col("stac_status")),
    })


_DAMAGED = """damaged as (select * replace (
  case when o_orderkey % 211 = 0 then 'LOST' when o_orderkey % 223 = 0 then null else publication_status end as publication_status,
  case when o_orderkey % 227 = 0 then '?' else stac_status end as stac_status) from datasets)"""

Q["invalid_states"] = lambda c: integrity.invalid_states(_damaged(c))
SQL["invalid_states"] = f"""with {_DAMAGED} select dataset_id, registration_status, publication_status, archive_status, stac_status from damaged
where registration_status not in ('ACTIVE', 'RETIRED') or publication_status not in ('PENDING', 'SUCCESS', 'FAILED')
or archive_status not in ('PENDING', 'SUCCESS') or stac_status not in ('UNCHECKED', 'WAITING', 'PRESENT', 'ABSENT', 'MISMATCH', 'ERROR')"""

Q["invalid_state_examples"] = lambda c: integrity.invalid_states(_damaged(c), 5)
SQL["invalid_state_examples"] = SQL["invalid_states"] + " order by dataset_id limit 5"

Q["key_violations"] = lambda c: integrity.duplicate_keys(
    c.files.unionByName(c.files.filter(F.col("o_orderkey") % 50 == 0)), schemas.PRIMARY_KEYS["files"])
SQL["key_violations"] = """select dataset_id, file_path, count(*) as n_rows from (select * from files union all select * from files where o_orderkey % 50 = 0) f
group by dataset_id, file_path having count(*) > 1"""

Q["null_violations"] = lambda c: integrity.null_violations(_damaged(c), schemas.DATASETS)
SQL["null_violations"] = f"with {_DAMAGED} select 'publication_status' as column_name, count(*) as n_null from damaged where publication_status is null having count(*) > 0"

Q["orphan_datasets"] = lambda c: integrity.orphan_datasets(c.datasets, c.campaigns)
SQL["orphan_datasets"] = "select dataset_id, campaign from datasets where campaign not in (select name from campaigns)"


def _upgrade(c):
    old = c.datasets.select("dataset_id", "publication_status", F.when(F.col("o_orderkey") % 2 == 0, F.col("archive_status")).alias("archive_status"))
    return integrity.upgrade_datasets(old)


Q["schema_upgrade"] = _upgrade
SQL["schema_upgrade"] = """select dataset_id, publication_status, case when o_orderkey % 2 = 0 then archive_status else 'PENDING' end as archive_status,
  cast(null as varchar) as mapfile_checksum, 'ACTIVE' as registration_status, cast(null as timestamp) as retired_at, 'UNCHECKED' as stac_status,
  cast(null as timestamp) as stac_checked_at, cast(null as integer) as stac_http_status, cast(null as varchar) as publication_claim_id,
  cast(null as timestamp) as publication_claimed_at from datasets"""

Q["schema_upgrade_attempts"] = lambda c: integrity.upgrade_attempts(
    c.publication_attempts.withColumn("attempt_id", F.when(F.col("exit_code") == 0, F.col("attempt_id"))),
    F.sha2(F.concat_ws("|", "dataset_id", "run_id", F.col("started_at").cast("string")), 256)).select("attempt_id", "dataset_id", "run_id")
SQL["schema_upgrade_attempts"] = """select coalesce(case when exit_code = 0 then attempt_id end,
  sha256(concat(dataset_id, '|', run_id, '|', cast(started_at as varchar)))) as attempt_id, dataset_id, run_id from publication_attempts"""

# ---- CSV reports: written, then read back ----


def _export(c, df, fields):
    return outputs.read_back(c.spark, outputs.write_csv(df, fresh_folder(c.spark, "export"), fields), fields)


def _csv_ts(col: str) -> str:
    return (f"case when {col} is null then null when date_part('microsecond', {col}) % 1000000 = 0 then strftime({col}, '%Y-%m-%d %H:%M:%S') "
            f"else strftime({col}, '%Y-%m-%d %H:%M:%S.%f') end")


Q["export_status"] = lambda c: _export(
    c, reports.by_campaign(reports.campaign_status(c.datasets, c.publication_attempts)), schemas.STATUS_FIELDS)
SQL["export_status"] = f"""with {_LATEST}
select d.dataset_id, d.campaign, case when d.registration_status = 'RETIRED' then 'RETIRED' else d.publication_status end as publication_status,
  a.last_attempt_status, {_csv_ts('a.finished_at')} as finished_at, a.log_file
from datasets d left join latest a on a.dataset_id = d.dataset_id and a.rn = 1"""

Q["export_summary"] = lambda c: _export(c, reports.campaign_summary(c.datasets).orderBy("campaign"), schemas.SUMMARY_FIELDS)
SQL["export_summary"] = f"""select campaign, cast(total as varchar) as total, cast(published as varchar) as published,
  cast(failed as varchar) as failed, cast(pending as varchar) as pending from ({SQL['campaign_summary_status']}) s"""

Q["export_failures"] = lambda c: _export(
    c, reports.newest_first(reports.failures(c.datasets, c.publication_attempts)), schemas.FAILURE_FIELDS)
SQL["export_failures"] = f"""select p.dataset_id, d.campaign, p.run_id, {_csv_ts('p.started_at')} as started_at, {_csv_ts('p.finished_at')} as finished_at,
  p.status, cast(p.exit_code as varchar) as exit_code, p.log_file, p.error_message
from publication_attempts p join datasets d on d.dataset_id = p.dataset_id where p.status = 'FAILED'"""


def _history(c):
    path = fresh_folder(c.spark, "history")
    a = c.publication_attempts
    good = F.coalesce(F.col("status") == "SUCCESS", F.lit(False))
    # The second part is written twice, as a retried job would.
    for part, rows in (("good", good), ("rest", ~good), ("rest", ~good)):
        outputs.append_history(a.filter(rows), path, part=part)
    back = c.spark.read.schema(schemas.ATTEMPTS).parquet(path)
    return back.select("attempt_id", "dataset_id", "run_id", "started_at", "status", "exit_code")


Q["append_history"] = _history
SQL["append_history"] = "select attempt_id, dataset_id, run_id, started_at, status, exit_code from publication_attempts"


def _state(c):
    root = fresh_folder(c.spark, "state")
    d = catalog_columns(c.datasets)
    outputs.write_state(d, root, 1, CLAIM_TS)
    old = outputs.read_state(c.spark, root, schemas.DATASETS)
    outputs.write_state(old.withColumn("publication_status", F.lit("PENDING")), root, 2, CLAIM_TS)
    return outputs.read_state(c.spark, root, schemas.DATASETS).select("dataset_id", "publication_status", "mapfile_checksum", "registered_at")


Q["write_state"] = _state
SQL["write_state"] = "select dataset_id, 'PENDING' as publication_status, mapfile_checksum, registered_at from datasets"
