"""Registered queries: changes of a keyed state, several writers, a followed log."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger.plans import state_changes
from mapledger.session import fresh_folder
from mapledger.sinks.keyed_state import KeyedState
from registry.common import CLAIM_NOW, CLAIM_TS, LEASE, NOW_TS, catalog_columns, set_columns
from registry.publishing import _EXPIRED, _FINAL, _HITS, _PUBLISHED, _log, _outcomes, _RUNNING, _running

Q, SQL = {}, {}


def _state(c, **frames) -> KeyedState:
    state = KeyedState(c.spark, fresh_folder(c.spark, "state"), state_changes.STREAMED, buckets=16)
    state.create({"datasets": catalog_columns(c.datasets), **frames}, CLAIM_TS)
    return state


# ---- merge on read ----


def _changed(c):
    """Mapfiles whose content changed: one in a hundred datasets."""
    return c.datasets.where("o_orderkey % 100 = 7").select(
        "dataset_id", "campaign", "project", "activity", "institution", "drs", "mapfile",
        F.concat(F.lit("new-"), F.col("o_orderkey").cast("string")).alias("mapfile_checksum"))


def _worked_on(c, compacted: bool = False) -> KeyedState:
    state = _state(c, files=c.files.select("dataset_id", "file_path", "file_size", "checksum", "mod_time"))
    state.update(state_changes.retry_failed("camp-2"), NOW_TS, job="retry")
    state.update(state_changes.register(_changed(c), NOW_TS), NOW_TS, job="register")
    if compacted:
        state.compact(NOW_TS)
    state.update(state_changes.remove(c.datasets.where("o_orderkey % 100 = 33").select("dataset_id")), NOW_TS, job="remove")
    # A job of a name that is committed already changes nothing.
    state.update(state_changes.retry_failed(), NOW_TS, job="retry")
    return state


_NEW = "(d.o_orderkey % 100 = 7)"
_RETRIED = "(d.registration_status = 'ACTIVE' and d.publication_status = 'FAILED' and d.campaign = 'camp-2')"
_MERGED = "select " + set_columns({
    "mapfile_checksum": f"case when {_NEW} then 'new-' || d.o_orderkey else d.mapfile_checksum end",
    "registration_status": f"case when {_NEW} then 'ACTIVE' else d.registration_status end",
    "retired_at": f"case when not {_NEW} then d.retired_at end",
    "publication_status": f"case when {_NEW} and d.mapfile_checksum is null then case when {_RETRIED} then 'PENDING' else d.publication_status end"
                          f" when {_NEW} or {_RETRIED} then 'PENDING' else d.publication_status end",
    **{n: f"case when not {_NEW} or d.mapfile_checksum is null then d.{n} end" for n in (
        "publication_claim_id", "publication_claimed_at", "archive_completed_at", "stac_checked_at", "stac_http_status")},
    "archive_status": f"case when {_NEW} and d.mapfile_checksum is not null then 'PENDING' else d.archive_status end",
    "stac_status": f"case when {_NEW} and d.mapfile_checksum is not null then 'UNCHECKED' else d.stac_status end",
}) + " from datasets d where d.o_orderkey % 100 <> 33"

Q["state_merged"] = lambda c: _worked_on(c).read("datasets")
SQL["state_merged"] = _MERGED
Q["state_compacted"] = lambda c: _worked_on(c, compacted=True).read("datasets")
SQL["state_compacted"] = _MERGED
Q["state_files"] = lambda c: _worked_on(c).read("files")
SQL["state_files"] = "select dataset_id, file_path, file_size, checksum, mod_time from files where o_orderkey % 100 <> 33"


def _delta_sizes(c):
    """Rows that each change wrote."""
    state = _worked_on(c)
    written = [
        c.spark.read.parquet(p["folder"]).groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(commit["job"]).alias("job"), F.lit(p["table"]).alias("table_name"), "n_rows")
        for commit in state.commits() if commit["job"] for p in commit["parts"]]
    out = written[0]
    for w in written[1:]:
        out = out.unionByName(w)
    return out


Q["state_delta_sizes"] = _delta_sizes
SQL["state_delta_sizes"] = f"""select * from (
  select 'retry' as job, 'datasets' as table_name, count(*) as n_rows from datasets d where {_RETRIED}
  union all select 'register', 'datasets', count(*) from datasets d where {_NEW}
  union all select 'remove', 'datasets', count(*) from datasets where o_orderkey % 100 = 33
  union all select 'remove', 'files', count(*) from files where o_orderkey % 100 = 33) s where n_rows > 0"""


def _outcomes_to_state(c):
    state = _state(c)
    state.update(state_changes.apply_outcomes(_outcomes(c), NOW_TS), NOW_TS, job="outcomes")
    return state.read("datasets").select("dataset_id", "publication_status", "publication_claim_id", "stac_status", "stac_http_status")


Q["state_outcomes"] = _outcomes_to_state
# Deferred members give their claim back only if their own run holds it.
SQL["state_outcomes"] = f"""with {_FINAL}, freed as (select distinct dataset_id, run_id from outcomes where clears_claim and new_status is null)
select d.dataset_id, coalesce(f.s, d.publication_status) as publication_status,
  case when f.s is null and r.run_id is null then d.publication_claim_id end as publication_claim_id,
  case when f.s is null then d.stac_status else 'UNCHECKED' end as stac_status, case when f.s is null then d.stac_http_status end as stac_http_status
from datasets d left join final f on f.dataset_id = d.dataset_id left join freed r on r.dataset_id = d.dataset_id and r.run_id = d.publication_claim_id"""

# ---- several writers ----


def _contended(c):
    """Two runs claim at once: the second commits while the first has planned on the same version."""
    state = _state(c, publication_attempts=_running(c))
    mine = state_changes.claim("run-a", CLAIM_TS, "camp-6", limit=25, timeout_seconds=LEASE)
    waiting = [state_changes.claim("run-b", CLAIM_TS, "camp-6", limit=20, timeout_seconds=LEASE)]

    def interrupted(read):
        planned = mine(read)
        if waiting:
            state.update(waiting.pop(), CLAIM_TS)
        return planned

    state.update(interrupted, CLAIM_TS)
    return state


_STALE = f"({_EXPIRED} and d.campaign = 'camp-6')"
Q["claim_contended"] = lambda c: _contended(c).read("datasets").select("dataset_id", "publication_claim_id", "publication_claimed_at")
SQL["claim_contended"] = f"""with free as (select d.dataset_id, row_number() over (order by d.dataset_id) as rn from datasets d
  where d.registration_status = 'ACTIVE' and d.publication_status = 'PENDING' and d.campaign = 'camp-6' and (d.publication_claim_id is null or {_EXPIRED}))
select d.dataset_id, case when rn <= 20 then 'run-b' when rn <= 45 then 'run-a' when not {_STALE} then d.publication_claim_id end as publication_claim_id,
  case when rn <= 45 then timestamp '{CLAIM_NOW}' when not {_STALE} then d.publication_claimed_at end as publication_claimed_at
from datasets d left join free f on f.dataset_id = d.dataset_id"""

Q["claim_contended_attempts"] = lambda c: _contended(c).read("publication_attempts").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
SQL["claim_contended_attempts"] = f"""with {_RUNNING} select case when a.status = 'RUNNING' and d.dataset_id is not null then 'ABANDONED' else a.status end as status, count(*) as n
from running a left join datasets d on d.dataset_id = a.dataset_id and d.publication_claim_id = a.run_id and {_STALE} group by 1"""

# ---- followed log ----


def _followed(c):
    """The log as run files, tailed in several micro-batches; one of them comes again with other lines."""
    folder, state = fresh_folder(c.spark, "followed"), _state(c)
    _log(c).select("run_id", F.concat_ws("\t", F.col("line_no").cast("string"), "line").alias("value")).repartition(
        "run_id", F.col("line_no") % 4).write.partitionBy("run_id").text(f"{folder}/in")
    lines = c.spark.readStream.format("text").schema("value string, run_id string").option("maxFilesPerTrigger", 2).load(f"{folder}/in").select(
        "run_id", F.substring_index("value", "\t", 1).cast("bigint").alias("line_no"), F.regexp_replace("value", r"^\d+\t", "").alias("line"))
    members = c.batch_members.groupBy("run_id", "dataset_id").agg(F.max("pos").alias("pos"))
    state_changes.follow_log(lines, state, members, NOW_TS, "log", f"{folder}/check").awaitTermination()
    again = _log(c).withColumn("line", F.replace("line", F.lit("=PASS"), F.lit("=FAIL"))).withColumn("line_no", F.col("line_no") + 10**12)
    state_changes.status_updates(state, members, NOW_TS, "log")(again.drop("batch_no"), 1)
    return state


Q["log_stream_state"] = lambda c: _followed(c).read("datasets")
SQL["log_stream_state"] = f"""with {_HITS}, known as (select distinct run_id, {_PUBLISHED} as emitted_id, dataset_id from batch_members),
final as (select k.dataset_id, arg_max(h.status, {{'r': h.run_id, 'l': h.line_no}}) as s from hits h join known k on k.run_id = h.run_id and k.emitted_id = h.emitted_id group by k.dataset_id)
select """ + set_columns({
    "publication_status": "coalesce(f.s, d.publication_status)",
    "publication_claim_id": "case when f.s is null then d.publication_claim_id end",
    "publication_claimed_at": "case when f.s is null then d.publication_claimed_at end",
    "stac_status": "case when f.s is null then d.stac_status else 'UNCHECKED' end",
    "stac_checked_at": "case when f.s is null then d.stac_checked_at end",
    "stac_http_status": "case when f.s is null then d.stac_http_status end"}) + " from datasets d left join final f on f.dataset_id = d.dataset_id"
