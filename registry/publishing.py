"""Registered queries: claims, batches, publisher output, outcomes, diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import logs, similarity
from mapledger.operators import batching, diagnostics, items, publication, reports
from mapledger.functions.schema_rules import flatten_schemas
from mapledger.session import fresh_folder
from mapledger.sinks import outputs
from mapledger.sources import files as sources
from registry.common import CLAIM_NOW, CLAIM_TS, LEASE, NOW, NOW_TS, catalog_columns, set_columns

Q, SQL = {}, {}
_SCOPE = ["run_id", "batch_no"]
_EXPIRED = """(d.registration_status = 'ACTIVE' and d.publication_status = 'PENDING' and d.publication_claimed_at is not null
  and d.publication_claimed_at < timestamp '2024-01-30 23:00:00')"""

# ---- claims ----

Q["expire_claims"] = lambda c: publication.expire_claims(catalog_columns(c.datasets), CLAIM_TS, LEASE)
SQL["expire_claims"] = "select " + set_columns({
    "publication_claim_id": f"case when not {_EXPIRED} then d.publication_claim_id end",
    "publication_claimed_at": f"case when not {_EXPIRED} then d.publication_claimed_at end"}) + " from datasets d"


def _running(c):
    """Attempts that also cover the runs holding stale claims."""
    extra = c.datasets.filter(F.col("publication_claim_id").isNotNull()).select(
        F.concat(F.lit("held-"), F.col("o_orderkey").cast("string")).alias("attempt_id"), "dataset_id",
        F.col("publication_claim_id").alias("run_id"), F.col("publication_claimed_at").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("UNREACHED")).otherwise(F.lit("RUNNING")).alias("status"),
        F.lit(None).cast("int").alias("exit_code"), F.lit(None).cast("string").alias("log_file"), F.lit(None).cast("string").alias("error_message"))
    return c.publication_attempts.unionByName(extra)


_RUNNING = """running as (select attempt_id, dataset_id, run_id, started_at, finished_at, status, exit_code, log_file, error_message from publication_attempts
  union all select 'held-' || o_orderkey, dataset_id, publication_claim_id, publication_claimed_at, null, case when o_orderkey % 3 = 0 then 'UNREACHED' else 'RUNNING' end, null, null, null
  from datasets where publication_claim_id is not null)"""

Q["expired_attempts"] = lambda c: publication.expired_attempts(_running(c), c.datasets, CLAIM_TS, LEASE).select("attempt_id", "dataset_id", "run_id")
SQL["expired_attempts"] = f"""with {_RUNNING} select a.attempt_id, a.dataset_id, a.run_id from running a join datasets d
on d.dataset_id = a.dataset_id and d.publication_claim_id = a.run_id where a.status = 'RUNNING' and {_EXPIRED}"""

Q["abandon_attempts"] = lambda c: publication.abandon_attempts(_running(c), c.datasets, CLAIM_TS, LEASE)
SQL["abandon_attempts"] = f"""with {_RUNNING}, j as (select a.*, a.status = 'RUNNING' and d.dataset_id is not null as hit from running a
  left join datasets d on d.dataset_id = a.dataset_id and d.publication_claim_id = a.run_id and {_EXPIRED})
select attempt_id, dataset_id, run_id, started_at, case when hit then timestamp '{CLAIM_NOW}' else finished_at end as finished_at,
  case when hit then 'ABANDONED' else status end as status, exit_code, log_file, case when hit then 'Publication claim lease expired' else error_message end as error_message from j"""


def _claim_sql(limit: str) -> str:
    free = f"(d.publication_claim_id is null or {_EXPIRED})"
    mine = f"d.dataset_id in (select d.dataset_id from datasets d where d.registration_status = 'ACTIVE' and d.publication_status = 'PENDING' and {free} and d.campaign = 'camp-6' {limit})"
    stale = f"({_EXPIRED} and d.campaign = 'camp-6')"
    return "select " + set_columns({
        "publication_claim_id": f"case when {mine} then 'run-new' when not {stale} then d.publication_claim_id end",
        "publication_claimed_at": f"case when {mine} then timestamp '{CLAIM_NOW}' when not {stale} then d.publication_claimed_at end"}) + " from datasets d"


Q["claim"] = lambda c: publication.claim(catalog_columns(c.datasets), "run-new", CLAIM_TS, "camp-6", timeout_seconds=LEASE)
SQL["claim"] = _claim_sql("")
Q["claim_limited"] = lambda c: publication.claim(catalog_columns(c.datasets), "run-new", CLAIM_TS, "camp-6", limit=25, timeout_seconds=LEASE)
SQL["claim_limited"] = _claim_sql("order by d.dataset_id limit 25")

Q["retry_failed"] = lambda c: publication.retry_failed(catalog_columns(c.datasets))
SQL["retry_failed"] = "select " + set_columns({
    "publication_status": "case when d.registration_status = 'ACTIVE' and d.publication_status = 'FAILED' then 'PENDING' else d.publication_status end"}) + " from datasets d"

Q["retry_failed_limited"] = lambda c: publication.retry_failed(catalog_columns(c.datasets), "camp-2", 30).select("dataset_id", "publication_status")
SQL["retry_failed_limited"] = """select dataset_id, case when dataset_id in (select dataset_id from datasets where registration_status = 'ACTIVE' and publication_status = 'FAILED'
  and campaign = 'camp-2' order by dataset_id limit 30) then 'PENDING' else publication_status end as publication_status from datasets"""

# ---- batches ----

Q["batch_plan"] = lambda c: batching.batch_plan(
    c.datasets.filter(F.col("publication_status") == "PENDING").select("campaign", "dataset_id", "mapfile"), 50)
SQL["batch_plan"] = """select campaign, dataset_id, mapfile, cast((rn - 1) // 50 + 1 as bigint) as batch_no, cast((rn - 1) % 50 as bigint) as batch_pos
from (select *, row_number() over (partition by campaign order by dataset_id) as rn from datasets where publication_status = 'PENDING') s"""

Q["batch_numbers"] = lambda c: batching.batch_plan(c.datasets.select("dataset_id"), 50, groups=())
SQL["batch_numbers"] = """select dataset_id, cast((rn - 1) // 50 + 1 as bigint) as batch_no, cast((rn - 1) % 50 as bigint) as batch_pos
from (select dataset_id, row_number() over (order by dataset_id) as rn from datasets) s"""

_STAGED = """staged0 as (select *, min(case when stage_error is null then pos end) over (partition by run_id, batch_no, split_part(mapfile, '/', -1)) as first_pos from batch_members),
  staged as (select run_id, batch_no, pos, dataset_id, mapfile, case when pos > first_pos then 'ValueError: Duplicate mapfile basename in batch: ' || split_part(mapfile, '/', -1) else stage_error end as stage_error from staged0)"""

Q["duplicate_basenames"] = lambda c: publication.staged_members(c.batch_members, _SCOPE)
SQL["duplicate_basenames"] = f"with {_STAGED} select * from staged"

# ---- publisher output ----


def _log(c):
    return c.publisher_log.select("run_id", "batch_no", "line_no", "line")


_PAT = r"PUB_STATUS=(PASS|FAIL)\s+id=([^\s|]+)(?:\|\S+)?"
_PUBLISHED = "regexp_extract(dataset_id, '^(.*)#', 1) || '.v' || split_part(dataset_id, '#', -1)"
_HITS = f"""hits as (select run_id, batch_no, line_no, case when regexp_extract(line, '{_PAT}', 1) = 'PASS' then 'SUCCESS' else 'FAILED' end as status,
    regexp_extract(line, '{_PAT}', 2) as emitted_id from publisher_log where regexp_matches(line, '{_PAT}'))"""

Q["publisher_log_scan"] = lambda c: c.publisher_log.groupBy(*_SCOPE).agg(
    F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("line").contains(logs.STATUS_MARK)).alias("n_status"),
    F.count_if(logs.is_error_line(F.col("line"))).alias("n_error"))
SQL["publisher_log_scan"] = """select run_id, batch_no, count(*) as n_lines, count(*) filter (where contains(line, 'PUB_STATUS=')) as n_status,
  count(*) filter (where contains(line, ' ERROR ') or starts_with(line, 'ERROR')) as n_error from publisher_log group by run_id, batch_no"""



def _log_files(c):
    """Log files by run with a heading above each batch, read back."""
    folder = fresh_folder(c.spark, "logs")
    headings = c.publisher_log.select("run_id", "batch_no").distinct().select(
        "run_id", "batch_no", F.lit(-1).cast("bigint").alias("line_no"), F.concat(F.lit("Batch: "), F.col("batch_no").cast("string")).alias("line"))
    order = ["run_id", "batch_no", "line_no"]
    _log(c).unionByName(headings).repartition("run_id").sortWithinPartitions(*order).select("run_id", F.col("line").alias("value")).write.partitionBy(
        "run_id").text(folder)
    return sources.read_logs(c.spark, folder)


Q["publisher_log_files"] = lambda c: _log_files(c).filter(~F.col("line").startswith("Batch: ")).groupBy("run_id", "batch_no").agg(
    F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("line").contains(logs.STATUS_MARK)).alias("n_status"),
    F.count_if(logs.is_error_line(F.col("line"))).alias("n_error"))
SQL["publisher_log_files"] = f"select run_id, cast(batch_no as varchar) as batch_no, n_lines, n_status, n_error from ({SQL['publisher_log_scan']}) s"

Q["log_file_errors"] = lambda c: publication.error_texts(_log_files(c), _SCOPE)

Q["pub_status_matches"] = lambda c: publication.reported_statuses(_log(c), _SCOPE)
SQL["pub_status_matches"] = f"with {_HITS} select run_id, batch_no, line_no, 0 as match_no, status, emitted_id from hits"

Q["error_message"] = lambda c: publication.error_texts(_log(c), _SCOPE)
_ERRORS = """errors as (select run_id, batch_no, coalesce(arg_max(trim(line), line_no) filter (where contains(line, ' ERROR ') or starts_with(line, 'ERROR')),
    arg_max(trim(line), line_no) filter (where contains(line, 'PUB_STATUS=FAIL'))) as error_text from publisher_log
  where contains(line, ' ERROR ') or starts_with(line, 'ERROR') or contains(line, 'PUB_STATUS=FAIL') group by run_id, batch_no)"""
SQL["error_message"] = f"with {_ERRORS} select * from errors"
SQL["log_file_errors"] = f"with {_ERRORS} select run_id, cast(batch_no as varchar) as batch_no, error_text from errors"


def _members(c):
    return c.batch_members.filter(F.col("pos") % 7 != 0)


Q["status_alias"] = lambda c: publication.resolve_statuses(_log(c), _members(c), _SCOPE)
_RESOLVED = f"""{_HITS}, known as (select run_id, batch_no, {_PUBLISHED} as emitted_id, arg_max(dataset_id, pos) as dataset_id from batch_members where pos % 7 <> 0 group by all),
  resolved as (select h.run_id, h.batch_no, h.line_no, h.status, h.emitted_id, k.dataset_id from hits h left join known k using (run_id, batch_no, emitted_id))"""
SQL["status_alias"] = f"with {_RESOLVED} select run_id, batch_no, emitted_id, line_no, 0 as match_no, status, dataset_id from resolved"

Q["last_status"] = lambda c: publication.last_statuses(
    publication.resolve_statuses(
        _log(c), c.batch_members.groupBy("run_id", "dataset_id").agg(F.max("pos").alias("pos")), ["run_id"]), ["run_id"])
SQL["last_status"] = f"""with {_HITS}, known as (select distinct run_id, {_PUBLISHED} as emitted_id, dataset_id from batch_members)
select h.run_id, k.dataset_id, arg_max(h.status, h.line_no) as status from hits h join known k on k.run_id = h.run_id and k.emitted_id = h.emitted_id group by h.run_id, k.dataset_id"""

# ---- outcomes ----


def _outcomes(c, record=True):
    return publication.batch_outcomes(c.batch_members, c.batch_runs, _log(c), record, 600)


def _outcomes_cte(record: str) -> str:
    return f"""{_STAGED}, {_HITS}, {_ERRORS},
  said as (select h.run_id, h.batch_no, s.dataset_id, arg_max(h.status, h.line_no) as reported from hits h join staged s on s.run_id = h.run_id and s.batch_no = h.batch_no
    and s.stage_error is null and {_PUBLISHED.replace('dataset_id', 's.dataset_id')} = h.emitted_id group by h.run_id, h.batch_no, s.dataset_id),
  told as (select s.*, x.reported from staged s left join said x using (run_id, batch_no, dataset_id)),
  totals as (select run_id, batch_no, count(reported) as n_reported, count(stage_error) as n_refused, min(case when stage_error is null then pos end) as first_pos from told group by run_id, batch_no),
  facts as (select t.*, b.exit_code, b.timed_out, b.output_length, b.batch_error, b.log_file, e.error_text, n_reported, n_refused, first_pos,
    n_reported = 0 and n_refused = 0 and {record} as silent from told t join batch_runs b using (run_id, batch_no) join totals using (run_id, batch_no) left join errors e using (run_id, batch_no)),
  outcomes as (select run_id, batch_no, pos, dataset_id,
    case when stage_error is not null or batch_error is not null then 'FAILED' when reported is not null then reported when silent and pos = first_pos then case when timed_out then 'TIMEOUT' else 'NO_STATUS' end else 'UNREACHED' end as attempt_status,
    case when stage_error is not null or batch_error is not null then -1 else exit_code end as exit_code,
    case when stage_error is not null then stage_error when batch_error is not null then batch_error when reported = 'FAILED' then error_text when reported is not null then null
      when silent and pos = first_pos then case when timed_out then 'esgpublish timed out after 600 seconds' when coalesce(error_text, '') <> '' then error_text
        else 'esgpublish returned no recognizable PUB_STATUS line (exit code ' || exit_code || ', output length ' || output_length || ')' end
      else 'Publisher emitted no status for this dataset' end as error_message,
    case when stage_error is not null or batch_error is not null then 'FAILED' else reported end as new_status,
    stage_error is not null or batch_error is not null or reported is not null or (silent and pos = first_pos) as clears_claim,
    stage_error is not null or batch_error is not null or reported is not null as counted, log_file from facts)"""


Q["batch_outcomes"] = lambda c: _outcomes(c)
SQL["batch_outcomes"] = f"with {_outcomes_cte('true')} select * from outcomes"
Q["batch_outcomes_retrying"] = lambda c: _outcomes(c, False)
SQL["batch_outcomes_retrying"] = f"with {_outcomes_cte('false')} select * from outcomes"

Q["attempt_text"] = lambda c: _outcomes(c).filter(~F.col("counted")).select("run_id", "batch_no", "dataset_id", "attempt_status", "error_message")
SQL["attempt_text"] = f"with {_outcomes_cte('true')} select run_id, batch_no, dataset_id, attempt_status, error_message from outcomes where not counted"

Q["run_summary"] = lambda c: publication.run_summary(_outcomes(c))
SQL["run_summary"] = f"""with {_outcomes_cte('true')} select run_id, count(*) filter (where counted) as total, count(*) filter (where counted and attempt_status = 'SUCCESS') as success,
  count(*) filter (where counted and attempt_status <> 'SUCCESS') as failed, count(*) filter (where attempt_status in ('NO_STATUS', 'TIMEOUT')) as deferred from outcomes group by run_id"""

Q["run_failures"] = lambda c: publication.run_failures(_outcomes(c))
SQL["run_failures"] = f"with {_outcomes_cte('true')} select run_id, dataset_id, exit_code, error_message from outcomes where counted and attempt_status <> 'SUCCESS'"

Q["unreached"] = lambda c: publication.unreached(c.batch_members, _outcomes(c).filter("counted")).select("run_id", "batch_no", "pos", "dataset_id")
SQL["unreached"] = f"with {_outcomes_cte('true')} select run_id, batch_no, pos, dataset_id from outcomes where not counted"

Q["attempts_by_run"] = lambda c: reports.attempts_by_run(c.publication_attempts)
SQL["attempts_by_run"] = """select run_id, count(*) as total, count(*) filter (where status = 'SUCCESS') as success, count(*) filter (where status = 'FAILED') as failed
from publication_attempts where status in ('SUCCESS', 'FAILED') group by run_id"""


def _applied(c):
    return publication.apply_results(catalog_columns(c.datasets), publication.final_results(_outcomes(c)))


Q["apply_result"] = _applied
_FINAL = f"""{_outcomes_cte('true')}, final as (select dataset_id, arg_max(new_status, {{'r': run_id, 'b': batch_no, 'p': pos}}) as s from outcomes where new_status is not null group by dataset_id)"""
SQL["apply_result"] = f"with {_FINAL} select " + set_columns({
    "publication_status": "coalesce(f.s, d.publication_status)",
    "publication_claim_id": "case when f.s is null then d.publication_claim_id end",
    "publication_claimed_at": "case when f.s is null then d.publication_claimed_at end",
    "stac_status": "case when f.s is null then d.stac_status else 'UNCHECKED' end",
    "stac_checked_at": "case when f.s is null then d.stac_checked_at end",
    "stac_http_status": "case when f.s is null then d.stac_http_status end"}) + " from datasets d left join final f on f.dataset_id = d.dataset_id"


def _released(c):
    k = F.col("o_orderkey")
    return c.datasets.filter(k % 2 == 0).select(
        "dataset_id", F.when(k % 4 == 0, F.lit("run-1")).alias("claim_id"))


Q["clear_claim"] = lambda c: publication.clear_claims(c.datasets.select(*schemas.DATASETS.names), _released(c))
_REL = "(d.o_orderkey % 2 = 0 and (d.o_orderkey % 4 <> 0 or coalesce(d.publication_claim_id, '') = 'run-1'))"
SQL["clear_claim"] = "select " + set_columns({
    "publication_claim_id": f"case when not {_REL} then d.publication_claim_id end",
    "publication_claimed_at": f"case when not {_REL} then d.publication_claimed_at end"}) + " from datasets d"


def _finished(c):
    return c.publication_attempts.filter(F.col("status") == "RUNNING").select(
        "attempt_id", F.lit("UNREACHED").alias("status"), F.lit(3).alias("exit_code"), F.lit("/l").alias("log_file"), F.lit("e").alias("error_message"))


Q["finish_attempt"] = lambda c: publication.finish_attempts(c.publication_attempts, _finished(c), NOW_TS)
SQL["finish_attempt"] = f"""select attempt_id, dataset_id, run_id, started_at, case when status = 'RUNNING' then timestamp '{NOW}' else finished_at end as finished_at,
  case when status = 'RUNNING' then 'UNREACHED' else status end as status, case when status = 'RUNNING' then 3 else exit_code end as exit_code,
  case when status = 'RUNNING' then '/l' else log_file end as log_file, case when status = 'RUNNING' then 'e' else error_message end as error_message from publication_attempts"""

Q["new_attempts_of_batch"] = lambda c: publication.new_attempts(
    c.batch_members.filter(F.col("stage_error").isNull()), NOW_TS, F.sha2(F.concat_ws("|", "run_id", F.col("batch_no").cast("string"), "dataset_id"), 256))
SQL["new_attempts_of_batch"] = f"""select sha256(run_id || '|' || batch_no || '|' || dataset_id) as attempt_id, dataset_id, run_id, timestamp '{NOW}' as started_at, cast(null as timestamp) as finished_at,
  'RUNNING' as status, cast(null as integer) as exit_code, cast(null as varchar) as log_file, cast(null as varchar) as error_message from batch_members where stage_error is null"""

# ---- diagnostics ----

# Expected suggestions, worked out by hand with the similarity rule (cutoff 0.75).
_SUGGESTED = "case rejected_value when 'air_temperatur' then 'air_temperature' end"
_SERVER = r"Failed to publish: Error (\d+):\s*(\{.*\})"
_BODY = f"""server as (select run_id, batch_no, line_no, cast(regexp_extract(line, '{_SERVER}', 1) as int) as code, regexp_extract(line, '{_SERVER}', 2) as body
    from publisher_log where regexp_matches(line, '{_SERVER}')),
  detail as (select *, json_valid(body) as ok, case when json_valid(body) then coalesce(nullif(json_extract_string(body, '$.detail'), ''), nullif(json_extract_string(body, '$.title'), ''), '') end as detail from server),
  named as (select *, nullif(regexp_extract(detail, 'failed validation against `([^`]+)`', 1), '') as schema_url,
    nullif(regexp_extract(detail, '`:\\s*''(.+?)'' is not one of (\\[.*\\])$', 1), '') as rejected_value from detail),
  server_fields as (select *, {_SUGGESTED} as suggested_value,
    case when ok then coalesce(cast(json_extract_string(body, '$.status_code') as int), code) else code end as http_status,
    case when ok then json_extract_string(body, '$.type') end as error_type, case when ok then json_extract_string(body, '$.instance') end as server_instance,
    case when not ok then 'Publisher server returned HTTP ' || code || '.'
      when rejected_value is not null and schema_url is not null then 'STAC validation failed against ' || schema_url || ': ''' || rejected_value || ''' is not an allowed value.'
        || coalesce(' Likely accepted value: ''' || {_SUGGESTED} || '''.', '')
      when length(detail) > 1000 then detail[1:997] || '...' when detail <> '' then detail else 'Publisher server returned HTTP ' || code || '.' end as summary from named)"""
_FIELDS = "http_status, error_type, schema_url, rejected_value, suggested_value, summary, server_instance"

Q["server_diagnostic"] = lambda c: diagnostics.server_errors(_log(c), _SCOPE)
SQL["server_diagnostic"] = f"""with {_BODY}, last as (select run_id, batch_no, max(line_no) as line_no from server group by run_id, batch_no)
select run_id, batch_no, {_FIELDS} from server_fields join last using (run_id, batch_no, line_no)"""

Q["server_diagnostic_lines"] = lambda c: diagnostics.line_errors(_log(c)).drop("line")
SQL["server_diagnostic_lines"] = f"with {_BODY} select run_id, batch_no, line_no, {_FIELDS} from server_fields"

Q["enum_failure"] = lambda c: diagnostics.enum_failures(_log(c))
SQL["enum_failure"] = f"with {_BODY} select run_id, batch_no, line_no, rejected_value, suggested_value from server_fields where rejected_value is not null"

Q["closest_choice"] = lambda c: c.datasets.select("dataset_id", F.concat(F.lit('"'), F.when(F.col("o_orderkey") % 3 == 0, "publshed").when(
    F.col("o_orderkey") % 3 == 1, "retractd").otherwise("zzz"), F.lit('"')).alias("v")).select(
    "dataset_id", logs.closest_choice(F.col("v"), F.lit('["published", "retracted"]')).alias("suggested"))
SQL["closest_choice"] = "select dataset_id, case o_orderkey % 3 when 0 then 'published' when 1 then 'retracted' end as suggested from datasets"


def _rejected_words(c):
    """Words of campaign activities with a letter dropped, against all activities: values and choices from the tables."""
    words = c.campaigns.agg(F.sort_array(F.collect_set("activity")).alias("choices"))
    cut = F.concat(F.left("activity", F.col("n")), F.substr("activity", F.col("n") + 2))
    values = c.datasets.select("dataset_id", "activity", (F.col("o_orderkey") % 4 + 1).cast("int").alias("n")).select("dataset_id", cut.alias("value"))
    return values.withColumn("choices", words.scalar())


Q["suggestions"] = lambda c: similarity.with_suggestions(
    _rejected_words(c), F.col("value"), F.col("choices"), F.col("dataset_id")).select("dataset_id", "value", F.col("_suggested").alias("suggested"))
# A word that lacks one letter is closer to its whole than to any other of the five.
SQL["suggestions"] = """select dataset_id, activity[1:o_orderkey % 4 + 1] || activity[o_orderkey % 4 + 3:] as value, activity as suggested from datasets"""
Q["suggestions_judged"] = lambda c: similarity.judged_pairs(_rejected_words(c))
SQL["suggestions_judged"] = """with v as (select distinct activity[1:o_orderkey % 4 + 1] || activity[o_orderkey % 4 + 3:] as value from datasets),
  p as (select value, choice from v, (select distinct activity as choice from campaigns) c)
select value, choice from p where 2.0 * list_sum(list_transform(list_distinct(string_split(value, '')), lambda x :
  least(length(value) - length(replace(value, x, '')), length(choice) - length(replace(choice, x, ''))))) / (length(value) + length(choice)) >= 0.75"""


def _diagnosed(c, kept=lambda df, purpose: df):
    """Diagnostics of all datasets. ``kept`` may write the larger parts before they are joined on."""
    told = c.publisher_log.filter(F.col("line").contains(logs.STATUS_MARK))
    last = told.groupBy("dataset_id").agg(F.max_by("line", "line_no").alias("line"), F.max("run_id").alias("run_id"))
    status = logs.status_matches(F.col("line"))
    statuses = last.withColumn("_m", F.try_element_at(status, F.lit(-1))).filter(F.col("_m").isNotNull()).select(
        "dataset_id", F.when(~F.col("_m.emitted_id").startswith("unknown."), F.col("_m.status")).alias("status"), F.lit(1).alias("exit_code"),
        F.concat(F.lit("/logs/"), F.col("run_id")).alias("log_file"))
    errors = diagnostics.server_errors(c.publisher_log.select("dataset_id", "line_no", "line"), ["dataset_id"])
    names = kept(c.stac_items.select("item_id", "file_name", "o_orderkey").join(c.datasets.select("o_orderkey", "dataset_id"), "o_orderkey"), "names")
    verdicts = kept(
        items.item_verdicts(c.stac_items, flatten_schemas(c.schema_docs)).join(names, "item_id").withColumnRenamed("file_name", "stac_file"), "verdicts")
    return diagnostics.diagnose(c.datasets.select("dataset_id", "campaign"), statuses, errors, verdicts, "diag-1", NOW_TS, F.sha2("dataset_id", 256))


_DIAG = f"""{_BODY.replace("select run_id, batch_no, line_no, cast(", "select dataset_id, run_id, batch_no, line_no, cast(", 1)},
  last_line as (select dataset_id, arg_max(line, line_no) as line, max(run_id) as run_id from publisher_log where contains(line, 'PUB_STATUS=') group by dataset_id),
  told as (select dataset_id, run_id, case when contains(line, 'id=unknown.') then null when contains(line, 'PASS') then 'SUCCESS' else 'FAILED' end as status from last_line where contains(line, 'PUB_STATUS=')),
  last_error as (select dataset_id, max(line_no) as line_no from server group by dataset_id),
  errors as (select s.* from server_fields s join last_error using (dataset_id, line_no)),
  verdict as (select d.dataset_id, i.file_name, v.* exclude (item_id) from verdicts v join stac_items i on i.item_id = v.item_id join datasets d on d.o_orderkey = i.o_orderkey),
  j as (select d.dataset_id, d.campaign, t.dataset_id as told, t.status, t.run_id, e.http_status, e.error_type, e.schema_url, e.rejected_value, e.suggested_value, e.summary, e.server_instance,
      v.valid, v.schema_url as v_schema, v.rejected_value as v_rejected, v.suggested_value as v_suggested, v.summary as v_summary, v.file_name,
      case when t.status = 'SUCCESS' then 'RECOVERED' when t.status = 'FAILED' and v.valid = false then 'DIAGNOSED' when t.status = 'FAILED' and e.http_status is not null then 'DIAGNOSED'
        when t.status = 'FAILED' then 'UNCLASSIFIED' else 'EXECUTION_ERROR' end as outcome
    from datasets d left join told t on t.dataset_id = d.dataset_id left join errors e on e.dataset_id = d.dataset_id left join verdict v on v.dataset_id = d.dataset_id),
  k as (select *, outcome = 'DIAGNOSED' and coalesce(valid, true) = false as is_local from j),
  diags as (select sha256(dataset_id) as diagnostic_id, 'diag-1' as diagnostic_run_id, dataset_id, campaign, timestamp '{NOW}' as started_at, timestamp '{NOW}' as finished_at, outcome,
    status as publisher_status, case when told is null then -1 else 1 end as exit_code, http_status, case when is_local then 'local-stac-validation' else error_type end as error_type,
    case when is_local then v_schema else schema_url end as schema_url, case when is_local then v_rejected else rejected_value end as rejected_value,
    case when is_local then v_suggested else suggested_value end as suggested_value,
    case when outcome = 'RECOVERED' then 'Previously failed dataset published successfully.' when is_local then v_summary
      when outcome in ('DIAGNOSED', 'UNCLASSIFIED') then coalesce(summary, 'Publisher failed without a structured server diagnostic.')
      else 'No recognizable PUB_STATUS was emitted; see diagnostic log.' end as summary,
    server_instance, '/logs/' || run_id as log_file, file_name as stac_file from k)"""


def _with_diags(body: str) -> str:
    from registry.items import VERDICTS

    return f"with {VERDICTS}, {_DIAG} {body}"


Q["diagnostic_outcome"] = _diagnosed
SQL["diagnostic_outcome"] = _with_diags("select * from diags")

Q["diagnostic_counts"] = lambda c: diagnostics.diagnostic_counts(_diagnosed(c))
SQL["diagnostic_counts"] = _with_diags("""select diagnostic_run_id, count(*) as selected, count(*) filter (where outcome = 'RECOVERED') as recovered, count(*) filter (where outcome = 'DIAGNOSED') as diagnosed,
  count(*) filter (where outcome = 'UNCLASSIFIED') as unclassified, count(*) filter (where outcome = 'EXECUTION_ERROR') as execution_errors from diags group by diagnostic_run_id""")

Q["apply_diagnostics"] = lambda c: diagnostics.apply_diagnostics(catalog_columns(c.datasets), _diagnosed(c)).select(
    "dataset_id", "publication_status", "publication_claim_id", "stac_status", "stac_http_status")
SQL["apply_diagnostics"] = _with_diags("""select d.dataset_id, coalesce(g.publisher_status, d.publication_status) as publication_status,
  case when g.publisher_status is null then d.publication_claim_id end as publication_claim_id, case when g.publisher_status is null then d.stac_status else 'UNCHECKED' end as stac_status,
  case when g.publisher_status is null then d.stac_http_status end as stac_http_status from datasets d join diags g on g.dataset_id = d.dataset_id""")

Q["diagnostic_attempts"] = lambda c: diagnostics.diagnostic_attempts(_diagnosed(c), NOW_TS, F.col("diagnostic_id"))
SQL["diagnostic_attempts"] = _with_diags("""select diagnostic_id as attempt_id, dataset_id, diagnostic_run_id as run_id, started_at, finished_at, publisher_status as status, exit_code, log_file,
  case when publisher_status = 'FAILED' then summary end as error_message from diags where publisher_status in ('SUCCESS', 'FAILED')""")


def _export_diagnostics(c):
    fields = schemas.DIAGNOSTICS.names
    return outputs.read_back(c.spark, outputs.write_csv(_diagnosed(c), fresh_folder(c.spark, "export"), fields), fields)


Q["export_diagnostics"] = _export_diagnostics
SQL["export_diagnostics"] = _with_diags(f"""select diagnostic_id, diagnostic_run_id, dataset_id, campaign, '{NOW}' as started_at, '{NOW}' as finished_at, outcome, publisher_status,
  cast(exit_code as varchar) as exit_code, cast(http_status as varchar) as http_status, error_type, schema_url, rejected_value, suggested_value, summary, server_instance, log_file, stac_file from diags""")
