"""Registered queries: sheet differences, payload batches, restore, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.fixtures.projection import Catalog
from mapledger.functions.text import iso_timestamp, json_object
from mapledger.operators import batching, reports, restore, sync
from mapledger.session import fresh_folder
from mapledger.sinks import outputs
from mapledger.sources import files as sources
from mapledger.streaming import leases, streams
from registry.common import NOW, NOW_TS, catalog_columns, set_columns

Q, SQL = {}, {}

# ---- sheet snapshots ----


def _sheet_lines(c):
    """The dataset sheet as record lines on disk, read back."""
    body = F.to_json(F.struct("dataset_id", "campaign", "publication_status"))
    folder = fresh_folder(c.spark, "sheet")
    c.sheet_datasets.select(F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "fields": '), body, F.lit("}")).alias("value")).write.text(folder)
    return sources.read_sheet_lines(c.spark, folder)


Q["sheet_snapshot_scan"] = lambda c: sources.sheet_keys(_sheet_lines(c), ["dataset_id", "campaign", "publication_status"]).drop("record_no")
SQL["sheet_snapshot_scan"] = "select id as record_id, dataset_id, campaign, publication_status from sheet_datasets"


def _sheet_documents(c):
    """Snapshot documents of at most 100 records each, as saved pages of a sheet."""
    body = F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "fields": '), F.to_json(F.struct("dataset_id")), F.lit("}"))
    rows = c.sheet_datasets.withColumn("page", F.floor(F.col("id") / 100))
    return rows.groupBy("page").agg(F.concat(F.lit('{"records": ['), F.array_join(F.collect_list(body), ", "), F.lit("]}")).alias("content"))


Q["sheet_snapshot_documents"] = lambda c: sources.sheet_keys(sources.sheet_records(_sheet_documents(c)), ["dataset_id"]).drop("record_no")
SQL["sheet_snapshot_documents"] = "select id as record_id, dataset_id from sheet_datasets"


def _snapshot(c, key: str):
    """Keys of a sheet, with a second, later record for every tenth key and a blank one."""
    s = c.sheet_datasets.select(F.col("id").alias("record_no"), F.col("id").alias("record_id"), F.col("dataset_id").alias(key))
    again = s.filter(F.col("record_id") % 10 == 1).select(
        (F.col("record_no") + F.lit(10_000_000)).alias("record_no"), (F.col("record_id") + F.lit(5_000_000)).alias("record_id"), key)
    blank = s.filter(F.col("record_id") % 10 == 2).withColumn(key, F.lit(""))
    return s.unionByName(again).unionByName(blank)


_LATEST = """latest as (select dataset_id, status as last_attempt_status, finished_at, log_file,
  row_number() over (partition by dataset_id order by finished_at desc nulls last, started_at desc nulls last, attempt_id desc nulls last) as rn from publication_attempts),
  status_rows as (select d.dataset_id, d.campaign, case when d.registration_status = 'RETIRED' then 'RETIRED' else d.publication_status end as publication_status,
    a.last_attempt_status, a.finished_at, a.log_file from datasets d left join latest a on a.dataset_id = d.dataset_id and a.rn = 1),
  sheet_ids as (select dataset_id, max(case when id % 10 = 1 then id + 5000000 else id end) as record_id from sheet_datasets group by dataset_id)"""

Q["sync_datasets"] = lambda c: sync.upserts(reports.campaign_status(c.datasets, c.publication_attempts), _snapshot(c, "dataset_id"), ["dataset_id"])
SQL["sync_datasets"] = f"with {_LATEST} select case when s.record_id is null then 'create' else 'update' end as kind, s.record_id, r.* from status_rows r left join sheet_ids s on s.dataset_id = r.dataset_id"


def _campaign_snapshot(c):
    return c.campaigns.filter(F.length("name") % 2 == 0).select(
        F.length("mapfile_root").cast("bigint").alias("record_no"), F.regexp_extract("name", r"(\d+)$", 1).cast("bigint").alias("record_id"), F.col("name").alias("campaign"))


Q["sync_campaigns"] = lambda c: sync.upserts(reports.campaign_records(c.datasets, c.campaigns), _campaign_snapshot(c), ["campaign"])
SQL["sync_campaigns"] = """select case when length(r.campaign) % 2 = 0 then 'update' else 'create' end as kind,
  case when length(r.campaign) % 2 = 0 then cast(regexp_extract(r.campaign, '(\\d+)$', 1) as bigint) end as record_id, r.* from (
  select d.campaign, c.project, c.activity, c.institution, count(*) as total, count(*) filter (where d.publication_status = 'SUCCESS') as published,
    count(*) filter (where d.publication_status = 'FAILED') as failed, count(*) filter (where d.publication_status = 'PENDING') as pending
  from datasets d join campaigns c on c.name = d.campaign where d.registration_status = 'ACTIVE' group by all) r"""


def _failures(c):
    """Failures of which every ninth has no run."""
    f = reports.failures(c.datasets, c.publication_attempts)
    return f.withColumn("run_id", F.when(F.length("dataset_id") % 9 != 0, F.col("run_id")))


def _failure_snapshot(c):
    s = c.sheet_failures
    return s.select(F.col("id").alias("record_no"), F.col("id").alias("record_id"), "dataset_id",
                    F.when(F.length("dataset_id") % 9 != 0, F.col("run_id")).alias("run_id"))


_FAILED = """failed_rows as (select p.dataset_id, d.campaign, case when length(p.dataset_id) % 9 <> 0 then p.run_id end as run_id, p.started_at, p.finished_at, p.status, p.exit_code, p.log_file, p.error_message
    from publication_attempts p join datasets d on d.dataset_id = p.dataset_id where p.status = 'FAILED'),
  failed_ids as (select dataset_id, case when length(dataset_id) % 9 <> 0 then run_id end as run_id, max(id) as record_id from sheet_failures group by all)"""
Q["sync_failures"] = lambda c: sync.upserts(_failures(c), _failure_snapshot(c), ["dataset_id", "run_id"])
SQL["sync_failures"] = f"""with {_FAILED} select case when s.record_id is null then 'create' else 'update' end as kind, s.record_id, r.* from failed_rows r
left join failed_ids s on s.dataset_id = r.dataset_id and s.run_id is not distinct from r.run_id"""


def _diagnostic_rows(c):
    return c.publication_attempts.filter(F.col("status") == "FAILED").select(
        F.concat(F.lit("diag-"), "attempt_id").alias("diagnostic_id"), "dataset_id", F.lit("UNCLASSIFIED").alias("outcome"), "started_at")


Q["sync_diagnostics"] = lambda c: sync.upserts(
    _diagnostic_rows(c), c.sheet_failures.select(F.col("id").alias("record_no"), F.col("id").alias("record_id"), F.concat(F.lit("diag-"), (F.col("id") / 2).cast("bigint").cast("string")).alias("diagnostic_id")), ["diagnostic_id"])
SQL["sync_diagnostics"] = """select case when s.id is null then 'create' else 'update' end as kind, s.id as record_id, 'diag-' || attempt_id as diagnostic_id, p.dataset_id, 'UNCLASSIFIED' as outcome, p.started_at
from publication_attempts p left join sheet_failures s on s.id = cast(p.attempt_id as bigint) * 2 where p.status = 'FAILED'"""

Q["sync_counts"] = lambda c: sync.sync_counts(
    reports.campaign_records(c.datasets, c.campaigns), reports.campaign_status(c.datasets, c.publication_attempts), reports.failures(c.datasets, c.publication_attempts))
SQL["sync_counts"] = """select 'campaigns' as table_name, count(distinct d.campaign) as n from datasets d join campaigns c on c.name = d.campaign where registration_status = 'ACTIVE'
union all select 'datasets', count(*) from datasets union all select 'failures', count(*) from publication_attempts p join datasets d on d.dataset_id = p.dataset_id where status = 'FAILED'"""

# ---- record text, sizes and batches ----


def _iso(col: str) -> str:
    return (f"(case when date_part('microsecond', {col}) % 1000000 = 0 then strftime({col}, '%Y-%m-%dT%H:%M:%S') else strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') end)")


Q["iso_json"] = lambda c: c.publication_attempts.select("attempt_id", iso_timestamp(F.col("started_at")).alias("started"), json_object({
    f.name: (F.col(f.name), f.dataType) for f in schemas.ATTEMPTS.fields}).alias("record"))


def _quoted(col: str) -> str:
    return f"coalesce('\"' || replace(replace({col}, '\\', '\\\\'), '\"', '\\\"') || '\"', 'null')"


SQL["iso_json"] = f"""select attempt_id, {_iso('started_at')} as started, '{{"attempt_id": ' || {_quoted('attempt_id')} || ', "dataset_id": ' || {_quoted('dataset_id')} || ', "run_id": ' || {_quoted('run_id')}
  || ', "started_at": ' || coalesce('"' || {_iso('started_at')} || '"', 'null') || ', "finished_at": ' || coalesce('"' || {_iso('finished_at')} || '"', 'null') || ', "status": ' || {_quoted('status')}
  || ', "exit_code": ' || coalesce(cast(exit_code as varchar), 'null') || ', "log_file": ' || {_quoted('log_file')} || ', "error_message": ' || {_quoted('error_message')} || '}}' as record from publication_attempts"""


def _records(c):
    return sync.records(Q["sync_datasets"](c), "Datasets")


_RECORDS = f"""{_LATEST}, records as (select case when s.record_id is null then 'create' else 'update' end as kind, r.dataset_id as order_key,
    case when s.record_id is null then '{{"fields": ' else '{{"id": ' || s.record_id || ', "fields": ' end || '{{"dataset_id": ' || {_quoted('r.dataset_id')} || ', "campaign": ' || {_quoted('r.campaign')}
    || ', "publication_status": ' || {_quoted('r.publication_status')} || ', "last_attempt_status": ' || {_quoted('r.last_attempt_status')}
    || ', "finished_at": ' || coalesce('"' || {_iso('r.finished_at')} || '"', 'null') || ', "log_file": ' || {_quoted('r.log_file')} || '}}}}' as record
  from status_rows r left join sheet_ids s on s.dataset_id = r.dataset_id)"""

Q["payload_size"] = lambda c: _records(c)
SQL["payload_size"] = f"with {_RECORDS} select 'Datasets' as table_name, kind, order_key, record, cast(strlen(record) as bigint) as n_bytes from records"

_MAX_RECORDS, _MAX_BYTES = 100, 20_000


def _batches(c):
    return batching.payload_batches(_records(c), ["table_name", "kind"], ["order_key"], "n_bytes", _MAX_RECORDS, _MAX_BYTES)


_SEQUENCE = f"""with recursive {_RECORDS},
  sized as (select kind, order_key, record, row_number() over (partition by kind order by order_key) - 1 as position, sum(strlen(record) + 2) over (partition by kind order by order_key) as upto from records),
  starts as (select kind, 0 as start, cast(0 as hugeint) as used, 1 as batch_no from (select distinct kind from sized) k
    union all select s.kind, n.position, n.before, s.batch_no + 1 from starts s,
      lateral (select z.position, z.upto - strlen(z.record) - 2 as before from sized z where z.kind = s.kind and z.position > s.start
        and (z.position - s.start >= {_MAX_RECORDS} or 15 + z.upto - s.used - 2 > {_MAX_BYTES}) order by z.position limit 1) n)"""
_NUMBERED = "select z.kind, z.order_key, z.record, z.position, max(s.batch_no) as batch_no from sized z join starts s on s.kind = z.kind and s.start <= z.position group by all"

Q["payload_batches"] = lambda c: _batches(c).select("table_name", "kind", "order_key", "position", "batch_no")
SQL["payload_batches"] = f"{_SEQUENCE} select 'Datasets' as table_name, kind, order_key, cast(position as bigint) as position, cast(batch_no as bigint) as batch_no from ({_NUMBERED}) n"
Q["greedy_batches"] = lambda c: _batches(c).groupBy("table_name", "kind", "batch_no").agg(
    F.count(F.lit(1)).alias("n_records"), F.min("position").alias("first_position"))
SQL["greedy_batches"] = f"{_SEQUENCE} select 'Datasets' as table_name, kind, cast(batch_no as bigint) as batch_no, count(*) as n_records, cast(min(position) as bigint) as first_position from ({_NUMBERED}) n group by kind, batch_no"


def _written_batches(c):
    bodies = batching.request_bodies(_batches(c), ["table_name", "kind"], "record")
    path = outputs.write_batches(bodies, fresh_folder(c.spark, "batches"))
    return c.spark.read.parquet(path).select("table_name", "kind", "batch_no", "n_records", "n_bytes", F.sha2("body", 256).alias("body_hash"))


Q["write_batches"] = _written_batches
SQL["write_batches"] = f"""{_SEQUENCE} select 'Datasets' as table_name, kind, cast(batch_no as bigint) as batch_no, count(*) as n_records,
  cast(strlen(string_agg(record, ', ' order by position)) + 15 as bigint) as n_bytes, sha256('{{"records": [' || string_agg(record, ', ' order by position) || ']}}') as body_hash from ({_NUMBERED}) n group by kind, batch_no"""

# ---- restore ----


def _sheet(c):
    return c.sheet_datasets.withColumnRenamed("id", "record_no")


def _sheet_failures(c):
    """Sheet failures as catalog rows; every second repeats, some name unknown datasets."""
    k = F.col("id")
    f = c.sheet_failures.select(
        F.when(k % 14 == 0, F.concat(F.lit("lost."), "dataset_id")).otherwise(F.col("dataset_id")).alias("dataset_id"), "run_id", "started_at", "status",
        "exit_code", "error_message")
    return f.unionByName(f.filter(F.col("exit_code") == 1))


_SHEET_FAILED = """sheet_failed as (select case when id % 14 = 0 then 'lost.' || dataset_id else dataset_id end as dataset_id, run_id, started_at, status, exit_code, error_message from sheet_failures)"""
Q["restore_coverage"] = lambda c: restore.coverage(_sheet(c), _sheet_failures(c), c.datasets)
SQL["restore_coverage"] = f"""with {_SHEET_FAILED}, r as (select dataset_id, true as s, false as f, false as l, upper(publication_status) = 'RETIRED' as r from sheet_datasets
  union all select dataset_id, false, true, false, false from sheet_failed union all select dataset_id, false, false, true, false from datasets)
select dataset_id, bool_or(s) as in_sheet, bool_or(f) as in_failures, bool_or(l) as in_catalog, bool_or(r) as retired, bool_or(s) and not bool_or(l) and not bool_or(r) as blocks from r group by dataset_id"""
Q["referenced_ids"] = lambda c: restore.referenced_ids(_sheet(c), _sheet_failures(c))
SQL["referenced_ids"] = f"with {_SHEET_FAILED} select dataset_id from sheet_datasets union select dataset_id from sheet_failed"
Q["missing_local"] = lambda c: restore.missing_local(_sheet(c), _sheet_failures(c), c.datasets)
SQL["missing_local"] = f"with {_SHEET_FAILED} (select dataset_id from sheet_datasets union select dataset_id from sheet_failed) except select dataset_id from datasets"
Q["blocking_missing"] = lambda c: restore.blocking_missing(_sheet(c), c.datasets)
SQL["blocking_missing"] = "select dataset_id from sheet_datasets except select dataset_id from datasets except select dataset_id from sheet_datasets where publication_status = 'RETIRED'"
Q["local_only"] = lambda c: restore.local_only(_sheet(c), c.datasets)
SQL["local_only"] = "select dataset_id from datasets except select dataset_id from sheet_datasets"
Q["matched"] = lambda c: restore.matched(_sheet(c), c.datasets)
SQL["matched"] = "select dataset_id from datasets intersect select dataset_id from sheet_datasets"


def _messy(c):
    """Sheet rows with blank and repeated ids."""
    k = F.col("record_no")
    s = _sheet(c).withColumn("dataset_id", F.when(k % 83 == 0, F.lit("  ")).when(k % 89 == 0, F.lit(None)).otherwise(F.col("dataset_id")))
    return s.unionByName(s.filter(k % 31 == 0).withColumn("dataset_id", F.concat(F.lit(" "), "dataset_id")))


_MESSY = """messy0 as (select id as record_no, case when id % 83 = 0 then '' when id % 89 = 0 then '' else dataset_id end as dataset_id from sheet_datasets),
  messy as (select * from messy0 union all select * from messy0 where record_no % 31 = 0)"""
Q["blank_ids"] = lambda c: restore.blank_ids(_messy(c))
SQL["blank_ids"] = f"with {_MESSY} select record_no from messy where dataset_id = ''"
Q["duplicate_ids"] = lambda c: restore.duplicate_ids(_messy(c))
SQL["duplicate_ids"] = f"with {_MESSY} select dataset_id from messy where dataset_id <> '' group by dataset_id having count(*) > 1"
Q["restore_status_counts"] = lambda c: restore.status_counts(_sheet(c).withColumn("publication_status", F.when(F.col("record_no") % 5 != 0, F.col("publication_status"))))
SQL["restore_status_counts"] = "select case when id % 5 <> 0 then publication_status else '<NULL>' end as status, count(*) as n from sheet_datasets group by all"

Q["new_attempts"] = lambda c: restore.new_attempts(_sheet_failures(c), c.publication_attempts)
SQL["new_attempts"] = f"""with {_SHEET_FAILED} select distinct dataset_id, run_id, started_at, status, exit_code, error_message from sheet_failed f where not exists (
  select 1 from publication_attempts a where a.dataset_id is not distinct from f.dataset_id and a.run_id is not distinct from f.run_id and a.started_at is not distinct from f.started_at
  and a.status is not distinct from f.status and a.exit_code is not distinct from f.exit_code and a.error_message is not distinct from f.error_message)"""


def _cells(c):
    """Sheet failures as JSON records: epoch seconds, whole floats, blanks."""
    text = F.concat(
        F.lit('{"dataset_id": "'), "dataset_id", F.lit('", "started_at": '), F.unix_seconds(F.col("started_at").cast("timestamp")).cast("string"),
        F.lit('.5, "finished_at": "", "exit_code": '), F.col("exit_code").cast("string"), F.lit('.0, "status": "'), F.when(F.col("id") % 4 == 0, F.col("status")).otherwise(""),
        F.lit('", "log_file": null}'))
    return c.sheet_failures.select(F.col("id").alias("record_no"), text.alias("fields"))


Q["restore_value"] = lambda c: restore.restored_rows(_cells(c), ("dataset_id", "started_at", "finished_at", "status", "exit_code", "log_file"), schemas.ATTEMPTS)
SQL["restore_value"] = """select id as record_no, dataset_id, date_trunc('second', started_at) + interval 500 millisecond as started_at, cast(null as timestamp) as finished_at,
  case when id % 4 = 0 then status end as status, exit_code, cast(null as varchar) as log_file from sheet_failures"""

Q["restore_state"] = lambda c: restore.restore_state(catalog_columns(c.datasets), _sheet(c), NOW_TS)
SQL["restore_state"] = "select " + set_columns({
    "registration_status": "case when s.publication_status = 'RETIRED' then 'RETIRED' when s.dataset_id is not null then 'ACTIVE' else d.registration_status end",
    "retired_at": f"case when s.publication_status = 'RETIRED' then coalesce(d.retired_at, timestamp '{NOW}') when s.dataset_id is null then d.retired_at end",
    "publication_status": "case when s.publication_status <> 'RETIRED' then s.publication_status else d.publication_status end",
}) + " from datasets d left join sheet_datasets s on s.dataset_id = d.dataset_id"

def _split_sheet(c):
    """A snapshot as one JSON document over many lines, some texts with braces and quotes, read by many tasks."""
    folder = fresh_folder(c.spark, "sheet")
    fields = F.struct("dataset_id", "campaign", F.concat(F.lit('{"} '), "publication_status").alias("note"))
    records = c.sheet_datasets.select(F.col("id").alias("n"), F.concat(F.to_json(F.struct("id", fields.alias("fields"))), F.lit(",")).alias("value"))
    ends = c.spark.createDataFrame([(-(2**62), '{"records": ['), (2**62, '{"id": 0, "fields": {}}]}')], "n long, value string")
    records.unionByName(ends).repartition(1).sortWithinPartitions("n").select("value").write.text(folder)
    return sources.read_sheet_split(c.spark, folder).select(
        "record_id", *[F.get_json_object("fields", f"$.{k}").alias(k) for k in ("dataset_id", "campaign", "note")])


Q["sheet_split_scan"] = _split_sheet
SQL["sheet_split_scan"] = """select id as record_id, dataset_id, campaign, '{"} ' || publication_status as note from sheet_datasets
union all select 0, null, null, null"""

# ---- streams over the event table ----


def _event_stream(c: Catalog):
    """The event table as an unbounded source."""
    kind = c.base("events").schema
    return c.spark.readStream.schema(kind).option("pathGlobFilter", "events.parquet").parquet(c.sf_dir)


def _names(c):
    return c.datasets.select("o_orderkey", "dataset_id", "campaign")


def _run(query):
    query.awaitTermination()


def _stream_attempts(c):
    e = _event_stream(c)
    status = (F.when(F.col("event_type") == "purchase", "SUCCESS").when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "view", "RUNNING")
              .when(F.col("event_type") == "click", "NO_STATUS").otherwise("UNREACHED"))
    e = e.withColumn("key", F.floor(F.col("event_id") / 4))
    return e.join(_names(c), F.col("key") == F.col("o_orderkey")).select(
        F.col("event_id").cast("string").alias("attempt_id"), "dataset_id", "campaign", F.concat(F.lit("run-"), (F.col("event_id") % 3).cast("string")).alias("run_id"),
        F.col("ts").cast("timestamp").alias("started_at"), status.alias("status"), "event_id")


def _rates(c):
    folder = fresh_folder(c.spark, "rates")
    q = streams.attempt_rates(_stream_attempts(c), "6 hours").writeStream.outputMode("update").foreachBatch(
        streams.write_updates(f"{folder}/out")).option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
    _run(q)
    written = c.spark.read.parquet(f"{folder}/out")
    newest = streams.newest_updates(written.drop("batch"), ["window_start", "campaign", "status"], "n")
    return newest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


Q["attempt_rates"] = _rates
SQL["attempt_rates"] = """select time_bucket(interval 6 hour, p.started_at, timestamp '1970-01-01') as window_start, d.campaign, p.status, count(*) as n
from publication_attempts p join datasets d on d.dataset_id = p.dataset_id group by all"""


def _log_stream(c):
    """Log lines written as run files, tailed as a stream, applied per micro-batch."""
    folder = fresh_folder(c.spark, "logs")
    c.publisher_log.select("run_id", F.concat_ws("\t", F.col("line_no").cast("string"), "line").alias("value")).repartition("run_id", F.col("line_no") % 4).write.partitionBy("run_id").text(f"{folder}/in")
    lines = c.spark.readStream.format("text").schema("value string, run_id string").option("maxFilesPerTrigger", 2).load(f"{folder}/in").select(
        "run_id", F.substring_index("value", "\t", 1).cast("bigint").alias("line_no"), F.regexp_replace("value", r"^\d+\t", "").alias("line"))
    q = streams.status_stream(lines).writeStream.foreachBatch(streams.write_statuses(f"{folder}/out")).option(
        "checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
    _run(q)
    known = c.datasets.select(F.replace("dataset_id", F.lit("#"), F.lit(".v")).alias("emitted_id"), "dataset_id")
    return streams.last_streamed_statuses(c.spark.read.parquet(f"{folder}/out"), known)


Q["log_stream"] = _log_stream
SQL["log_stream"] = """select run_id, dataset_id, arg_max(case when contains(line, 'PASS') then 'SUCCESS' else 'FAILED' end, line_no) as status from publisher_log
where contains(line, 'PUB_STATUS=') and not contains(line, 'id=unknown.') group by run_id, dataset_id"""

_LEASE = 7200


def _leases(c):
    """Attempts whose event has no follow-up event of the same user within the lease."""
    folder = fresh_folder(c.spark, "leases")
    e = _event_stream(c)
    starts = e.filter(F.col("event_type") == "view").select(
        F.col("user_id").cast("string").alias("attempt_id"), F.col("event_id").cast("string").alias("dataset_id"), F.lit("run").alias("run_id"), F.col("ts").cast("timestamp").alias("started_at"))
    ends = _event_stream(c).filter(F.col("event_type") != "view").select(
        F.col("user_id").cast("string").alias("attempt_id"), F.col("ts").cast("timestamp").alias("finished_at"))
    q = streams.lease_stream(starts, ends, _LEASE).writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/check").outputMode("append").trigger(availableNow=True).start()
    _run(q)
    return c.spark.read.parquet(f"{folder}/out").withColumn("started_at", F.col("started_at").cast("timestamp_ntz"))


Q["lease_stream"] = _leases
SQL["lease_stream"] = f"""with s as (select cast(user_id as varchar) as attempt_id, cast(event_id as varchar) as dataset_id, 'run' as run_id, ts as started_at from events where event_type = 'view'),
  f as (select cast(user_id as varchar) as attempt_id, ts as finished_at from events where event_type <> 'view'),
  edge as (select least((select max(started_at) from s), (select max(finished_at) from f)) as now)
select attempt_id, dataset_id, run_id, started_at, 'ABANDONED' as status, 'Publication claim lease expired' as error_message from s
where started_at + interval {_LEASE} second < (select date_trunc('millisecond', now) from edge)
  and not exists (select 1 from f where f.attempt_id = s.attempt_id and f.finished_at >= s.started_at and f.finished_at <= s.started_at + interval {_LEASE} second)"""


def _renewed_leases(c):
    """Attempts from views: up to three heartbeats, 40 minutes apart (70, too late, for every seventh), and a finish for most."""
    folder = fresh_folder(c.spark, "renewed")
    e = _event_stream(c).where("event_type = 'view'")
    k = "cast(event_id as int)"
    steps = F.expr(f"""concat(array(named_struct('kind', 'START', 'minutes', 0)),
      transform(if({k} % 4 = 0, cast(array() as array<int>), sequence(1, {k} % 4)), j -> named_struct('kind', 'HEARTBEAT', 'minutes', j * if({k} % 7 = 0, 70, 40))),
      if({k} % 3 = 0, cast(array() as array<struct<kind: string, minutes: int>>), array(named_struct('kind', 'FINISH', 'minutes', {k} % 5 * 50))))""")
    events = e.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.inline(steps)).select(
        F.col("event_id").cast("string").alias("attempt_id"), "kind", F.expr("ts + make_dt_interval(0, 0, minutes)").alias("at"),
        F.col("user_id").cast("string").alias("dataset_id"), F.lit("run").alias("run_id"))
    with leases.state_with_timers(c.spark):
        _run(leases.abandoned(events, 3600, "1 day").writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/check").outputMode("append").trigger(availableNow=True).start())
    out = c.spark.read.schema(leases.ABANDONED).parquet(f"{folder}/out")
    return out.select("attempt_id", "dataset_id", F.col("started_at").cast("timestamp_ntz").alias("started_at"),
                      F.col("expired_at").cast("timestamp_ntz").alias("expired_at"), "status")


Q["lease_timer_stream"] = _renewed_leases
SQL["lease_timer_stream"] = """with v as (select event_id as k, user_id, ts, ts + interval 1 minute * (case when event_id % 7 = 0 then 60 else 60 + 40 * (event_id % 4) end) as expired_at,
    case when event_id % 3 <> 0 then ts + interval 1 minute * (event_id % 5 * 50) end as finished_at,
    greatest(ts + interval 1 minute * (event_id % 4 * case when event_id % 7 = 0 then 70 else 40 end), case when event_id % 3 <> 0 then ts + interval 1 minute * (event_id % 5 * 50) end) as seen
  from events where event_type = 'view')
select cast(k as varchar) as attempt_id, cast(user_id as varchar) as dataset_id, ts as started_at, expired_at, 'ABANDONED' as status from v
where (finished_at is null or finished_at > expired_at) and expired_at + interval 1 millisecond <= (select date_trunc('millisecond', max(seen)) - interval 1 day from v)"""
