"""Registered queries: archive planning, execution decisions, import."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.operators import archive, reconcile, selections
from mapledger.session import fresh_folder
from mapledger.sinks import outputs
from mapledger.sources import files as sources
from registry.common import BASE_URL, BY_PROJECT, NOW, NOW_TS, by_project, catalog_columns, project_specs, set_columns

Q, SQL = {}, {}
_NAMES = list(schemas.DRS_FIELDS)

# ---- paths ----


def _strayed(c):
    """Datasets of which some claim another project or carry a component too many."""
    k = F.col("o_orderkey")
    return c.datasets.withColumn("dataset_id", F.when(k % 7 == 0, F.concat(F.lit("X"), "dataset_id")).when(
        k % 7 == 1, F.concat("dataset_id", F.lit(".y"))).when(k % 7 == 2, F.concat("dataset_id", F.lit(".y.z"))).otherwise(F.col("dataset_id")))


_PATHS = """strayed as (select * replace (case o_orderkey % 7 when 0 then 'X' || dataset_id when 1 then dataset_id || '.y' when 2 then dataset_id || '.y.z' else dataset_id end as dataset_id) from datasets),
  cut as (select d.*, string_split(dataset_id, '.') as p, c.project as cp, c.activity as ca, c.institution as ci, c.archive_root, c.archive_depth
    from strayed d left join campaigns c on c.name = d.campaign),
  parts as (select * replace (case when len(p) = 9 and contains(p[9], '#') then list_concat(p[1:8], [split_part(p[9], '#', 1), 'v' || split_part(p[9], '#', 2)]) else p end as p) from cut),
  judged as (select *, case when len(p) <> 10 then 'Unexpected DRS format: dataset ID contains ' || len(p) || ' components, but ESGVOC defines 10 DRS components: ' || dataset_id
    when archive_root is null then 'Campaign has no archive root'
    when p[1:3] <> [cp, ca, ci] then 'Dataset ' || dataset_id || ' does not match campaign DRS prefix: expected [''' || cp || ''', ''' || ca || ''', ''' || ci || '''], got [''' || p[1] || ''', ''' || p[2] || ''', ''' || p[3] || ''']' end as path_error from parts),
  paths as (select dataset_id, mapfile, case when path_error is null then archive_root || '/' || array_to_string(p[4:case archive_depth when 'experiment' then 5 else 8 end], '/') || '/.mapfiles/' || split_part(mapfile, '/', -1) end as archive_path,
    path_error from judged)"""

Q["archive_path"] = lambda c: archive.with_paths(_strayed(c).select("dataset_id", "campaign", "mapfile"), c.campaigns, _NAMES).drop("campaign")
SQL["archive_path"] = f"with {_PATHS} select * from paths"

Q["archive_path_by_project"] = lambda c: archive.with_paths(
    by_project(c).select("dataset_id", "campaign", "mapfile"), c.campaigns, project_specs(c)).drop("campaign")
SQL["archive_path_by_project"] = f"""with {BY_PROJECT},
  placed as (select d.*, c.archive_root, case when c.archive_depth = 'experiment' then 5 else 8 end + case when d.project = 'CMIP6' then 0 else 1 end as upto
    from parts d join campaigns c on c.name = d.campaign
    union all select d.*, null, null from parts d where d.campaign not in (select name from campaigns))
select dataset_id, mapfile, case when campaign in (select name from campaigns) and len(p) = wanted and archive_root is not null
    then archive_root || '/' || array_to_string(p[4:upto], '/') || '/.mapfiles/' || split_part(mapfile, '/', -1) end as archive_path,
  case when campaign not in (select name from campaigns) then 'No identifier specification for project: None'
    when len(p) <> wanted then 'Unexpected DRS format: dataset ID contains ' || len(p) || ' components, but ESGVOC defines ' || wanted || ' DRS components: ' || dataset_id
    when archive_root is null then 'Campaign has no archive root' end as path_error
from placed"""

# ---- planning ----


def _checks(c):
    """Comparison outcomes in which only every second campaign has datasets that are not present."""
    d = selections.reconcile_scope(c.datasets, scope="successful")
    checks = reconcile.compare(d, c.publication_attempts, c.stac_responses, BASE_URL, NOW_TS)
    even = F.regexp_extract("campaign", r"(\d+)$", 1).cast("int") % 2 == 0
    return checks.withColumn("outcome", F.when(even, F.lit("PRESENT")).otherwise(F.col("outcome")))


def _sql_checks() -> str:
    from registry.items import CHECKS

    text = CHECKS.replace(f"interval {20 * 86400} second", "interval 600 second")
    return f"""{text}, outcomes as (select * replace (case when cast(regexp_extract(campaign, '(\\d+)$', 1) as int) % 2 = 0 then 'PRESENT' else outcome end as outcome)
  from checks where publication_status = 'SUCCESS')"""


Q["archive_blockers"] = lambda c: archive.blocker_counts(_checks(c))
SQL["archive_blockers"] = f"with {_sql_checks()} select campaign, outcome, count(*) as n, min(dataset_id) as first_dataset from outcomes where outcome <> 'PRESENT' group by campaign, outcome"

Q["archive_blocker_examples"] = lambda c: archive.blocker_examples(_checks(c))
SQL["archive_blocker_examples"] = f"with {_sql_checks()} select dataset_id, outcome from outcomes where outcome <> 'PRESENT' order by dataset_id limit 5"


def _planned(c):
    prints = c.datasets.select("mapfile", F.lit("late").alias("mapfile_checksum"))
    return archive.planned_tasks(c.datasets, c.campaigns, _NAMES, NOW_TS, _checks(c), prints)


_PLAN = f"""{_sql_checks()}, wanted as (select * from datasets where registration_status = 'ACTIVE' and publication_status = 'SUCCESS' and archive_status = 'PENDING'),
  blocked as (select distinct o.campaign from outcomes o join wanted w on w.dataset_id = o.dataset_id where o.outcome <> 'PRESENT'),
  open as (select w.*, c.archive_root, c.archive_depth, string_split(w.dataset_id, '.') as p from wanted w left join campaigns c on c.name = w.campaign where w.campaign not in (select campaign from blocked)),
  planned as (select sha256(dataset_id || '|' || mapfile || '|' || coalesce(mapfile_checksum, 'late')) as task_id, dataset_id, campaign, coalesce(mapfile_checksum, 'late') as mapfile_checksum, mapfile as source_mapfile,
    case when archive_root is not null then archive_root || '/' || array_to_string(p[4:case archive_depth when 'experiment' then 5 else 8 end], '/') || '/.mapfiles/' || split_part(mapfile, '/', -1) end as archive_path,
    timestamp '{NOW}' as created_at, cast(null as timestamp) as completed_at, 'PENDING' as status, cast(null as varchar) as error_message,
    case when archive_root is null then 'Campaign has no archive root' end as problem, archive_root from open)"""

Q["create_archive_tasks"] = _planned
SQL["create_archive_tasks"] = f"with {_PLAN} select * exclude (archive_root) from planned"


def _published_tasks(c, planned):
    """Task file and task rows published together, read back from the file; none of them where any has a problem."""
    tasks = archive.unless_refused(planned)
    written = outputs.publish_together(
        {"tasks.csv": archive.task_file(tasks), "tasks": tasks}, fresh_folder(c.spark, "tasks"), 1, NOW_TS)
    rows = sources.read_archive_tasks(c.spark, written["tasks.csv"]).drop("row_no")
    table = c.spark.read.schema(schemas.ARCHIVE_TASKS).parquet(written["tasks"])
    return rows.join(table.select("task_id", "campaign"), "task_id")


def _rooted(c):
    """Tasks of campaigns that have an archive."""
    return _planned(c).join(c.campaigns.where("archive_root IS NOT NULL").select(F.col("name").alias("campaign")), "campaign", "left_semi")


Q["export_archive_tasks"] = lambda c: _published_tasks(c, _rooted(c))
SQL["export_archive_tasks"] = f"with {_PLAN} select task_id, dataset_id, source_mapfile as mapfile, mapfile_checksum, archive_path, campaign from planned where archive_root is not null"
Q["export_archive_refused"] = lambda c: _published_tasks(c, _planned(c)).agg(F.count(F.lit(1)).alias("n_tasks"))
SQL["export_archive_refused"] = f"with {_PLAN} select case when count(problem) > 0 then 0 else count(*) end as n_tasks from planned"
Q["archive_tasks_scan"] = lambda c: sources.read_archive_tasks(
    c.spark, outputs.write_csv(archive.task_file(c.archive_tasks), fresh_folder(c.spark, "tasks"), schemas.TASK_FIELDS)).drop("row_no")
SQL["archive_tasks_scan"] = "select task_id, dataset_id, source_mapfile as mapfile, mapfile_checksum, archive_path from archive_tasks"

# ---- execution ----


def _decided(c):
    return archive.execution_decisions(archive.task_file(c.archive_tasks), c.path_hashes)


_DECIDED = """decided as (select t.dataset_id, t.task_id, t.source_mapfile as mapfile, t.mapfile_checksum, t.archive_path,
    case when s.path is null or s.sha256 <> t.mapfile_checksum then 'FAILED' when d.path is null then 'WOULD_ARCHIVE' when s.sha256 = d.sha256 then 'ALREADY_EXISTS' else 'CONFLICT' end as status,
    case when s.path is null then 'Source mapfile does not exist: ' || t.source_mapfile when s.sha256 <> t.mapfile_checksum then 'Source mapfile checksum differs from generated task'
      when d.path is not null and s.sha256 <> d.sha256 then 'Destination exists but differs from source' else '' end as error_message
  from archive_tasks t left join path_hashes s on s.path = t.source_mapfile left join path_hashes d on d.path = t.archive_path)"""

Q["archive_classify"] = _decided
SQL["archive_classify"] = f"with {_DECIDED} select * from decided"
Q["archive_run_counts"] = lambda c: archive.execution_counts(_decided(c))
SQL["archive_run_counts"] = f"""with {_DECIDED} select l.label, count(d.status) as n from (select unnest(['WOULD_ARCHIVE', 'SUCCESS', 'ALREADY_EXISTS', 'CONFLICT', 'FAILED']) as label) l
left join decided d on d.status = l.label group by l.label"""


def _export_results(c):
    fields = schemas.RESULT_FIELDS
    return outputs.read_back(c.spark, outputs.write_csv(_decided(c), fresh_folder(c.spark, "results"), fields), fields)


Q["export_archive_results"] = _export_results
SQL["export_archive_results"] = f"with {_DECIDED} select dataset_id, task_id, mapfile, mapfile_checksum, archive_path, status, nullif(error_message, '') as error_message from decided"

# ---- import ----


def _scan_results(c):
    fields = ["row_no_text", "task_id", "dataset_id", "mapfile_checksum", "archive_path", "status", "error_message"]
    rows = c.archive_results.withColumn("row_no_text", F.col("row_no").cast("string")).drop("row_no")
    path = outputs.write_csv(rows, fresh_folder(c.spark, "results"), fields)
    return sources.read_archive_results(c.spark, path).drop("row_no")


Q["archive_results_scan"] = _scan_results
SQL["archive_results_scan"] = "select cast(row_no as varchar) as row_no_text, task_id, dataset_id, mapfile_checksum, archive_path, status, error_message from archive_results"

Q["archive_identity"] = lambda c: archive.matched_results(c.archive_results, c.archive_tasks).select("row_no", "task_id", "valid_task")
SQL["archive_identity"] = """select r.row_no, r.task_id, t.task_id is not null as valid_task from archive_results r left join archive_tasks t
on t.task_id = r.task_id and t.dataset_id = r.dataset_id and t.mapfile_checksum = r.mapfile_checksum and t.archive_path = r.archive_path"""


def _classified(c):
    return archive.classified_results(c.archive_results, c.archive_tasks, c.datasets)


_CLASSED = """classed as (select r.row_no, r.task_id, r.dataset_id, r.status, r.error_message,
    case when t.task_id is null then 'INVALID_TASK' when r.status in ('SUCCESS', 'ALREADY_EXISTS') and (d.registration_status <> 'ACTIVE' or d.publication_status <> 'SUCCESS') then 'UNKNOWN_DATASET'
      when r.status in ('SUCCESS', 'ALREADY_EXISTS', 'CONFLICT', 'FAILED') then r.status else 'UNKNOWN' end as label
  from archive_results r left join archive_tasks t on t.task_id = r.task_id and t.dataset_id = r.dataset_id and t.mapfile_checksum = r.mapfile_checksum and t.archive_path = r.archive_path
    join datasets d on d.dataset_id = r.dataset_id),
  last_rows as (select task_id, arg_max(status, row_no) as status, arg_max(error_message, row_no) as error_message from classed
    where label <> 'INVALID_TASK' and status in ('SUCCESS', 'ALREADY_EXISTS', 'CONFLICT', 'FAILED') group by task_id)"""

Q["archive_gate"] = lambda c: _classified(c).select("row_no", "task_id", "label")
SQL["archive_gate"] = f"with {_CLASSED} select row_no, task_id, label from classed"
Q["archive_import_counts"] = lambda c: archive.import_counts(_classified(c))
SQL["archive_import_counts"] = f"""with {_CLASSED} select l.label, count(c.label) as n from (select unnest(['SUCCESS', 'ALREADY_EXISTS', 'CONFLICT', 'FAILED', 'UNKNOWN_DATASET', 'INVALID_TASK', 'UNKNOWN']) as label) l
left join classed c on c.label = l.label group by l.label"""
Q["last_result_wins"] = lambda c: archive.last_task_results(_classified(c))
SQL["last_result_wins"] = f"with {_CLASSED} select * from last_rows"
Q["import_archive_tasks"] = lambda c: archive.import_into_tasks(c.archive_tasks, _classified(c), NOW_TS)
SQL["import_archive_tasks"] = f"""with {_CLASSED} select t.task_id, t.dataset_id, t.campaign, t.mapfile_checksum, t.source_mapfile, t.archive_path, t.created_at,
  case when l.task_id is null then t.completed_at else timestamp '{NOW}' end as completed_at, coalesce(l.status, t.status) as status,
  case when l.task_id is null then t.error_message else l.error_message end as error_message from archive_tasks t left join last_rows l on l.task_id = t.task_id"""
Q["import_archive_results"] = lambda c: archive.import_into_datasets(catalog_columns(c.datasets), _classified(c), NOW_TS)
_DONE = "d.dataset_id in (select dataset_id from classed where label in ('SUCCESS', 'ALREADY_EXISTS'))"
SQL["import_archive_results"] = f"with {_CLASSED} select " + set_columns({
    "archive_status": f"case when {_DONE} then 'SUCCESS' else d.archive_status end",
    "archive_completed_at": f"case when {_DONE} then timestamp '{NOW}' else d.archive_completed_at end"}) + " from datasets d"

# ---- one large file, read by many tasks ----


def _noted(c):
    """Results whose notes hold quotes, commas and line breaks, in file order."""
    note = F.concat(F.lit('said "'), "error_message", F.lit('",\nthen: '), F.col("row_no").cast("string"), F.lit("\n"))
    return c.archive_results.withColumn("error_message", note)


def _split_results(c):
    folder = fresh_folder(c.spark, "results")
    fields = [*schemas.RESULT_FIELDS[:2], *schemas.RESULT_FIELDS[3:]]
    ordered = _noted(c).repartition(1).sortWithinPartitions("row_no").select(*fields)
    ordered.write.options(header=True, escape='"', ignoreTrailingWhiteSpace=False).csv(folder)
    return sources.read_archive_results(c.spark, folder).drop("row_no")


Q["archive_results_split"] = _split_results
SQL["archive_results_split"] = """select dataset_id, task_id, mapfile_checksum, archive_path, status,
  'said "' || error_message || '",' || chr(10) || 'then: ' || row_no || chr(10) as error_message from archive_results"""
