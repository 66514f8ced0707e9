"""Registered queries: identifiers, mapfiles, registration, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import ids, mapfile
from mapledger.functions.text import normalize_id
from mapledger.operators import registration, validation
from mapledger.plans import workflows
from mapledger.session import fresh_folder
from mapledger.sources import files as sources
from mapledger.sources import listing
from registry.common import (
    BASE_URL, BY_PROJECT, MAPPINGS, NOW, NOW_TS, PROJECT_NAMES, STRICT_MAPPINGS, by_project, catalog_columns, project_specs,
    set_columns,
)

Q, SQL = {}, {}


def _id():
    return F.col("dataset_id")


_NAMES = list(schemas.DRS_FIELDS)

# ---- identifiers ----


def _odd_ids(c):
    """Ids with a component too many and with a `v` already before the version, by key."""
    k = F.col("o_orderkey")
    odd = F.when(k % 5 == 0, F.concat(_id(), F.lit(".extra"))).when(k % 5 == 1, F.replace(_id(), F.lit("#"), F.lit("#v"))).when(
        k % 5 == 2, F.replace(_id(), F.lit("#"), F.lit(".v"))).when(k % 5 == 3, F.replace(_id(), F.lit("gr#"), F.lit("a#b/c#"))).otherwise(_id())
    return c.datasets.withColumn("dataset_id", odd)


_ODD = """odd as (select * replace (case o_orderkey % 5 when 0 then dataset_id || '.extra' when 1 then replace(dataset_id, '#', '#v')
  when 2 then replace(dataset_id, '#', '.v') when 3 then replace(dataset_id, 'gr#', 'a#b/c#') else dataset_id end as dataset_id) from datasets),
  cut as (select *, string_split(dataset_id, '.') as p from odd),
  split_once as (select *, case when len(p) = 9 and contains(p[9], '#') then list_concat(p[1:8], [split_part(p[9], '#', 1), 'v' || substr(p[9], instr(p[9], '#') + 1)]) else p end as parts from cut),
  parsed as (select * replace (case when len(parts) = 10 then parts end as parts), len(parts) as n_parts from split_once)"""

Q["parse_drs"] = lambda c: _odd_ids(c).select(
    _id(), *[ids.drs_map(_id(), _NAMES)[n].alias(n) for n in ("project", "experiment", "grid", "version")],
    ids.drs_json(_id(), _NAMES).alias("drs"), ids.components_error(_id(), _NAMES).alias("error"))
SQL["parse_drs"] = f"""with {_ODD} select dataset_id, parts[1] as project, parts[5] as experiment, parts[9] as grid, parts[10] as version,
  case when parts is not null then '{{' || """ + " || ', ' || ".join(
    f"'\"{n}\": \"' || parts[{i}] || '\"'" for i, n in enumerate(_NAMES, 1)) + """ || '}' end as drs,
  case when n_parts <> 10 then 'Unexpected DRS format: dataset ID contains ' || n_parts || ' components, but ESGVOC defines 10 DRS components: ' || dataset_id end as error
from parsed"""

Q["drs_prefix"] = lambda c: _odd_ids(c).select(_id(), ids.drs_prefix(_id(), "experiment").alias("prefix"))
SQL["drs_prefix"] = f"with {_ODD} select dataset_id, array_to_string(parts[1:5], '/') as prefix from parsed"

Q["publisher_id"] = lambda c: _odd_ids(c).select(_id(), ids.publisher_id(_id()).alias("published_as"))
SQL["publisher_id"] = f"""with {_ODD} select dataset_id, case when not contains(dataset_id, '#') then dataset_id else
  regexp_extract(dataset_id, '^(.*)#([^#]*)$', 1) || case when regexp_extract(dataset_id, '^(.*)#([^#]*)$', 2) like 'v%' then '.' else '.v' end
  || regexp_extract(dataset_id, '^(.*)#([^#]*)$', 2) end as published_as from odd"""

Q["item_url"] = lambda c: _odd_ids(c).select(_id(), ids.item_url(BASE_URL, F.concat("project", F.lit(" ~*+ä")), _id()).alias("url"))
SQL["item_url"] = f"""with {_ODD} select dataset_id, '{BASE_URL}/collections/' || url_encode(project || ' ~*+ä') || '/items/' || url_encode(dataset_id) as url from odd"""

Q["safe_filename"] = lambda c: _odd_ids(c).select(_id(), ids.safe_filename(_id()).alias("file_name"))
SQL["safe_filename"] = f"with {_ODD} select dataset_id, replace(replace(dataset_id, '/', '_'), '#', '.v') as file_name from odd"

Q["normalize_id"] = lambda c: c.datasets.select(
    "o_orderkey", normalize_id(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" \t"), _id(), F.lit("\n "))).when(
        F.col("o_orderkey") % 3 == 1, _id())).alias("id"))
SQL["normalize_id"] = "select o_orderkey, case when o_orderkey % 3 = 2 then '' else dataset_id end as id from datasets"

# ---- mapfile lines ----

_MD = "list_filter(f[4:], lambda x: contains(x, '=') and trim(split_part(x, '=', 1)) = '{k}')[-1]"


def _metadata_sql(key: str) -> str:
    item = _MD.format(k=key)
    return f"trim(substr({item}, instr({item}, '=') + 1))"


_LINES = f"""cells as (select mapfile, line_no, o_orderkey, trim(line) as line, list_transform(string_split(trim(line), '|'), lambda x: trim(x)) as f from mapfile_lines),
  parsed_lines as (select *, len(f) >= 3 as well_formed from cells where line <> ''),
  fields as (select mapfile, line_no, o_orderkey, line, well_formed, case when well_formed then f[1] end as dataset_id, case when well_formed then f[2] end as file_path,
    case when well_formed then f[3] end as size_text, case when well_formed then {_metadata_sql('checksum')} end as checksum,
    case when well_formed then {_metadata_sql('mod_time')} end as mod_time,
    well_formed and not regexp_matches(f[3], '^[+-]?[0-9]+(_[0-9]+)*$') as bad_size from parsed_lines)"""

Q["mapfile_fields"] = lambda c: registration.parsed_lines(c.mapfile_lines)
SQL["mapfile_fields"] = f"with {_LINES} select mapfile, line_no, line, well_formed, dataset_id, file_path, size_text, checksum, mod_time from fields"

_SCAN = f"""{_LINES},
  heads as (select mapfile, arg_min(dataset_id, line_no) filter (where well_formed) as head_id from fields group by mapfile),
  faults as (select f.mapfile, line_no, case when not well_formed then 0 when f.dataset_id <> head_id then 1 else 2 end as step,
      case when not well_formed then 'Malformed mapfile line in ' || f.mapfile || ': ' || line when f.dataset_id <> head_id then 'Multiple dataset IDs found in ' || f.mapfile
        else 'invalid literal for int() with base 10: ''' || size_text || '''' end as error
    from fields f join heads h on h.mapfile = f.mapfile where not well_formed or f.dataset_id <> head_id or bad_size),
  first_fault as (select mapfile, arg_min(error, line_no * 3 + step) as error from faults group by mapfile),
  scan as (select h.mapfile, case when e.error is null then head_id end as dataset_id,
      case when e.error is null then n end as n_files, e.error
    from heads h join (select mapfile, count(*) filter (where well_formed) as n from fields group by mapfile) c on c.mapfile = h.mapfile
      left join first_fault e on e.mapfile = h.mapfile)"""

Q["mapfile_scan"] = lambda c: registration.scan_mapfiles(c.mapfile_lines, include_files=True)
SQL["mapfile_scan"] = f"with {_SCAN} select * from scan"

Q["file_rows"] = lambda c: registration.file_rows(
    c.mapfile_lines, registration.scan_mapfiles(c.mapfile_lines, True).filter(F.col("error").isNull()))
SQL["file_rows"] = f"""with {_SCAN} select f.dataset_id, file_path, cast(size_text as bigint) as file_size, checksum, mod_time
from fields f join scan s on s.mapfile = f.mapfile where s.error is null and well_formed"""


def _mapping_sql(path: str, strict: bool) -> str:
    out = "case "
    for source, target in (STRICT_MAPPINGS if strict else MAPPINGS):
        if strict:
            out += f"when starts_with({path}, '{source}/') then '{target}' || substr({path}, {len(source) + 1}) "
        else:
            root = source.rstrip("/")
            out += f"when {path} = '{source}' then '{target}' when starts_with({path}, '{root}/') then '{target.rstrip('/')}' || substr({path}, {len(root) + 1}) "
    return out + f"else {path} end"


Q["rewrite_paths"] = lambda c: c.mapfile_lines.select("mapfile", "line_no", mapfile.rewritten_line(F.col("line"), MAPPINGS).alias("line"))
SQL["rewrite_paths"] = f"""select mapfile, line_no, case when len(f) >= 2 then array_to_string(list_concat(f[1:1], [' ' || {_mapping_sql('trim(f[2])', False)} || ' '], f[3:]), '|') else line end as line
from (select *, string_split(line, '|') as f from mapfile_lines) l"""

Q["rewrite_paths_strict"] = lambda c: c.mapfile_lines.select(
    "mapfile", "line_no", mapfile.rewritten_line(F.col("line"), STRICT_MAPPINGS, strict=True).alias("line"))
SQL["rewrite_paths_strict"] = f"""select mapfile, line_no, case when len(f) >= 3 then array_to_string(list_concat(f[1:1], [' ' || {_mapping_sql('trim(f[2])', True)} || ' '], f[3:]), '|') else line end as line
from (select *, string_split(trim(line), '|') as f from mapfile_lines) l"""

Q["path_mappings"] = lambda c: c.files.select("dataset_id", "file_path", mapfile.mapped_path(F.col("file_path"), MAPPINGS).alias("mapped"))
SQL["path_mappings"] = f"select dataset_id, file_path, {_mapping_sql('file_path', False)} as mapped from files"

Q["rewrite_report"] = lambda c: validation.rewrite_report(c.mapfile_lines, MAPPINGS)
SQL["rewrite_report"] = f"""select mapfile, count(*) filter (where p <> m) as changed, count(*) as total,
  arg_min(p, line_no) filter (where p <> m) as example_from, arg_min(m, line_no) filter (where p <> m) as example_to
from (select mapfile, line_no, p, {_mapping_sql('p', False)} as m from (select mapfile, line_no, trim(string_split(line, '|')[2]) as p from mapfile_lines where contains(line, '|')) a) b group by mapfile"""


def _contents(c):
    """Mapfile contents as bytes, one row per mapfile (its lines are bounded by the file)."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    return c.mapfile_lines.groupBy("mapfile").agg(F.array_join(lines, "\n").cast("binary").alias("content"))


_CONTENTS = "contents as (select mapfile, string_agg(line, chr(10) order by line_no) as content from mapfile_lines group by mapfile)"

Q["fingerprint"] = lambda c: sources.fingerprints(_contents(c))
SQL["fingerprint"] = f"with {_CONTENTS} select mapfile, sha256(content) as mapfile_checksum from contents"

Q["mapfile_line_split"] = lambda c: sources.mapfile_lines(_contents(c))
SQL["mapfile_line_split"] = "select mapfile, line_no, line from mapfile_lines"


def _yaml(c):
    text = F.concat(
        F.lit("campaigns:\n  "), F.col("name"), F.lit(":\n    project: "), F.col("project"), F.lit("\n    activity: "), F.col("activity"),
        F.lit("\n    institution: "), F.col("institution"), F.lit("\n    mapfile_root: $DATA_ROOT"), F.col("mapfile_root"),
        F.lit("\n    archive:\n      enabled: "), F.when(F.col("archive_root").isNotNull(), F.lit("true")).otherwise("false"),
        F.lit("\n      root: "), F.coalesce("archive_root", F.lit("/unused")), F.lit("\n      depth: "), F.coalesce("archive_depth", F.lit("grid")), F.lit("\n"))
    return c.campaigns.select(text.alias("content"))


Q["campaigns_load"] = lambda c: sources.campaigns_from_yaml(_yaml(c), "/srv", {"DATA_ROOT": "/data"}, "/home/u")
SQL["campaigns_load"] = "select name, project, activity, institution, '/data' || mapfile_root as mapfile_root, archive_root, archive_depth from campaigns"

# ---- validation ----

_PROBLEMS = """problems as (
  select mapfile, line_no, 'Line ' || line_no || ': malformed mapfile row' as problem from parsed_lines where not well_formed
  union all select mapfile, line_no, 'Line ' || line_no || ': missing file ' || f[2] from parsed_lines where well_formed and f[2] not in (select path from file_inventory)),
  mapfile_heads as (select d.dataset_id, d.mapfile, case when i.path is null then 'Mapfile does not exist' when not i.is_file then 'Mapfile is not a file'
    when i.length = 0 then 'Mapfile is empty' end as problem from datasets d left join mapfile_inventory i on i.path = d.mapfile),
  all_problems as (select dataset_id, cast(0 as bigint) as line_no, problem from mapfile_heads where problem is not null
    union all select h.dataset_id, p.line_no, p.problem from mapfile_heads h join problems p on p.mapfile = h.mapfile where h.problem is null)"""

Q["file_inventory"] = lambda c: c.files.join(
    c.file_inventory.select(F.col("path").alias("file_path"), F.lit(True).alias("there")), "file_path", "left").select(
    "dataset_id", "file_path", F.col("there").isNotNull().alias("file_exists"))
SQL["file_inventory"] = "select dataset_id, file_path, file_path in (select path from file_inventory) as file_exists from files"

Q["missing_files"] = lambda c: validation.line_problems(c.mapfile_lines, c.file_inventory)
SQL["missing_files"] = f"with {_LINES}, {_PROBLEMS} select mapfile, line_no, problem from problems"

Q["dataset_problems"] = lambda c: validation.dataset_problems(c.datasets, c.mapfile_lines, c.file_inventory, c.mapfile_inventory)
SQL["dataset_problems"] = f"with {_LINES}, {_PROBLEMS} select dataset_id, line_no, problem from all_problems"

Q["validation_report"] = lambda c: validation.validation_report(c.datasets, c.mapfile_lines, c.file_inventory, c.mapfile_inventory)
SQL["validation_report"] = f"""with {_LINES}, {_PROBLEMS} select d.dataset_id, case when n is null then 'PASS' else 'FAIL' end as verdict, coalesce(n, 0) as n_problems, first_problem
from datasets d left join (select dataset_id, count(*) as n, arg_min(problem, line_no) as first_problem from all_problems group by dataset_id) p on p.dataset_id = d.dataset_id"""

# ---- registration ----


def _roots(c):
    return c.datasets.select("mapfile", "campaign", "project", "activity", "institution")


def _prints(c):
    """Fingerprints that differ from the catalog for every third dataset."""
    k = F.col("o_orderkey")
    return c.datasets.select("mapfile", F.when(k % 3 == 0, F.lit("edited")).otherwise(F.coalesce("mapfile_checksum", F.lit("first"))).alias("mapfile_checksum"))


def _changes(c):
    """Registered changes: every dataset but those with key % 4 = 1, plus new ids for key % 20 = 2."""
    k = F.col("o_orderkey")
    base = c.datasets.join(_prints(c).withColumnRenamed("mapfile_checksum", "new_sum"), "mapfile")
    return base.filter(k % 4 != 1).select(
        F.when(k % 20 == 2, F.concat(F.lit("New."), _id())).otherwise(_id()).alias("dataset_id"), "campaign", "project", "activity",
        F.lit("moved").alias("institution"), ids.drs_json(_id(), _NAMES).alias("drs"), F.concat("mapfile", F.lit(".new")).alias("mapfile"),
        F.col("new_sum").alias("mapfile_checksum"))


_DRS = "'{' || " + " || ', ' || ".join(
    f"'\"{n}\": \"' || p[{i}] || '\"'" for i, n in enumerate(_NAMES[:8], 1)) + \
    " || ', \"grid\": \"' || split_part(p[9], '#', 1) || '\", \"version\": \"v' || split_part(p[9], '#', 2) || '\"}'"
_CHANGES = f"""changes as (select case when o_orderkey % 20 = 2 then 'New.' || dataset_id else dataset_id end as dataset_id, campaign, project, activity, 'moved' as institution,
  {_DRS} as drs, mapfile || '.new' as mapfile, case when o_orderkey % 3 = 0 then 'edited' else coalesce(mapfile_checksum, 'first') end as mapfile_checksum
  from (select *, string_split(dataset_id, '.') as p from datasets) s where o_orderkey % 4 <> 1)"""
_KEEP = "(d.dataset_id is not null and (c.dataset_id is null or d.mapfile_checksum is null or d.mapfile_checksum = c.mapfile_checksum))"


def _held(column: str, reset: str) -> str:
    return f"case when {_KEEP} then d.{column} else {reset} end"


_UPSERT = {
    "dataset_id": "coalesce(d.dataset_id, c.dataset_id)",
    **{x: f"case when c.dataset_id is not null then c.{x} else d.{x} end" for x in (
        "campaign", "project", "activity", "institution", "drs", "mapfile", "mapfile_checksum")},
    "registration_status": "case when c.dataset_id is not null then 'ACTIVE' else d.registration_status end",
    "retired_at": "case when c.dataset_id is null then d.retired_at end",
    "publication_status": _held("publication_status", "'PENDING'"),
    "publication_claim_id": _held("publication_claim_id", "null"),
    "publication_claimed_at": _held("publication_claimed_at", "null"),
    "archive_status": _held("archive_status", "'PENDING'"),
    "archive_completed_at": _held("archive_completed_at", "null"),
    "stac_status": _held("stac_status", "'UNCHECKED'"),
    "stac_checked_at": _held("stac_checked_at", "null"),
    "stac_http_status": _held("stac_http_status", "null"),
    "registered_at": f"case when d.dataset_id is not null then d.registered_at else timestamp '{NOW}' end",
}

Q["register_upsert"] = lambda c: registration.register_upsert(catalog_columns(c.datasets), _changes(c), NOW_TS)
SQL["register_upsert"] = f"with {_CHANGES} select {set_columns(_UPSERT)} from datasets d full join changes c on c.dataset_id = d.dataset_id"



def _changes_by_project(c):
    own = by_project(c)
    other = F.when(F.col("o_orderkey") % 50 == 3, F.lit("Elsewhere")).otherwise(F.col("project"))
    scan = own.select("mapfile", "dataset_id", F.lit(1).cast("bigint").alias("n_files"), F.lit(None).cast("string").alias("error"))
    roots = own.select("mapfile", "campaign", other.alias("project"), "activity", "institution")
    return registration.registration_changes(scan, _prints(c), roots, project_specs(c)).select("dataset_id", "project", "drs", "mapfile_checksum", "error")


def _members_sql(names) -> str:
    return "'{' || " + " || ', ' || ".join(f"'\"{n}\": \"' || p[{i}] || '\"'" for i, n in enumerate(names, 1)) + " || '}'"


Q["register_by_project"] = _changes_by_project
SQL["register_by_project"] = f"""with {BY_PROJECT} select dataset_id, case when o_orderkey % 50 = 3 then 'Elsewhere' else project end as project,
  case when o_orderkey % 50 = 3 or len(p) <> wanted then null when project = 'CMIP6' then {_members_sql(PROJECT_NAMES[0][1])} else {_members_sql(PROJECT_NAMES[1][1])} end as drs,
  case when o_orderkey % 3 = 0 then 'edited' else coalesce(mapfile_checksum, 'first') end as mapfile_checksum,
  case when o_orderkey % 50 = 3 then 'No identifier specification for project: Elsewhere'
    when len(p) <> wanted then 'Unexpected DRS format: dataset ID contains ' || len(p) || ' components, but ESGVOC defines ' || wanted || ' DRS components: ' || dataset_id end as error
from parts"""

Q["replace_files"] = lambda c: registration.replace_files(
    c.files, c.files.filter(F.col("o_orderkey") % 3 == 0).withColumn("file_path", F.concat("file_path", F.lit(".2"))))
SQL["replace_files"] = """select dataset_id, case when o_orderkey % 3 = 0 then file_path || '.2' else file_path end as file_path, file_size, checksum, mod_time from files"""


def _current(c):
    return c.datasets.filter(F.col("o_orderkey") % 6 != 1).select("campaign", "dataset_id")


Q["stale_datasets"] = lambda c: registration.stale_datasets(c.datasets, _current(c))
SQL["stale_datasets"] = "select dataset_id, campaign from datasets where registration_status = 'ACTIVE' and o_orderkey % 6 = 1"

Q["stale"] = lambda c: c.datasets.filter(F.col("registration_status") == "ACTIVE").select("dataset_id").subtract(
    _current(c).select("dataset_id"))
SQL["stale"] = """select dataset_id from datasets where registration_status = 'ACTIVE'
except select dataset_id from datasets where o_orderkey % 6 <> 1"""


def _scans(c):
    n = F.regexp_extract("name", r"(\d+)$", 1).cast("int")
    return c.campaigns.select(
        F.col("name").alias("campaign"), F.when(n % 5 == 0, F.lit(0)).otherwise(F.lit(10)).alias("scanned"),
        F.when(n % 4 == 0, F.lit(1)).otherwise(F.lit(0)).alias("failed"))


def _gone(value: str, column: str) -> str:
    gone = """d.registration_status = 'ACTIVE' and d.o_orderkey % 6 = 1 and d.campaign in (select name from campaigns
      where cast(regexp_extract(name, '(\\d+)$', 1) as int) % 5 <> 0 and cast(regexp_extract(name, '(\\d+)$', 1) as int) % 4 <> 0)"""
    return f"case when {gone} then {value} else d.{column} end"


Q["retire"] = lambda c: registration.retire(c.datasets, _current(c), _scans(c), NOW_TS)
SQL["retire"] = f"""select {set_columns({
    'registration_status': _gone("'RETIRED'", 'registration_status'), 'retired_at': _gone(f"timestamp '{NOW}'", 'retired_at'),
    'publication_claim_id': _gone('null', 'publication_claim_id'), 'publication_claimed_at': _gone('null', 'publication_claimed_at')})} from datasets d"""


def _registered(c):
    return workflows.register(
        catalog_columns(c.datasets), c.files, c.mapfile_lines, _prints(c), _roots(c), _NAMES, NOW_TS, include_files=True)


Q["registration_summary"] = lambda c: _registered(c).summary
SQL["registration_summary"] = f"""with {_SCAN}, regs as (select s.mapfile, d.campaign, s.dataset_id, s.error from scan s join datasets d on d.mapfile = s.mapfile),
  totals as (select campaign, count(*) filter (where error is null) as succeeded, count(*) filter (where error is not null) as failed,
    count(distinct case when error is null then dataset_id end) as current from regs group by campaign),
  gone as (select d.campaign, count(*) as n from datasets d where registration_status = 'ACTIVE' and dataset_id not in (select dataset_id from regs where error is null) group by d.campaign)
select t.campaign, succeeded, failed, current, case when failed = 0 then coalesce(n, 0) else 0 end as retired from totals t left join gone g on g.campaign = t.campaign"""

Q["registration_rejects"] = lambda c: _registered(c).rejected
SQL["registration_rejects"] = f"""with {_SCAN} select s.mapfile, d.campaign, s.error
from scan s join datasets d on d.mapfile = s.mapfile where s.error is not null"""

Q["replace_campaigns"] = lambda c: registration.replace_campaigns(
    c.campaigns, c.campaigns.filter(F.col("archive_root").isNotNull()).withColumns({
        "mapfile_root": F.lit("/new"), "name": F.when(F.col("archive_depth") == "variable", F.concat("name", F.lit("-b"))).otherwise(F.col("name"))}))
SQL["replace_campaigns"] = """select name, project, activity, institution, case when archive_depth = 'experiment' then '/new' else mapfile_root end as mapfile_root, archive_root, archive_depth from campaigns
union all select name || '-b', project, activity, institution, '/new', archive_root, archive_depth from campaigns where archive_depth = 'variable'"""


def _listed_tree(c):
    """The mapfiles' lines as a tree of files by campaign and mapfile key, listed in tasks."""
    folder = fresh_folder(c.spark, "tree")
    rows = c.mapfile_lines.join(c.datasets.select("mapfile", "campaign"), "mapfile").withColumn("part", F.col("o_orderkey") % 3)
    rows.select("campaign", "part", F.col("line").alias("value")).repartition("campaign", "part").write.partitionBy("campaign", "part").text(folder)
    found = listing.list_tree(c.spark, folder)
    place = F.regexp_extract("path", r"/campaign=([^/]+)/part=(\d)/part-[^/]*\.txt$", 1)
    return found.select(place.alias("campaign"), F.regexp_extract("path", r"/part=(\d)/part-[^/]*\.txt$", 1).alias("part"), "length").where(
        "campaign <> ''").groupBy("campaign", "part").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))


Q["file_listing"] = _listed_tree
SQL["file_listing"] = """select d.campaign, cast(l.o_orderkey % 3 as varchar) as part, cast(1 as bigint) as n_files, cast(sum(strlen(l.line) + 1) as bigint) as n_bytes
from mapfile_lines l join datasets d on d.mapfile = l.mapfile group by 1, 2"""
