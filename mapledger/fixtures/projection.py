"""The driver tables seen as a publication catalog.

Every view is one SQL text that both Spark and DuckDB run (``TS`` stands for the
zone-less timestamp type: ``timestamp_ntz`` in Spark, ``timestamp`` in DuckDB).
The views are test inputs; the library itself never depends on them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from mapledger.session import fresh_folder

BASE_TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")

_ITEM = "replace(dataset_id, '#', '.v')"

VIEWS: dict[str, str] = {
    "campaigns": """
select concat('camp-', cast(n_nationkey as string)) as name,
  case when n_nationkey % 2 = 0 then 'CMIP6' else 'CMIP6Plus' end as project,
  replace(r_name, ' ', '') as activity, concat('INST', cast(n_nationkey as string)) as institution,
  concat('/maps/', n_name) as mapfile_root,
  case when n_nationkey % 3 = 0 then concat('/archive/', n_name) end as archive_root,
  case when n_nationkey % 3 = 0 then case when n_nationkey % 6 = 0 then 'experiment' else 'variable' end end as archive_depth
from nation join region on n_regionkey = r_regionkey where n_nationkey <> 24
""",
    "datasets": """
select o_orderkey, dataset_id, concat('camp-', cast(nk as string)) as campaign, prj as project, act as activity,
  concat('INST', cast(nk as string)) as institution, cast(null as string) as drs,
  concat('/maps/NATION_', cast(nk as string), '/', cast(o_orderkey as string), '.map') as mapfile,
  case when o_orderkey % 17 = 0 then null else concat('sum-', cast(o_orderkey % 1000 as string)) end as mapfile_checksum,
  case when o_orderkey % 11 = 0 then 'RETIRED' else 'ACTIVE' end as registration_status,
  case when o_orderkey % 11 = 0 then o_orderdate + interval 30 day end as retired_at,
  case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'PENDING' else 'FAILED' end as publication_status,
  case when o_orderstatus = 'O' and o_orderkey % 5 = 0 then concat('run-', cast(o_orderkey % 3 as string)) end as publication_claim_id,
  case when o_orderstatus = 'O' and o_orderkey % 5 = 0 then
    case when o_orderkey % 2 = 0 then cast('2024-01-30 20:00:00' as TS) else cast('2024-01-30 23:30:00' as TS) end
  end as publication_claimed_at,
  case when o_orderstatus = 'F' and o_orderkey % 4 = 0 then 'SUCCESS' else 'PENDING' end as archive_status,
  case when o_orderstatus = 'F' and o_orderkey % 4 = 0 then o_orderdate + interval 9 day end as archive_completed_at,
  case o_orderkey % 7 when 0 then 'PRESENT' when 1 then 'ABSENT' else 'UNCHECKED' end as stac_status,
  case when o_orderkey % 7 < 2 then o_orderdate + interval 10 day end as stac_checked_at,
  case o_orderkey % 7 when 0 then 200 when 1 then 404 end as stac_http_status,
  o_orderdate as registered_at
from (select o.*, c_nationkey as nk, replace(r_name, ' ', '') as act,
    case when c_nationkey % 2 = 0 then 'CMIP6' else 'CMIP6Plus' end as prj,
    concat(case when c_nationkey % 2 = 0 then 'CMIP6' else 'CMIP6Plus' end, '.', replace(r_name, ' ', ''), '.INST', cast(c_nationkey as string),
      '.MODEL', cast(o_custkey % 7 as string), '.exp', cast(o_orderkey % 13 as string), '.r1i1p1f1.Amon.var',
      cast(o_orderkey as string), '.gr#', '2024', lpad(cast(1 + o_orderkey % 12 as string), 2, '0'), '01') as dataset_id
  from orders o join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey) b
""",
    "files": """
select d.dataset_id, d.o_orderkey, d.mapfile,
  concat('/data/', cast(l_partkey as string), '_', cast(l_linenumber as string), '.nc') as file_path,
  cast(max(l_quantity) * 1000 as bigint) as file_size,
  md5(concat(cast(l_partkey as string), '_', cast(l_linenumber as string))) as checksum,
  cast(max(l_shipdate) as string) as mod_time
from (select /*+ REPARTITION(l_orderkey) */ l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate from lineitem) l join datasets d on d.o_orderkey = l_orderkey
group by d.dataset_id, d.o_orderkey, d.mapfile, l_partkey, l_linenumber
""",
    "mapfile_lines": """
select mapfile, dataset_id, o_orderkey, cast(row_number() over (partition by dataset_id order by file_path) as bigint) as line_no,
  case when o_orderkey % 97 = 0 then 'malformed line'
    when o_orderkey % 101 = 0 and file_size % 2 = 0 then concat('other.', dataset_id, ' | ', file_path, ' | ', cast(file_size as string))
    when o_orderkey % 103 = 0 then concat(dataset_id, ' | ', file_path, ' | ', cast(file_size as string), 'k')
    when o_orderkey % 107 = 0 then concat('  ', dataset_id, ' |', file_path, '| ', cast(file_size as string), ' | note | checksum=old | checksum = ', checksum, ' | mod_time=a=b')
    else concat(dataset_id, ' | ', file_path, ' | ', cast(file_size as string), ' | checksum=', checksum, ' | mod_time=', mod_time) end as line
from files
""",
    "file_inventory": """
select distinct file_path as path, cast(1 as bigint) as length from files where o_orderkey % 10 <> 3
""",
    "mapfile_inventory": """
select mapfile as path, o_orderkey % 41 <> 0 as is_file, case when o_orderkey % 43 = 0 then cast(0 as bigint) else cast(100 as bigint) end as length
from datasets where o_orderkey % 37 <> 0
""",
    "publication_attempts": """
select cast(event_id as string) as attempt_id, d.dataset_id, concat('run-', cast(event_id % 3 as string)) as run_id,
  ts as started_at, case when event_type <> 'view' then ts + interval 5 minute end as finished_at,
  case event_type when 'purchase' then 'SUCCESS' when 'error' then 'FAILED' when 'view' then 'RUNNING'
    when 'click' then 'NO_STATUS' else 'UNREACHED' end as status,
  case event_type when 'purchase' then 0 when 'view' then null else 1 end as exit_code,
  case when event_type <> 'view' then concat('/logs/', cast(event_id % 3 as string), '.log') end as log_file,
  case when event_type = 'error' then concat('ERROR code ', props) end as error_message
from events join datasets d on d.o_orderkey = (event_id - event_id % 4) / 4
""",
    "publisher_log": """
select concat('run-', cast(event_id % 3 as string)) as run_id, cast((event_id - event_id % 50) / 50 as bigint) as batch_no, event_id as line_no,
  d.dataset_id,
  case case when event_id % 650 >= 150 and event_id % 650 < 200 and event_type in ('purchase', 'error') then 'quiet' else event_type end
    when 'purchase' then concat('INFO PUB_STATUS=PASS id=', replace(d.dataset_id, '#', '.v'), '|node.example')
    when 'error' then concat('INFO PUB_STATUS=FAIL id=', replace(d.dataset_id, '#', '.v'), '|node.example')
    when 'click' then
      case event_id % 7 when 0 then 'ERROR Failed to publish: Error 502: {broken body}'
        when 1 then concat('ERROR Failed to publish: Error 409: {"title": "Conflict", "detail": "", "type": "https://example.test/conflict", "instance": "i-', cast(event_id as string), '"}')
        when 2 then concat('ERROR Failed to publish: Error 422: {"status_code": 400, "detail": "Item `i` failed validation against `https://example.test/s', cast(event_id % 4 as string), '.json`: ''zzz'' is not one of [''air_temperature'', ''wind'']"}')
        else concat('x ERROR Failed to publish: Error 400: {"status_code": 400, "detail": "Item `i` failed validation against `https://example.test/s', cast(event_id % 4 as string), '.json`: ''air_temperatur'' is not one of [''air_temperature'', ''wind'']", "instance": "i-', cast(event_id as string), '"}') end
    when 'view' then concat('INFO PUB_STATUS=PASS id=unknown.', cast(event_id as string), '|node.example')
    else 'DEBUG noise' end as line
from events join datasets d on d.o_orderkey = (event_id - event_id % 4) / 4
""",
    "batch_members": """
select run_id, batch_no, cast(row_number() over (partition by run_id, batch_no order by dataset_id) as bigint) as pos, dataset_id,
  concat('/maps/', case when mod_key % 29 = 0 then 'same.map' else concat(cast(mod_key as string), '.map') end) as mapfile,
  case when mod_key % 53 = 0 then 'OSError: unreadable' end as stage_error
from (select distinct l.run_id, l.batch_no, l.dataset_id, d.o_orderkey as mod_key
  from publisher_log l join datasets d on d.dataset_id = l.dataset_id) m
""",
    "batch_runs": """
select run_id, batch_no, cast(case when batch_no % 4 = 0 then 124 else cast(batch_no % 3 as int) end as int) as exit_code,
  batch_no % 4 = 0 as timed_out, cast(sum(length(line) + 1) as bigint) as output_length,
  case when batch_no % 11 = 5 then 'FileNotFoundError: publisher' end as batch_error,
  concat('/logs/', run_id, '.log') as log_file
from publisher_log group by run_id, batch_no
""",
    "stac_responses": """
select project as collection_id, replace(dataset_id, '#', '.v') as item_id, a.attempt_no,
  case o_orderkey % 8 when 0 then 404 when 1 then 200 when 2 then case when a.attempt_no = 0 then 503 else 200 end
    when 3 then 500 when 4 then 403 else 200 end as http_status,
  case o_orderkey % 8 when 0 then null when 1 then concat('{"type":"Feature","id":"other","collection":"', project, '"}')
    when 3 then null when 4 then null when 5 then '{bad' when 6 then '[1]'
    else concat('{"type":"Feature","id":"', replace(dataset_id, '#', '.v'), '","collection":"', project, '"}') end as body,
  cast(null as string) as error
from (select *, 0 as attempt_no from datasets union all select *, 1 as attempt_no from datasets) a
""",
    "sheet_datasets": """
select o_orderkey + 1 as id, dataset_id, campaign,
  case when o_orderkey % 29 = 0 then 'RETIRED' else publication_status end as publication_status
from datasets where o_orderkey % 2 = 0
union all
select cast(-1 - n_nationkey as bigint), concat('ghost.', cast(n_nationkey as string)), 'camp-0', case when n_nationkey < 5 then 'PENDING' else 'RETIRED' end from nation
""",
    "sheet_failures": """
select event_id * 2 as id, dataset_id, campaign, run_id, started_at, status, exit_code, error_message from (
  select cast(a.attempt_id as bigint) as event_id, a.dataset_id, d.campaign, a.run_id, a.started_at, a.status, a.exit_code,
    case when cast(a.attempt_id as bigint) % 4 = 0 then a.error_message else 'changed text' end as error_message
  from publication_attempts a join datasets d on d.dataset_id = a.dataset_id
  where a.status = 'FAILED' and cast(a.attempt_id as bigint) % 2 = 0
) f
""",
    "archive_tasks": """
select concat('task-', cast(o_orderkey as string)) as task_id, dataset_id, campaign, coalesce(mapfile_checksum, 'late') as mapfile_checksum,
  mapfile as source_mapfile, concat('/archive/', cast(o_orderkey as string), '.map') as archive_path,
  registered_at as created_at, cast(null as TS) as completed_at, 'PENDING' as status, cast(null as string) as error_message
from datasets where publication_status = 'SUCCESS' and archive_status = 'PENDING'
""",
    "archive_results": """
select o_orderkey * 2 + r.rep as row_no, case when o_orderkey % 23 = 0 then 'task-none' else concat('task-', cast(o_orderkey as string)) end as task_id,
  dataset_id, case when o_orderkey % 9 = 0 then 'tampered' else coalesce(mapfile_checksum, 'late') end as mapfile_checksum,
  concat('/archive/', cast(o_orderkey as string), '.map') as archive_path,
  case (o_orderkey + r.rep) % 5 when 0 then 'SUCCESS' when 1 then 'ALREADY_EXISTS' when 2 then 'CONFLICT' when 3 then 'FAILED' else 'WOULD_ARCHIVE' end as status,
  concat('note ', cast(r.rep as string)) as error_message
from (select *, 0 as rep from datasets union all select *, 1 as rep from datasets where o_orderkey % 6 = 0) r
where publication_status = 'SUCCESS' and archive_status = 'PENDING'
""",
    "path_hashes": """
select source_mapfile as path, case when o % 10 = 1 then 'edited' else mapfile_checksum end as sha256
from (select *, cast(replace(task_id, 'task-', '') as bigint) as o from archive_tasks) t where o % 13 <> 0
union all
select archive_path, case when o % 4 = 1 then mapfile_checksum else 'different' end
from (select *, cast(replace(task_id, 'task-', '') as bigint) as o from archive_tasks) t where o % 4 <> 2
""",
    # The hint spreads the documents over tasks, as a folder of item files would be; DuckDB reads a comment.
    "stac_items": """
select /*+ REPARTITION(o_orderkey) */ o_orderkey, replace(dataset_id, '#', '.v') as item_id, concat(replace(dataset_id, '#', '.v'), case when o_orderkey % 31 = 0 then 'x' else '' end, '.json') as file_name,
  case when o_orderkey % 19 = 0 then '{bad' else concat('{"type":"Feature","stac_version":"1.1.0","id":"', replace(dataset_id, '#', '.v'), '","collection":"', project,
    '","geometry":{"type":"Point","coordinates":[0.0,0.0]}', case when o_orderkey % 41 = 0 then '' else ',"links":[]' end, ',"assets":{}',
    ',"stac_extensions":[', case when o_orderkey % 13 = 0 then '' when o_orderkey % 13 = 1 then '"https://example.test/s1.json","https://example.test/gone.json","https://example.test/p1.json"'
      when o_orderkey % 13 = 2 then '"https://example.test/p1.json"' else '"https://example.test/s1.json"' end, '],"bbox":[', case when o_orderkey % 7 = 0 then '-190.0' else '-180.0' end,
    ',-90.0,180.0,90.0],"properties":{"datetime":"2024-01-01T00:00:00Z","cmip6:status":"', case when o_orderkey % 3 = 0 then 'publshed' else 'published' end, '"',
    case when o_orderkey % 5 = 0 then '' else concat(',"cmip6:rank":', cast(o_orderkey % 5 as string)) end, '}}') end as doc
from datasets
""",
    # Items with one member of five kinds, each judged by one of eight schemas.
    "ruled_items": """
select o_orderkey, replace(dataset_id, '#', '.v') as item_id, concat(replace(dataset_id, '#', '.v'), '.json') as file_name,
  concat('{"type":"Feature","stac_version":"1.1.0","id":"', replace(dataset_id, '#', '.v'), '","collection":"', project,
    '","geometry":{"type":"Point","coordinates":[0.0,0.0]},"links":[],"assets":{},"bbox":[-180.0,-90.0,180.0,90.0],"stac_extensions":["https://example.test/t',
    cast(cast((o_orderkey - o_orderkey % 5) / 5 as bigint) % 8 as string), '.json"],"properties":{"datetime":"2024-01-01T00:00:00Z","v":',
    case o_orderkey % 5 when 0 then '"ab"' when 1 then '3' when 2 then '{"a":1,"b":"x"}' when 3 then '["p","p",4]' else '6' end, '}}') as doc
from datasets
""",
    "retained_items": """
select file_name as name, o_orderkey % 9 <> 2 as is_regular from stac_items where o_orderkey % 3 = 1
""",
    "staged_items": """
select file_name as name from stac_items where o_orderkey % 4 <> 3
""",
}

# Two schema documents; a third declared one is missing on purpose.
SCHEMA_DOCS = {
    "https://example.test/s1.json": (
        '{"$schema":"http://json-schema.org/draft-07/schema#","type":"object","required":["properties"],'
        '"properties":{"properties":{"type":"object","required":["cmip6:rank"],"properties":'
        '{"cmip6:status":{"type":"string","enum":["published","retracted"]},'
        '"cmip6:rank":{"type":"integer","minimum":2}}}}}'
    ),
    "https://example.test/p1.json": (
        '{"type":"object","required":["cmip6:rank","cmip6:status"],"properties":{"cmip6:status":{"type":"string"}}}'
    ),
}

# What each of eight schemas asks of the member v: a choice, one of two, a ban, a condition, a closed object, elements
# that differ, a reference to combined rules, a choice for each element.
TREE_RULES = (
    '{"anyOf":[{"type":"string","minLength":3},{"type":"object","required":["c"]}]}',
    '{"oneOf":[{"multipleOf":2},{"multipleOf":3}]}',
    '{"not":{"type":["string","array"]}}',
    '{"if":{"type":"object"},"then":{"required":["c"],"properties":{"b":{"type":"integer"}}},"else":{"type":"number"}}',
    '{"type":["object","string","number","array"],"properties":{"a":{}},"additionalProperties":false}',
    '{"uniqueItems":true,"items":{"type":"string"}}',
    '{"$ref":"#/definitions/d"}',
    '{"items":{"anyOf":[{"type":"integer","minimum":5},{"enum":["p","q"]}]},"minProperties":3}',
)
_DEFINITIONS = '{"d":{"allOf":[{"not":{"const":3}},{"additionalProperties":{"type":"integer"}}]}}'

NOW = "2024-02-01 00:00:00"
CLAIM_NOW = "2024-01-31 00:00:00"


def _needed(text: str) -> list[str]:
    """The views a text mentions, in dependency order."""
    wanted: set[str] = set()

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in wanted and re.search(rf"\b{name}\b", sql):
                wanted.add(name)
                visit(VIEWS[name])

    visit(text)
    return [n for n in VIEWS if n in wanted]


def oracle(body: str) -> str:
    """A DuckDB statement: the views the body uses as CTEs, then the body."""
    body = body.strip()
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in _needed(body))
    head, tail = "with ", body
    if re.match(r"with\s+recursive\b", body, re.I):
        head, tail = "with recursive ", re.sub(r"^with\s+recursive\s+", ", ", body, flags=re.I)
    elif re.match(r"with\b", body, re.I):
        tail = re.sub(r"^with\s+", ", ", body, flags=re.I)
    if not ctes:
        return re.sub(r"\bTS\b", "timestamp", body)
    return re.sub(r"\bTS\b", "timestamp", f"{head}{ctes}\n{tail}")


class Catalog:
    """Lazy access to the projected views of one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        if name not in self._frames:
            text = VIEWS[name]
            for table in BASE_TABLES:
                if re.search(rf"\b{table}\b", text):
                    self.base(table).createOrReplaceTempView(table)
            for other in VIEWS:
                if other != name and re.search(rf"\b{other}\b", text):
                    getattr(self, other).createOrReplaceTempView(other)
            self._frames[name] = self.spark.sql(re.sub(r"\bTS\b", "timestamp_ntz", text))
        return self._frames[name]

    @property
    def schema_docs(self) -> DataFrame:
        return self.spark.createDataFrame(list(SCHEMA_DOCS.items()), "url string, doc string")

    @property
    def tree_schema_docs(self) -> DataFrame:
        rows = [(f"https://example.test/t{k}.json", f'{{"properties":{{"properties":{{"properties":{{"v":{rule}}}}}}},"definitions":{_DEFINITIONS}}}')
                for k, rule in enumerate(TREE_RULES)]
        return self.spark.createDataFrame(rows, "url string, doc string")


class WrittenCatalog(Catalog):
    """The views, each written once to the shared folder when first asked for: queries on it measure their own work."""

    def __getattr__(self, name: str) -> DataFrame:
        known = name in self.__dict__.get("_frames", {})
        df = super().__getattr__(name)
        if known:
            return df
        folder = fresh_folder(self.spark, name)
        df.write.parquet(folder)
        self._frames[name] = self.spark.read.schema(df.schema).parquet(folder)
        return self._frames[name]
