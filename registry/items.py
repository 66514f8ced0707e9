"""Registered queries: catalog items, schema rules, comparison with the remote catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import states
from mapledger.functions.schema_rules import flatten_schemas
from mapledger.operators import items, reconcile, selections
from mapledger.session import fresh_folder, shuffles_freed
from mapledger.sinks import outputs
from mapledger.sources import files, responses
from registry.common import BASE_URL, NOW, NOW_TS, catalog_columns, removed_files, set_columns, written_files

Q, SQL = {}, {}

# ---- items ----

_BASE = """base as (select o_orderkey as k, item_id, file_name, doc,
    case when o_orderkey % 19 = 0 then 'json' when o_orderkey % 41 = 0 then 'links' when o_orderkey % 7 = 0 then 'bbox' when o_orderkey % 13 = 0 then 'none' else 'rules' end as stage,
    case when o_orderkey % 19 = 0 then null when o_orderkey % 13 = 0 then 0 when o_orderkey % 13 = 1 then 3 else 1 end as n_ext from stac_items)"""
_DOC_SORTED = """'{"assets":{},"bbox":[' || case when k % 7 = 0 then '-190' else '-180' end || ',-90,180,90],"collection":"' || split_part(item_id, '.', 1)
    || '","geometry":{"coordinates":[0,0],"type":"Point"},"id":"' || item_id || '","properties":{' || case when k % 5 = 0 then '' else '"cmip6:rank":' || (k % 5) || ',' end
    || '"cmip6:status":"' || case when k % 3 = 0 then 'publshed' else 'published' end || '","datetime":"2024-01-01T00:00:00Z"},"stac_extensions":['
    || case when k % 13 = 0 then '' when k % 13 = 1 then '"https://example.test/s1.json","https://example.test/gone.json","https://example.test/p1.json"'
      when k % 13 = 2 then '"https://example.test/p1.json"' else '"https://example.test/s1.json"' end || '],"stac_version":"1.1.0","type":"Feature"}'"""
_EARLY = f"""early as (select item_id, case when stage = 'json' then 'stac-item-json' else 'stac-core' end as schema_url, 0 as issue_no,
    case stage when 'json' then '$' when 'links' then '$.links' when 'bbox' then '$' else '$.stac_extensions' end as path,
    case stage when 'json' then 'JSONDecodeError: document is not valid JSON' when 'links' then 'Field required'
      when 'bbox' then 'ValueError: bbox is outside WGS84 bounds: [-190.0, -90.0, 180.0, 90.0]' else 'must contain at least one schema URL' end as message,
    case when stage = 'links' then 'missing' end as validator, case when stage = 'links' then {_DOC_SORTED} end as rejected_value
  from base where stage <> 'rules')"""
_EXT = """ext as (select b.*, e.n as schema_no, case when b.k % 13 = 1 then ['https://example.test/s1.json', 'https://example.test/gone.json', 'https://example.test/p1.json'][e.n + 1]
      when b.k % 13 = 2 then 'https://example.test/p1.json' else 'https://example.test/s1.json' end as url
    from base b join (select 0 as n union all select 1 union all select 2) e on e.n < b.n_ext where b.stage = 'rules')"""
_PROPS = """'{' || case when k % 5 = 0 then '' else '"cmip6:rank": ' || (k % 5) || ', ' end || '"cmip6:status": "' || case when k % 3 = 0 then 'publshed' else 'published' end || '", "datetime": "2024-01-01T00:00:00Z"}'"""
_ISSUES = f"""issues as (
  select item_id, schema_no, url as schema_url, '$.properties' as path, 'required' as validator, case when url like '%s1.json' then 1 else 0 end as depth,
    case when url like '%s1.json' then 3 else 1 end as rule_no, '''cmip6:rank'' is a required property' as message, {_PROPS} as rejected_value, cast(null as varchar) as suggested_value
    from ext where k % 5 = 0 and url not like '%gone%'
  union all select item_id, schema_no, url, '$.properties.cmip6:status', 'enum', 2, 5, '''publshed'' is not one of [''published'', ''retracted'']', 'publshed', 'published'
    from ext where k % 3 = 0 and url like '%s1.json'
  union all select item_id, schema_no, url, '$.properties.cmip6:rank', 'minimum', 2, 7, '1 is less than the minimum of 2', '1', null from ext where k % 5 = 1 and url like '%s1.json')"""
VERDICTS = f"""{_BASE}, {_EARLY}, {_EXT}, {_ISSUES},
  asked as (select item_id, min(case when url like '%gone%' then schema_no end) as gone from ext group by item_id),
  counted as (select i.*, row_number() over (partition by i.item_id order by schema_no, -depth, path, rule_no) as rn, count(*) over (partition by i.item_id) as n
    from issues i join asked a on a.item_id = i.item_id where a.gone is null or i.schema_no < a.gone),
  verdicts as (select item_id, false as valid, cast(1 as bigint) as n_issues, schema_url, path, rejected_value, cast(null as varchar) as suggested_value, cast(null as varchar) as error,
      'Local STAC validation failed: ' || path || ': ' || message as summary from early
    union all select a.item_id, case when c.n is not null then false when a.gone is not null then null else true end, coalesce(c.n, 0), c.schema_url, c.path, c.rejected_value, c.suggested_value,
      case when a.gone is not null then 'https://example.test/gone.json: LookupError: schema document not available' end,
      case when c.n is not null then 'Local STAC validation failed: ' || c.path || ': ' || c.message || coalesce(' Likely accepted value: ''' || c.suggested_value || '''.', '')
        when a.gone is not null then 'Local STAC validation unavailable: https://example.test/gone.json: LookupError: schema document not available' else 'Local STAC validation passed.' end
    from asked a left join counted c on c.item_id = a.item_id and c.rn = 1)"""

Q["stac_item_scan"] = lambda c: c.stac_items.select(
    "item_id", F.try_parse_json("doc").isNotNull().alias("readable"), F.get_json_object("doc", "$.collection").alias("collection"))
SQL["stac_item_scan"] = """select item_id, json_valid(doc) as readable, case when json_valid(doc) then json_extract_string(doc, '$.collection') end as collection from stac_items"""

Q["is_stac_item"] = lambda c: items.is_generated_item(c.stac_items).select("file_name", "is_item")
SQL["is_stac_item"] = "select file_name, o_orderkey % 19 <> 0 and o_orderkey % 31 <> 0 as is_item from stac_items"

Q["stac_clean_preview"] = lambda c: items.clean_preview(c.stac_items.filter(F.col("file_name").rlike(r"^CMIP6\..*\.json$")))
SQL["stac_clean_preview"] = "select file_name from stac_items where o_orderkey % 19 <> 0 and o_orderkey % 31 <> 0 and file_name like 'CMIP6.%.json'"


#: Item files that lie on the disk at once, about; each takes a block and an entry of its own. Files that go before the
#: store has written them out go fast.
FILES = 1 << 16


def _of_item_files(c, read):
    """What ``read`` makes of the folders that hold every item as a file of its own.

    More than FILES items are written, read and removed by lots of their names, one lot after the other."""
    folder = fresh_folder(c.spark, "items")
    named = c.stac_items.select(F.col("file_name").alias("name"), F.col("doc").alias("text"))
    lots = max(1, -(-c.datasets.count() // FILES))
    with shuffles_freed(c.spark):
        named.withColumn("lot", F.pmod(F.xxhash64("name"), F.lit(lots)).cast("int")).write.option(
            "compression", "zstd").partitionBy("lot").parquet(f"{folder}/lots")
        schema, refused = None, None
        for lot in range(lots):
            part = c.spark.read.schema("name string, text string, lot int").parquet(f"{folder}/lots").where(F.col("lot") == lot)
            try:
                found = read(written_files(part, f"{folder}/files-{lot}"))
                schema = found.schema
                found.write.option("compression", "zstd").mode("append").parquet(f"{folder}/read")
            except AnalysisException as e:
                # A lot may hold no file of the pattern; all together have to.
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                refused = e
            removed_files(part, f"{folder}/files-{lot}")
    if schema is None:
        raise refused
    return c.spark.read.schema(schema).parquet(f"{folder}/read")


Q["stac_item_files"] = lambda c: _of_item_files(c, lambda folder: files.read_items(c.spark, folder).select(
    "file_name", "item_id", F.try_parse_json("doc").isNotNull().alias("readable"), F.md5(F.col("doc").cast("binary")).alias("doc_hash")))
SQL["stac_item_files"] = """select file_name, regexp_replace(file_name, '\\.json$', '') as item_id, json_valid(doc) as readable, md5(doc) as doc_hash from stac_items"""

Q["stac_clean_files"] = lambda c: _of_item_files(c, lambda folder: items.clean_preview(files.read_item_folder(c.spark, folder, "CMIP6.*.json")))
SQL["stac_clean_files"] = "select file_name from stac_items where o_orderkey % 19 <> 0 and o_orderkey % 31 <> 0 and file_name like 'CMIP6.%.json'"

Q["json_path"] = lambda c: c.datasets.select(
    "dataset_id", items.json_path(F.array(F.lit("properties"), F.col("campaign"), F.concat(F.lit("["), (F.col("o_orderkey") % 7).cast("string"), F.lit("]")))).alias("path"))
SQL["json_path"] = "select dataset_id, '$.properties.' || campaign || '[' || (o_orderkey % 7) || ']' as path from datasets"

Q["item_structure"] = lambda c: items.structure_issues(c.stac_items)
SQL["item_structure"] = f"with {_BASE}, {_EARLY} select * from early"

Q["schema_registry"] = lambda c: items.item_schemas(c.stac_items, flatten_schemas(c.schema_docs)).select(
    "item_id", "schema_no", "url", F.col("contract").isNotNull().alias("known"))
SQL["schema_registry"] = f"with {_BASE}, {_EXT} select item_id, schema_no, url, url not like '%gone%' as known from ext"

Q["item_schema"] = lambda c: items.item_schemas(c.stac_items, flatten_schemas(c.schema_docs)).select(
    "item_id", "url", F.size("rules").alias("n_rules"))
SQL["item_schema"] = f"""with {_BASE}, {_EXT} select item_id, url, case when url like '%s1.json' then 8 when url like '%p1.json' then 4 end as n_rules from ext"""

Q["schema_target"] = lambda c: items.schema_targets(c.stac_items, flatten_schemas(c.schema_docs))
SQL["schema_target"] = f"""with {_BASE}, {_EXT} select item_id, schema_no, url, case when url like '%s1.json' then '$' when url like '%p1.json' then '$.properties' end as target from ext"""

Q["schema_issues"] = lambda c: items.schema_issues(c.stac_items, flatten_schemas(c.schema_docs))
SQL["schema_issues"] = f"""with {_BASE}, {_EXT}, {_ISSUES} select *, path || ': ' || message || coalesce(' Likely accepted value: ''' || suggested_value || '''.', '') as concise from issues"""

Q["item_verdict"] = lambda c: items.item_verdicts(c.stac_items, flatten_schemas(c.schema_docs))
SQL["item_verdict"] = f"with {VERDICTS} select * from verdicts"

# ---- rule trees: the statement reads the documents ----

_REPR = """case when t = 'VARCHAR' then '''' || json_extract_string(v, '$') || ''''
    else replace(replace(replace(cast(v as varchar), '"', ''''), ':', ': '), ',', ', ') end"""
_SHOWN = "case when t = 'VARCHAR' then json_extract_string(v, '$') else replace(replace(cast(v as varchar), ':', ': '), ',', ', ') end"
_RULED = f"""r as (select item_id, json_extract_string(doc, '$.stac_extensions[0]') as url, json_extract(doc, '$.properties.v') as v, json_type(doc, '$.properties.v') as t from ruled_items),
  s as (select *, cast(regexp_extract(url, 't(\\d)', 1) as int) as n, {_REPR} as shown, {_SHOWN} as rejected, t in ('UBIGINT', 'BIGINT', 'DOUBLE') as numeric from r),
  elements as (select item_id, url, n, generate_subscripts(json_extract(v, '$[*]'), 1) - 1 as i, unnest(json_extract(v, '$[*]')) as x from s where t = 'ARRAY'),
  members as (select item_id, url, n, unnest(json_keys(v)) as name, unnest(json_extract(v, '$.*')) as x from s where t = 'OBJECT'),
  found as (
    select item_id, url, '$.properties.v' as path, case when t = 'VARCHAR' then 'minLength' else 'type' end as validator, 2 as depth,
        shown || case when t = 'VARCHAR' then ' is too short' else ' is not of type ''string''' end as message, rejected as rejected_value
      from s where n = 0 and not (t = 'VARCHAR' and length(rejected) >= 3) and not (t = 'OBJECT' and list_contains(json_keys(v), 'c'))
    union all select item_id, url, '$.properties.v', 'oneOf', 2, shown || ' is valid under each of {{''multipleOf'': 3}}, {{''multipleOf'': 2}}', rejected
      from s where n = 1 and (not numeric or try_cast(rejected as double) % 6 = 0)
    union all select item_id, url, '$.properties.v', 'not', 2, shown || ' should not be valid under {{''type'': [''string'', ''array'']}}', rejected from s where n = 2 and t in ('VARCHAR', 'ARRAY')
    union all select item_id, url, '$.properties.v', 'required', 2, '''c'' is a required property', rejected from s where n = 3 and t = 'OBJECT' and not list_contains(json_keys(v), 'c')
    union all select item_id, url, '$.properties.v', 'type', 2, shown || ' is not of type ''number''', rejected from s where n = 3 and t <> 'OBJECT' and not numeric
    union all select item_id, url, '$.properties.v.b', 'type', 3, '''' || json_extract_string(x, '$') || ''' is not of type ''integer''', json_extract_string(x, '$')
      from members where n = 3 and name = 'b' and json_type(x) <> 'UBIGINT'
    union all select item_id, url, '$.properties.v', 'additionalProperties', 2, 'Additional properties are not allowed (''' || list_filter(json_keys(v), lambda x : x <> 'a')[1] || ''' was unexpected)', rejected
      from s where n = 4 and t = 'OBJECT' and len(list_filter(json_keys(v), lambda x : x <> 'a')) > 0
    union all select item_id, url, '$.properties.v[' || i || ']', 'type', 3, cast(x as varchar) || ' is not of type ''string''', cast(x as varchar) from elements where n = 5 and json_type(x) <> 'VARCHAR'
    union all select item_id, url, '$.properties.v', 'uniqueItems', 2, shown || ' has non-unique elements', rejected
      from s where n = 5 and t = 'ARRAY' and len(list_distinct(json_extract(v, '$[*]'))) < json_array_length(v)
    union all select item_id, url, '$.properties.v', 'not', 2, '3 should not be valid under {{''const'': 3}}', rejected from s where n = 6 and numeric and try_cast(rejected as double) = 3
    union all select item_id, url, '$.properties.v.' || name, 'type', 3, '''' || json_extract_string(x, '$') || ''' is not of type ''integer''', json_extract_string(x, '$')
      from members where n = 6 and json_type(x) <> 'UBIGINT'
    union all select item_id, url, '$.properties.v[' || i || ']', 'minimum', 3, cast(x as varchar) || ' is less than the minimum of 5', cast(x as varchar)
      from elements where n = 7 and json_type(x) = 'UBIGINT' and try_cast(cast(x as varchar) as int) < 5
    union all select item_id, url, '$.properties.v', 'minProperties', 2, shown || ' does not have enough properties', rejected from s where n = 7 and t = 'OBJECT' and len(json_keys(v)) < 3)"""

Q["rule_tree_issues"] = lambda c: items.schema_issues(c.ruled_items, flatten_schemas(c.tree_schema_docs)).select(
    "item_id", "schema_url", "path", "validator", "message", "rejected_value")
SQL["rule_tree_issues"] = f"with {_RULED} select item_id, url as schema_url, path, validator, message, rejected_value from found"

Q["rule_tree_verdict"] = lambda c: items.item_verdicts(c.ruled_items, flatten_schemas(c.tree_schema_docs)).select(
    "item_id", "valid", "n_issues", "schema_url", "path", "rejected_value", "summary")
SQL["rule_tree_verdict"] = f"""with {_RULED}, firsts as (select *, row_number() over (partition by item_id order by depth desc, path) as rn, count(*) over (partition by item_id) as m from found)
select r.item_id, f.item_id is null as valid, coalesce(m, 0) as n_issues, f.url as schema_url, f.path, f.rejected_value,
  case when f.item_id is null then 'Local STAC validation passed.' else 'Local STAC validation failed: ' || f.path || ': ' || f.message end as summary
from r left join firsts f on f.item_id = r.item_id and rn = 1"""

Q["item_retention"] = lambda c: items.retention(
    c.datasets.select("dataset_id", F.col("publication_status").alias("status")), c.retained_items, c.staged_items)
SQL["item_retention"] = """with r as (select dataset_id, publication_status as status, replace(dataset_id, '#', '.v') || '.json' as name from datasets),
  j as (select r.*, name in (select name from retained_items where is_regular) as kept, name in (select name from staged_items) as fresh from r)
select dataset_id, status, case when status = 'SUCCESS' and kept then 'removed' when status = 'SUCCESS' then 'absent' when status = 'FAILED' and fresh then 'retained'
  when status = 'FAILED' then 'missing' else 'ignored' end as action, case when status = 'FAILED' and fresh then name end as stored_as from j"""

# ---- comparison with the remote catalog ----

_JUDGED = """judged as (select collection_id, item_id, attempt_no, http_status, body,
    case when http_status = 404 then 'ABSENT' when http_status = 200 and not json_valid(body) then null
      when http_status = 200 and json_type(body) = 'OBJECT' and json_extract_string(body, '$.id') = item_id and json_extract_string(body, '$.collection') = collection_id
        and json_extract_string(body, '$.type') = 'Feature' then 'PRESENT' when http_status = 200 then 'MISMATCH' when http_status = 429 or http_status >= 500 then null else 'ERROR' end as o
    from stac_responses),
  firsts as (select *, row_number() over (partition by collection_id, item_id order by case when o is null then 1 else 0 end, case when o is null then -attempt_no else attempt_no end) as rn from judged),
  answers as (select collection_id, item_id, coalesce(o, 'ERROR') as outcome, case when o is not null then http_status end as http_status,
    case when o is not null and http_status = 200 and json_valid(body) then case when json_type(body) = 'OBJECT' then json_extract_string(body, '$.id') end end as response_item_id,
    case when o is not null and http_status = 200 and json_valid(body) then case when json_type(body) = 'OBJECT' then json_extract_string(body, '$.collection') end end as response_collection,
    case when o is not null then sha256(coalesce(body, '')) end as response_hash,
    case when o is null and http_status = 200 then 'JSONDecodeError: response body is not valid JSON' when o is null then 'HTTPError: ' || http_status || ' Server Error'
      when o = 'MISMATCH' then 'STAC response identity or type does not match the request' when o = 'ERROR' then 'Unexpected HTTP status ' || http_status end as error_message
    from firsts where rn = 1)"""

Q["stac_response_scan"] = lambda c: c.stac_responses.groupBy("collection_id", "http_status").agg(
    F.count(F.lit(1)).alias("n"), F.count("body").alias("n_bodies"))
SQL["stac_response_scan"] = "select collection_id, http_status, count(*) as n, count(body) as n_bodies from stac_responses group by all"



def _recorded(c):
    """Responses with bytes that are no text, an overload, a transport error, and a third attempt for some."""
    k = F.col("k")
    rows = c.stac_responses.join(c.datasets.select(
        F.col("project").alias("collection_id"), F.replace("dataset_id", F.lit("#"), F.lit(".v")).alias("item_id"), F.col("o_orderkey").alias("k")),
        ["collection_id", "item_id"])
    good = F.concat(F.lit('{"type":"Feature","id":"'), "item_id", F.lit('","collection":"'), "collection_id", F.lit('"}'))
    third = rows.filter((k % 16 == 3) & (F.col("attempt_no") == 1)).withColumns({
        "attempt_no": F.lit(2), "http_status": F.lit(200), "body": good, "error": F.lit(None).cast("string")})
    lost = (k % 8 == 3) & (F.col("attempt_no") == 1)
    odd = rows.withColumns({
        "http_status": F.when(lost, F.lit(None)).when(k % 8 == 3, F.lit(429)).otherwise(F.col("http_status")),
        "error": F.when(lost, F.lit("ConnectionError: reset")).otherwise(F.col("error"))})
    everything = odd.unionByName(third)
    return everything.withColumn("body", F.when(k % 8 == 1, F.concat(F.unhex(F.lit("FF7B")), F.col("body").cast("binary"))).otherwise(F.col("body").cast("binary")))


def _recorded_store(c):
    return responses.write_responses(_recorded(c), fresh_folder(c.spark, "responses"))


Q["recorded_responses"] = lambda c: responses.read_responses(c.spark, _recorded_store(c)).select(
    "collection_id", "item_id", "attempt_no", "http_status", states.response_hash(F.col("body")).alias("response_hash"), "error")
_RECORDED = """kept as (select r.collection_id, r.item_id, r.attempt_no, r.http_status, cast(r.body as varchar) as body, r.error, d.o_orderkey as k
    from stac_responses r join datasets d on d.project = r.collection_id and replace(d.dataset_id, '#', '.v') = r.item_id),
  recorded as (select collection_id, item_id, attempt_no, k, case when k % 8 = 3 and attempt_no = 1 then null when k % 8 = 3 then 429 else http_status end as http_status,
      case when k % 8 = 1 then unhex('FF7B') || encode(body) else encode(body) end as body, case when k % 8 = 3 and attempt_no = 1 then 'ConnectionError: reset' else error end as error from kept
    union all select collection_id, item_id, 2, k, 200, encode('{"type":"Feature","id":"' || item_id || '","collection":"' || collection_id || '"}'), null from kept where k % 16 = 3 and attempt_no = 1)"""
SQL["recorded_responses"] = f"with {_RECORDED} select collection_id, item_id, attempt_no, http_status, sha256(coalesce(body, encode(''))) as response_hash, error from recorded"

Q["recorded_answers"] = lambda c: reconcile.judged_responses(responses.read_responses(c.spark, _recorded_store(c))).select(
    "collection_id", "item_id", "outcome", "http_status", "response_hash", "error_message")
SQL["recorded_answers"] = f"""with {_RECORDED}, told as (select *, k % 8 in (0, 2, 4, 6, 7) or k % 16 = 3 as final from recorded),
  one as (select collection_id, item_id, k, arg_max(http_status, attempt_no) as s, arg_max(body, attempt_no) as b, bool_or(final) as final from told group by all)
select collection_id, item_id, case when not final or k % 8 = 4 then 'ERROR' when k % 8 = 0 then 'ABSENT' when k % 8 = 6 then 'MISMATCH' else 'PRESENT' end as outcome,
  case when final then s end as http_status, case when final then sha256(coalesce(b, encode(''))) end as response_hash,
  case when k % 8 in (1, 5) then 'JSONDecodeError: response body is not valid JSON' when not final then 'ConnectionError: reset' when k % 8 = 4 then 'Unexpected HTTP status 403'
    when k % 8 = 6 then 'STAC response identity or type does not match the request' end as error_message from one"""


def _some_recorded(c):
    """Of one collection every fortieth item: only its folders are read."""
    wanted = c.datasets.filter((F.col("project") == "CMIP6") & (F.col("o_orderkey") % 40 == 2)).select(
        F.col("project").alias("collection_id"), F.replace("dataset_id", F.lit("#"), F.lit(".v")).alias("item_id"))
    return responses.read_responses(c.spark, _recorded_store(c), wanted).select("item_id", "attempt_no", "http_status")


Q["recorded_lookup"] = _some_recorded
SQL["recorded_lookup"] = f"with {_RECORDED} select item_id, attempt_no, http_status from recorded where collection_id = 'CMIP6' and k % 40 = 2"

Q["response_hash"] = lambda c: c.stac_responses.select("item_id", "attempt_no", states.response_hash(F.col("body")).alias("response_hash"))
SQL["response_hash"] = "select item_id, attempt_no, sha256(coalesce(body, '')) as response_hash from stac_responses"

Q["first_conclusive_response"] = lambda c: reconcile.judged_responses(c.stac_responses)
SQL["first_conclusive_response"] = f"with {_JUDGED} select * from answers"

Q["catalog_lookup"] = lambda c: c.datasets.select(
    "dataset_id", F.col("project").alias("collection_id"), F.replace("dataset_id", F.lit("#"), F.lit(".v")).alias("item_id")).join(
    reconcile.judged_responses(c.stac_responses), ["collection_id", "item_id"], "left").select("dataset_id", "outcome", "http_status")
SQL["catalog_lookup"] = f"""with {_JUDGED} select d.dataset_id, a.outcome, a.http_status from datasets d left join answers a
on a.collection_id = d.project and a.item_id = replace(d.dataset_id, '#', '.v')"""

Q["reconcile_inputs"] = lambda c: selections.reconcile_scope(c.datasets).join(
    reconcile.latest_success(c.publication_attempts), "dataset_id", "left")
SQL["reconcile_inputs"] = """select d.dataset_id, d.campaign, d.project, d.publication_status, max(case when p.status = 'SUCCESS' then p.finished_at end) as latest_success
from datasets d left join publication_attempts p on p.dataset_id = d.dataset_id where d.registration_status = 'ACTIVE' group by all"""

_GRACE = 20 * 86400  # long enough that the fixture has datasets on both sides


def _checks(c):
    return reconcile.compare(selections.reconcile_scope(c.datasets), c.publication_attempts, c.stac_responses, BASE_URL, NOW_TS, grace_seconds=_GRACE)


CHECKS = f"""{_JUDGED}, recent as (select dataset_id, max(case when status = 'SUCCESS' then finished_at end) as latest_success from publication_attempts group by dataset_id),
  looked as (select d.dataset_id, d.campaign, d.project, d.publication_status, r.latest_success, d.project as collection_id, replace(d.dataset_id, '#', '.v') as item_id,
      coalesce(d.publication_status = 'SUCCESS' and r.latest_success > timestamp '{NOW}' - interval {_GRACE} second, false) as waiting, a.outcome as o, a.http_status as h,
      a.response_item_id as ri, a.response_collection as rc, a.response_hash as rh, a.error_message as em
    from datasets d left join recent r on r.dataset_id = d.dataset_id left join answers a on a.collection_id = d.project and a.item_id = replace(d.dataset_id, '#', '.v')
    where d.registration_status = 'ACTIVE'),
  checks as (select dataset_id, campaign, project, publication_status, latest_success, collection_id, item_id,
      '{BASE_URL}/collections/' || url_encode(collection_id) || '/items/' || url_encode(item_id) as request_url, timestamp '{NOW}' as started_at, timestamp '{NOW}' as finished_at,
      case when waiting then 'WAITING' else coalesce(o, 'ERROR') end as outcome, case when not waiting then h end as http_status, case when not waiting then ri end as response_item_id,
      case when not waiting then rc end as response_collection, case when not waiting then rh end as response_hash,
      case when waiting then 'Publication is still within the STAC ingestion grace period' when o is null then 'STAC request failed' else em end as error_message from looked),
  classed as (select *, case when outcome = 'ERROR' then 'API_ERROR' when outcome = 'WAITING' then 'WAITING' when outcome = 'MISMATCH' then 'DRIFT'
      when (publication_status = 'SUCCESS' and outcome = 'PRESENT') or (publication_status in ('FAILED', 'PENDING') and outcome = 'ABSENT') then 'CONSISTENT' else 'DRIFT' end as classification from checks)"""

Q["stac_outcome"] = _checks
SQL["stac_outcome"] = f"with {CHECKS} select * from checks"

Q["drift_class"] = lambda c: reconcile.classified(_checks(c)).select("dataset_id", "outcome", "classification")
SQL["drift_class"] = f"with {CHECKS} select dataset_id, outcome, classification from classed"

_DRIFT = "classification, outcome, publication_status, dataset_id, campaign, collection_id, item_id, {h} as http_status, request_url, strftime(finished_at, '%Y-%m-%dT%H:%M:%S') as checked_at, error_message"
Q["actionable_drift"] = lambda c: reconcile.actionable(_checks(c))
SQL["actionable_drift"] = f"with {CHECKS} select {_DRIFT.format(h='http_status')} from classed where classification not in ('CONSISTENT', 'WAITING')"


def _export(c):
    fields = schemas.DRIFT_FIELDS
    return outputs.read_back(c.spark, outputs.write_csv(reconcile.actionable(_checks(c)), fresh_folder(c.spark, "export"), fields), fields)


Q["export_reconciliation"] = _export
SQL["export_reconciliation"] = f"with {CHECKS} select {_DRIFT.format(h='cast(http_status as varchar)')} from classed where classification not in ('CONSISTENT', 'WAITING')"

Q["discrepancies"] = lambda c: reconcile.discrepancies(_checks(c))
SQL["discrepancies"] = f"with {CHECKS} select outcome, dataset_id, error_message from checks where outcome <> 'PRESENT' order by dataset_id limit 20"

Q["outcome_counts"] = lambda c: reconcile.outcome_counts(_checks(c))
SQL["outcome_counts"] = f"with {CHECKS} select outcome, count(*) as n from checks group by outcome"
Q["state_comparisons"] = lambda c: reconcile.state_comparisons(_checks(c))
SQL["state_comparisons"] = f"with {CHECKS} select publication_status || '/' || outcome as comparison, count(*) as n from checks group by all"
Q["classification_counts"] = lambda c: reconcile.classification_counts(_checks(c))
SQL["classification_counts"] = f"with {CHECKS} select classification, count(*) as n from classed group by classification"

Q["apply_reconciliation"] = lambda c: reconcile.apply_checks(catalog_columns(c.datasets), _checks(c))
SQL["apply_reconciliation"] = f"with {CHECKS} select " + set_columns({
    "stac_status": "coalesce(c.outcome, d.stac_status)",
    "stac_checked_at": "case when c.outcome is null then d.stac_checked_at else c.finished_at end",
    "stac_http_status": "case when c.outcome is null then d.stac_http_status else c.http_status end"}) + " from datasets d left join checks c on c.dataset_id = d.dataset_id"

Q["check_history"] = lambda c: reconcile.check_rows(_checks(c), "stac-1", F.sha2("dataset_id", 256))
SQL["check_history"] = f"""with {CHECKS} select sha256(dataset_id) as check_id, 'stac-1' as run_id, dataset_id, campaign, collection_id, item_id, request_url, started_at, finished_at, outcome,
  publication_status, http_status, response_item_id, response_collection, response_hash, error_message from checks"""
