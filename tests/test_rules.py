"""Schema rules that can be trusted, and literals read without Python's parser."""

import json

import pytest
from pyspark.sql import functions as F

from mapledger.functions import logs
from mapledger.functions.schema_rules import contract_names, flatten_schemas, pointed_at, rule_rows
from mapledger.operators import items

URL = "https://schemas.test/x.json"


def _item(properties, name="P.A.x.v1"):
    return json.dumps({
        "type": "Feature", "stac_version": "1.0.0", "id": name, "collection": "P", "geometry": None, "bbox": [-180, -90, 180, 90],
        "properties": {"datetime": "2024-01-01T00:00:00Z", **properties}, "links": [], "assets": {}, "stac_extensions": [URL]})


def _verdicts(spark, schema, *docs):
    table = spark.createDataFrame([(f"i{k}", d, f"i{k}.json") for k, d in enumerate(docs)], "item_id string, doc string, file_name string")
    rules = flatten_schemas(spark.createDataFrame([(URL, json.dumps(schema))], "url string, doc string"))
    return {r.item_id: r for r in items.item_verdicts(table, rules).collect()}


def _of(rule):
    return {"properties": {"properties": {"properties": {"a": rule}}}}


@pytest.mark.parametrize(("rule", "good", "bad"), [
    ({"enum": [1, 2]}, [1, 2.0], ["1", 3, True]), ({"const": True}, [True], ["true", 1]), ({"enum": ["x", None]}, ["x", None], ["null", 0]),
    ({"const": {"b": 1, "a": [2]}}, [{"a": [2], "b": 1}], [{"a": [2]}, "x"]), ({"exclusiveMinimum": 1}, [1.5, "s"], [1]),
    ({"exclusiveMaximum": 3}, [2], [3, 4]), ({"minLength": 2}, ["äö"], ["ä"]), ({"maxLength": 2}, ["äö", 12345], ["äöü"]),
    ({"maxItems": 1}, [[1], "xx"], [[1, 2]]), ({"type": "string", "format": "date-time", "deprecated": True}, ["x"], [1]),
])
def test_rules_judge_kind_and_value(spark, rule, good, bad):
    out = _verdicts(spark, _of(rule), *[_item({"a": v}) for v in (*good, *bad)])
    assert [out[f"i{k}"].valid for k in range(len(good) + len(bad))] == [True] * len(good) + [False] * len(bad)


def test_unsupported_rules_leave_items_unknown(spark):
    schema = _of({"type": "string", "contains": {"const": "x"}})
    out = _verdicts(spark, schema, _item({"a": "x"}), _item({"a": 1}))
    assert out["i0"].valid is None and out["i0"].n_issues == 0 and "contains" in out["i0"].error
    assert out["i1"].valid is False and out["i1"].n_issues == 1


_TREES = [
    ({"anyOf": [{"type": "string", "minLength": 2}, {"minimum": 5, "type": "number"}]}, ["ab", 5, 7.5], ["a", 4, None, []]),
    ({"oneOf": [{"multipleOf": 2}, {"multipleOf": 3}]}, [2, 3, 4], [1, 6, "x"]),
    ({"not": {"enum": ["hidden", 3]}}, ["shown", 4], ["hidden", 3, 3.0]),
    ({"not": {"anyOf": [{"type": "string"}, {"type": "object", "required": ["q"]}]}}, [1, {}], ["x", {"q": 1}]),
    ({"if": {"type": "string"}, "then": {"pattern": "^v"}, "else": {"minimum": 1}}, ["v1", 1, []], ["x", 0]),
    ({"if": {"required": ["k"]}, "then": {"required": ["l"], "properties": {"l": {"type": "integer"}}}}, [{}, {"k": 1, "l": 2}, 5], [{"k": 1}, {"k": 0, "l": "x"}]),
    ({"additionalProperties": False, "properties": {"a": {}}, "patternProperties": {"^x-": {"type": "string"}}},
     [{}, {"a": 1}, {"x-1": "s"}, 3], [{"b": 1}, {"x-1": 5}, {"a": 1, "y": 2}]),
    ({"properties": {"a": {}}, "additionalProperties": {"type": "number"}}, [{"a": "s", "b": 1}, "s"], [{"b": "s"}, {"a": 1, "c": None}]),
    ({"uniqueItems": True}, [[], [1, "1", True], "aa", [{"a": 1}, {"a": 2}]], [[1, 1], [1, 1.0], [{"a": 1, "b": 2}, {"b": 2, "a": 1}]]),
    ({"items": {"type": "string", "minLength": 2}}, [[], ["ab", "cd"], "x"], [["ab", "c"], [1], [None, "ab"]]),
    ({"items": {"anyOf": [{"type": "integer"}, {"const": "all"}]}}, [[1, "all"]], [[1, "none"], ["x"]]),
    ({"items": {"properties": {"n": {"items": {"maximum": 3}}}}}, [[{"n": [1, 2]}, {}, 4]], [[{"n": [1]}, {"n": [9, 1]}]]),
    ({"prefixItems": [{"type": "string"}, {"type": "integer"}]}, [["a", 1], ["a"], []], [[1], ["a", "b"]]),
    ({"minProperties": 1, "maxProperties": 2}, [{"a": 1}, "x"], [{}, {"a": 1, "b": 2, "c": 3}]),
    ({"anyOf": [{"items": {"type": "string"}, "type": "array"}, {"type": "null"}]}, [["a"], [], None], [[1], "x", ["a", 2]]),
    ({"properties": {"p": False}}, [{}, {"q": 1}], [{"p": 1}]),
]


def test_trees_judge_like_their_words(spark):
    urls = [f"https://schemas.test/{k}.json" for k in range(len(_TREES))]
    docs, expected = [], {}
    for k, (_, good, bad) in enumerate(_TREES):
        for n, (value, valid) in enumerate([(v, True) for v in good] + [(v, False) for v in bad]):
            docs.append((f"{k}/{n}/{value!r}", _item({"a": value}).replace(URL, urls[k]), "f"))
            expected[docs[-1][0]] = valid
    table = spark.createDataFrame(docs, "item_id string, doc string, file_name string")
    rules = flatten_schemas(spark.createDataFrame(
        [(u, json.dumps(_of(rule))) for u, (rule, _, _) in zip(urls, _TREES)], "url string, doc string"))
    assert {r.item_id: r.valid for r in items.item_verdicts(table, rules).collect()} == expected


def _issues(spark, schema, *docs):
    table = spark.createDataFrame([(f"i{k}", d, f"i{k}.json") for k, d in enumerate(docs)], "item_id string, doc string, file_name string")
    rules = flatten_schemas(spark.createDataFrame([(URL, json.dumps(schema))], "url string, doc string"))
    rows = items.schema_issues(table, rules).orderBy("item_id", F.desc("depth"), "path", "rule_no").collect()
    return [(r.item_id, r.path, r.validator, r.message, r.rejected_value) for r in rows]


def test_a_choice_is_explained_by_the_first_branch(spark):
    rule = {"anyOf": [{"type": "object", "required": ["k"], "properties": {"k": {"enum": ["north", "south"]}}}, {"type": "null"}]}
    found = _issues(spark, _of(rule), _item({"a": 1}), _item({"a": {}}), _item({"a": {"k": "nort"}}))
    assert [f[1:4] for f in found] == [
        ("$.properties.a", "type", "1 is not of type 'object'"), ("$.properties.a", "required", "'k' is a required property"),
        ("$.properties.a.k", "enum", "'nort' is not one of ['north', 'south']")]
    assert _verdicts(spark, _of(rule), _item({"a": {"k": "nort"}}))["i0"].suggested_value == "north"


def test_wording_of_trees(spark):
    schema = _of({"oneOf": [{"type": "integer"}, {"minimum": 2}, {"type": "string"}], "not": {"const": 3}})
    assert _issues(spark, schema, _item({"a": 3})) == [
        ("i0", "$.properties.a", "oneOf", "3 is valid under each of {'minimum': 2}, {'type': 'integer'}", "3"),
        ("i0", "$.properties.a", "not", "3 should not be valid under {'const': 3}", "3")]
    schema = _of({"additionalProperties": False, "properties": {"x": {}}})
    assert _issues(spark, schema, _item({"a": {"z": 1, "b": 2}}), _item({"a": {"b": 2}})) == [
        ("i0", "$.properties.a", "additionalProperties", "Additional properties are not allowed ('b', 'z' were unexpected)", '{"b": 2, "z": 1}'),
        ("i1", "$.properties.a", "additionalProperties", "Additional properties are not allowed ('b' was unexpected)", '{"b": 2}')]
    schema = _of({"items": {"type": "string"}, "uniqueItems": True})
    assert _issues(spark, schema, _item({"a": [1, "x", 1]})) == [
        ("i0", "$.properties.a[0]", "type", "1 is not of type 'string'", "1"),
        ("i0", "$.properties.a[2]", "type", "1 is not of type 'string'", "1"),
        ("i0", "$.properties.a", "uniqueItems", "[1, 'x', 1] has non-unique elements", '[1, "x", 1]')]
    schema = _of({"additionalProperties": False, "patternProperties": {"^x": {}, "^y": {}}})
    assert _issues(spark, schema, _item({"a": {"q": 1}}))[0][3] == "'q' does not match any of the regexes: '^x', '^y'"


def test_conditions_guard_rules_of_their_branch(spark):
    schema = {"properties": {"properties": {"if": {"properties": {"kind": {"const": "grid"}}, "required": ["kind"]},
                                            "then": {"required": ["size"], "properties": {"size": {"minimum": 1}}},
                                            "else": {"not": {"required": ["size"]}}}}}
    found = _issues(spark, schema, _item({"kind": "grid"}), _item({"kind": "grid", "size": 0}), _item({"size": 2}), _item({"kind": "x"}))
    assert [f[:3] for f in found] == [("i0", "$.properties", "required"), ("i1", "$.properties.size", "minimum"), ("i2", "$.properties", "not")]


def test_references_without_end_are_not_judged(spark):
    schema = {"properties": {"properties": {"$ref": "#/definitions/node"}}, "definitions": {"node": {
        "type": "object", "properties": {"a": {"$ref": "#/definitions/node"}}}}}
    out = _verdicts(spark, schema, _item({"a": {}}), _item({"a": 1}))
    # What stands below the reference is not read, so neither item is known to hold or to fail.
    assert out["i0"].valid is None and out["i1"].valid is None and "$ref" in out["i0"].error


def test_old_drafts_ignore_what_stands_beside_a_reference(spark):
    part = {"$ref": "#/definitions/any", "type": "string"}
    schema = _of(part) | {"definitions": {"any": {}}}
    assert _verdicts(spark, {**schema, "$schema": "http://json-schema.org/draft-07/schema#"}, _item({"a": 1}))["i0"].valid is True
    assert _verdicts(spark, schema, _item({"a": 1}))["i0"].valid is False


def test_verdicts_exchange_no_document(spark):
    table = spark.createDataFrame([("i", _item({"a": 1}), "f")], "item_id string, doc string, file_name string")
    rules = flatten_schemas(spark.createDataFrame([(URL, json.dumps(_of({"type": "string"})))], "url string, doc string"))
    plan = items.item_verdicts(table, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_registry_beyond_its_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(items, "REGISTRY_BYTES", 50)
    with pytest.raises(ValueError, match="more than 50"):
        _verdicts(spark, _of({"type": "string"}), _item({"a": 1}))


def test_two_files_of_one_id_have_a_verdict_each(spark):
    docs = spark.createDataFrame([("same", _item({"a": 1}), "f1"), ("same", _item({"a": "x"}), "f2")], "item_id string, doc string, file_name string")
    rules = flatten_schemas(spark.createDataFrame([(URL, json.dumps(_of({"type": "string"})))], "url string, doc string"))
    assert sorted(str(r.valid) for r in items.item_verdicts(docs, rules).collect()) == ["False", "True"]


def test_dotted_names_are_shown_plainly(spark):
    out = _verdicts(spark, {"properties": {"properties": {"properties": {"a.b": {"type": "string"}}}}}, _item({"a.b": 1}))
    assert out["i0"].path == "$.properties.a.b" and out["i0"].rejected_value == "1"


def test_one_walk_gives_names_and_rules():
    schema = {"$ref": "#/parts/0", "parts": [{"required": ["id"], "properties": {"links": {"type": "array"}}}],
              "anyOf": [{"required": ["bbox"], "properties": {"x%y": {}}}, {"$ref": "#"}]}
    assert contract_names(schema) == ["bbox", "id", "links", "x%y"]
    kinds = [r["kind"] for r in rule_rows(schema)]
    assert kinds.count("required") == 1 and "type" in kinds
    assert pointed_at({"a b": [{"c/d": {"k": 1}}]}, "#/a%20b/0/c~1d") == {"k": 1}
    assert pointed_at({}, "other.json#/a") is None and pointed_at({"a": []}, "#/a/3") is None and pointed_at({}, "#a") is None


def test_literals_without_a_parser(spark):
    rows = [("'air_temperatur'", "['air_temperature', 'wind']"), ('"it\'s"', '["it\'s", "no"]'), ("plain", "['plane']"),
            (r"'a\'b'", r"['a\'b']"), ("5", "['5']"), ("None", "['None']"), ("'x'", "[1, 'x']"), ("'x'", "[]"), (None, "['a']")]
    out = spark.createDataFrame(rows, "v string, c string").select(logs.enum_verdict(F.col("v"), F.col("c")).alias("e")).collect()
    found = [(r.e.rejected, r.e.suggested) for r in out]
    assert found == [("air_temperatur", "air_temperature"), ("it's", "it's"), ("plain", "plane"), ("a'b", "a'b"), ("5", None),
                     ("None", None), ("x", None), ("x", None), (None, None)]
    assert [r.e.rejected_repr for r in out][:4] == [repr("air_temperatur"), repr("it's"), repr("plain"), repr("a'b")]


def test_structure_of_time_links_and_assets(spark):
    def doc(**changes):
        return json.dumps({**json.loads(_item({})), **changes})

    docs = [doc(links=[{"href": "a", "rel": "self"}], assets={"d": {"href": "x"}}), doc(properties={}), doc(links=[{"rel": "self"}, "x", {"href": 1, "rel": "r"}]),
            doc(assets={"d": {}, "e": 5}), doc(properties={"datetime": None}), doc(links=[{}], assets=3)]
    table = spark.createDataFrame([(f"i{k}", d, f"i{k}.json") for k, d in enumerate(docs)], "item_id string, doc string, file_name string")
    found = {}
    for r in items.structure_issues(table).orderBy("item_id", "issue_no").collect():
        found.setdefault(r.item_id, []).append((r.path, r.validator, r.rejected_value))
    assert found == {
        "i1": [("$.properties.datetime", "missing", "{}")],
        "i2": [("$.links[0].href", "missing", '{"rel":"self"}'), ("$.links[1]", "model_type", "x"), ("$.links[2].href", "string_type", "1")],
        "i3": [("$.assets.d.href", "missing", "{}"), ("$.assets.e", "model_type", "5")],
        "i5": [("$.links[0].href", "missing", "{}"), ("$.links[0].rel", "missing", "{}"), ("$.assets", "dict_type", "3")]}
