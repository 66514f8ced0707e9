"""Catalog items: recognition, structure, schema rules, verdicts, retention."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger.functions import schema_rules, states
from mapledger.functions.ids import publisher_id
from mapledger.functions.once import with_once
from mapledger.functions.text import json_kind, member, text_member

# Members every item needs, with their JSON kind and the check names and texts of the item model.
CORE_MEMBERS = (
    ("type", "STRING", "string_type", "Input should be a valid string"),
    ("stac_version", "STRING", "string_type", "Input should be a valid string"),
    ("id", "STRING", "string_type", "Input should be a valid string"),
    ("geometry", "OBJECT", "dict_type", "Input should be a valid dictionary"),
    ("properties", "OBJECT", "dict_type", "Input should be a valid dictionary"),
    ("links", "ARRAY", "list_type", "Input should be a valid list"),
    ("assets", "OBJECT", "dict_type", "Input should be a valid dictionary"),
)


def is_generated_item(items: DataFrame) -> DataFrame:
    """Mark items (file_name, doc) a publisher wrote; anything unreadable or not an object is none."""
    doc = F.try_parse_json(F.col("doc"))
    named = F.col("file_name") == F.concat(text_member(doc, "$.id"), F.lit(".json"))
    ok = (
        (json_kind(doc) == "OBJECT")
        & (text_member(doc, "$.type") == "Feature")
        & (json_kind(member(doc, "$.stac_version")) == "STRING")
        & (json_kind(member(doc, "$.stac_extensions")) == "ARRAY")
        & (json_kind(member(doc, "$.id")) == "STRING")
        & named
    )
    return items.withColumn("is_item", F.coalesce(ok, F.lit(False)))


def clean_preview(items: DataFrame) -> DataFrame:
    """The recognised items by name."""
    return is_generated_item(items).filter("is_item").select("file_name")


def json_path(parts: Column) -> Column:
    """``$.name[0]`` text of path parts; array positions are given as ``[0]``."""
    return F.concat(
        F.lit("$"),
        F.array_join(
            F.transform(parts, lambda p: F.when(p.rlike(r"^\[\d+\]$"), p).otherwise(F.concat(F.lit("."), p))), ""
        ),
    )


def _issue(path: Column, message: Column, validator: Column, rejected: Column) -> Column:
    return F.struct(
        path.alias("path"), message.alias("message"), validator.alias("validator"), rejected.alias("rejected_value")
    )


def _member_kinds(doc: Column) -> Column:
    """JSON kind of every core member, null when absent."""
    return F.struct(*[json_kind(member(doc, f"$.{name}")).alias(name) for name, *_ in CORE_MEMBERS])


def _needed_text(owner: Column, path: Column, name: str) -> Column:
    """The issue of a text member that an object needs; null where it has one."""
    found = member(owner, f"$.{name}")
    place = F.concat(path, F.lit(f".{name}"))
    # Check names and texts of the item model.
    return F.when(found.isNull(), _issue(place, F.lit("Field required"), F.lit("missing"), F.to_json(owner))).when(
        json_kind(found) != "STRING",
        _issue(place, F.lit("Input should be a valid string"), F.lit("string_type"), F.coalesce(text_member(found, "$"), F.to_json(found))))


def _parts_issues(value: Column, path: Column, kind: str, names: tuple[str, ...]) -> Column:
    """Issues of one link or asset: an object with its text members."""
    odd = F.array(_issue(
        path, F.lit(f"Input should be a valid dictionary or instance of {kind}"), F.lit("model_type"), F.coalesce(text_member(value, "$"), F.to_json(value))))
    return F.when(json_kind(value) != "OBJECT", odd).otherwise(F.array(*[_needed_text(value, path, n) for n in names]))


def _member_issues(doc: Column) -> dict[str, Column]:
    """By core member, the issues of what it holds: the time of the item, its links, its assets."""
    properties = member(doc, "$.properties")
    time = F.when((json_kind(properties) == "OBJECT") & member(properties, "$.datetime").isNull(), F.array(_issue(
        F.lit("$.properties.datetime"), F.lit("Field required"), F.lit("missing"), F.to_json(properties))))
    links = F.flatten(F.transform(F.try_variant_get(doc, "$.links", "array<variant>"), lambda v, i: _parts_issues(
        v, F.concat(F.lit("$.links["), i.cast("string"), F.lit("]")), "Link", ("href", "rel"))))
    assets = F.flatten(F.transform(F.map_entries(F.try_variant_get(doc, "$.assets", "map<string,variant>")), lambda e: _parts_issues(
        e["value"], F.concat(F.lit("$.assets."), e["key"]), "Asset", ("href",))))
    empty = F.array().cast(model_type())
    return {n: F.filter(F.coalesce(x.cast(model_type()), empty), lambda i: i.isNotNull())
            for n, x in (("properties", time), ("links", links), ("assets", assets))}


def _structure_issues(doc: Column, raw: Column, kinds: Column, box: Column) -> Column:
    """Array of issues of one parsed item: model members first, map bounds only when those hold."""
    none = F.lit(None).cast("string")
    empty = F.array().cast(model_type())
    held = _member_issues(doc)
    model = []
    for name, kind, check, text in CORE_MEMBERS:
        found = kinds[name]
        wrong = (found != kind) & (found != "VOID") if name == "geometry" else found != kind
        issue = F.when(
            found.isNull(), _issue(F.lit(f"$.{name}"), F.lit("Field required"), F.lit("missing"), F.to_json(doc)),
        ).when(wrong, _issue(F.lit(f"$.{name}"), F.lit(text), F.lit(check), text_member(doc, f"$.{name}")))
        model.append(F.array_compact(F.array(issue)).cast(model_type()))
        model.extend([held[name]] if name in held else [])
    feature = F.when(
        (kinds["type"] == "STRING") & (text_member(doc, "$.type") != "Feature"),
        _issue(F.lit("$.type"), F.lit("Input should be 'Feature'"), F.lit("literal_error"), text_member(doc, "$.type")),
    )
    model.append(F.array_compact(F.array(feature)).cast(model_type()))
    # Nearly every document is fine: one test, and the issues are only listed where it fails.
    sound = F.coalesce(
        *[F.when(kinds[name].isNull() | (kinds[name] != kind), F.lit(False)) for name, kind, *_ in CORE_MEMBERS if name != "geometry"],
        F.when(kinds["geometry"].isNull() | ~kinds["geometry"].isin("OBJECT", "VOID"), F.lit(False)),
        *[F.when(F.size(x) > 0, F.lit(False)) for x in held.values()],
        text_member(doc, "$.type") == "Feature",
    )

    def outside(i: int, bound: float) -> Column:
        return F.coalesce((F.get(box, i) < -bound) | (F.get(box, i) > bound), F.lit(True))

    beyond = outside(0, 180.0) | outside(2, 180.0) | outside(1, 90.0) | outside(3, 90.0)
    # Message formats.
    shown = F.replace(F.get_json_object(raw, "$.bbox"), F.lit(","), F.lit(", "))
    bounds = F.when(
        beyond & member(doc, "$.bbox").isNull(), F.array(_issue(F.lit("$"), F.lit("KeyError: 'bbox'"), none, none))
    ).when(
        beyond,
        F.array(_issue(F.lit("$"), F.concat(F.lit("ValueError: bbox is outside WGS84 bounds: "), shown), none, none)),
    ).otherwise(empty)
    return F.when(~sound, F.concat(*model)).otherwise(bounds)


def model_type() -> str:
    return "array<struct<path:string,message:string,validator:string,rejected_value:string>>"


def parsed(items: DataFrame) -> DataFrame:
    """Items with the parsed document and the issues found before any schema is asked."""
    doc = F.col("_doc")
    none = F.lit(None).cast("string")
    extensions = F.try_variant_get(doc, "$.stac_extensions", "array<string>")
    # Message texts.
    no_json = F.array(_issue(F.lit("$"), F.lit("JSONDecodeError: document is not valid JSON"), none, none))
    no_schema = F.array(_issue(
        F.lit("$.stac_extensions"), F.lit("must contain at least one schema URL"), none, none
    ))
    out = with_once(items, _doc=F.try_parse_json(F.col("doc")))
    out = with_once(out, _kinds=_member_kinds(doc), _box=F.try_variant_get(doc, "$.bbox", "array<double>"))
    found = _structure_issues(doc, F.col("doc"), F.col("_kinds"), F.col("_box"))
    out = with_once(out, _structure=F.when(doc.isNotNull(), found)).drop("_kinds", "_box")
    issues = (
        F.when(doc.isNull(), no_json).when(F.size("_structure") > 0, F.col("_structure"))
        .when(F.coalesce(F.size(extensions), F.lit(0)) < 1, no_schema)
    )
    out = with_once(
        out, _issues=issues, _source=F.when(doc.isNull(), F.lit("stac-item-json")).otherwise(F.lit("stac-core"))
    )
    return out.withColumn("_urls", F.when(F.col("_issues").isNull(), extensions)).drop("_structure")


def structure_issues(items: DataFrame) -> DataFrame:
    """Issues of unreadable or ill-formed items, one row each."""
    p = parsed(items).filter(F.col("_issues").isNotNull())
    return p.select("item_id", F.col("_source").alias("schema_url"), F.posexplode("_issues").alias("issue_no", "i")).select(
        "item_id", "schema_url", "issue_no", "i.path", "i.message", "i.validator", "i.rejected_value"
    )


_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _fits(name: Column, kind: Column, whole: Column) -> Column:
    """Whether a value of a JSON kind has a schema type."""
    return (
        F.when(name == "object", kind == "OBJECT").when(name == "array", kind == "ARRAY")
        .when(name == "string", kind == "STRING").when(name == "boolean", kind == "BOOLEAN")
        .when(name == "null", kind == "VOID").when(name == "integer", whole)
        .when(name == "number", kind.isin(*_NUMBERS)).otherwise(F.lit(False))
    )


def _looked_up(doc: Column, root: Column, members: Column, properties: Column, rules: Column) -> Column:
    """Each rule with the value it judges and what its kind needs to know of it, read once.

    Members of the item and of its properties come from two maps made once per item;
    only deeper values are looked up by path.
    """
    below = F.substr(root, F.lit(2))

    at_root = root == "$"

    def look_up(r: Column) -> Column:
        steps = F.when(at_root, r["steps"]).otherwise(F.concat(F.array(F.lit("properties")), r["steps"]))
        return F.struct(r.alias("r"), steps.alias("steps"), F.size(r["steps"]).alias("below"))

    def read(x: Column) -> Column:
        x = {"r": x["r"], "steps": x["steps"], "n": F.when(at_root, x["below"]).otherwise(x["below"] + F.lit(1))}
        path = F.concat(F.lit("$"), F.array_join(F.transform(x["steps"], lambda s: F.concat(F.lit("['"), s, F.lit("']"))), ""))
        value = (
            F.when(x["n"] == 0, doc)
            .when(x["n"] == 1, F.try_element_at(members, F.get(x["steps"], 0)))
            .when((x["n"] == 2) & (F.get(x["steps"], 0) == "properties"), F.try_element_at(properties, F.get(x["steps"], 1)))
            .otherwise(F.try_variant_get(doc, path, "variant"))
        )
        place = F.concat(F.lit("$"), below, F.substr(x["r"]["place"], F.lit(2)))
        shown = F.concat(F.lit("$"), below, F.substr(x["r"]["shown"], F.lit(2)))
        # An absent value only matters where its owner is an object.
        owned = F.when((x["r"]["kind"] == "required") & value.isNull(), (
            F.when(x["n"] == 1, F.lit(True))
            .when((x["n"] == 2) & (F.get(x["steps"], 0) == "properties"), properties.isNotNull())
            .otherwise(json_kind(F.try_variant_get(doc, place, "variant")) == "OBJECT")
        ))
        return F.struct(x["r"].alias("r"), value.alias("value"), place.alias("place"), shown.alias("shown"), owned.alias("owned"))

    def detail(f: Column) -> Column:
        kind, value = f["r"]["kind"], f["value"]
        return F.struct(
            f["r"].alias("r"), value.alias("value"), f["place"].alias("place"), f["shown"].alias("shown"), f["owned"].alias("owned"),
            F.when(~kind.isin("required", "unsupported"), json_kind(value)).alias("kind"),
            F.when(kind.isin("enum", "const", "pattern", "minLength", "maxLength"), F.try_variant_get(value, "$", "string")).alias("text"),
            F.when(kind.isin("enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "type"),
                   F.try_variant_get(value, "$", "double")).alias("number"),
        )

    return F.transform(F.transform(F.transform(rules, look_up), read), detail)


def _is_broken(f: Column) -> Column:
    """Whether a rule fails. Rules about an absent value hold."""
    rule, kind, number = f["r"], f["kind"], f["number"]
    present = f["value"].isNotNull()
    numeric = kind.isin(*_NUMBERS)
    whole = (kind == "BIGINT") | (numeric & (number == F.floor(number)))
    elements = F.try_variant_get(f["value"], "$", "array<variant>")
    names = F.map_keys(F.try_variant_get(f["value"], "$", "map<string,variant>"))
    pattern = F.get(rule["accepted"], 0)
    verdict = (
        F.when(rule["kind"] == "required", ~present & f["owned"])
        .when(~present, F.lit(False))
        .when(rule["kind"] == "unsupported", F.lit(False))
        .when(rule["kind"] == "type", ~F.exists(rule["accepted"], lambda n: _fits(n, kind, whole)))
        .when(rule["kind"].isin("enum", "const"), ~(
            # A value is accepted by one of its own JSON kind; numbers compare as numbers.
            F.when(kind == "STRING", F.array_contains(rule["texts"], f["text"]))
            .when(numeric, F.array_contains(rule["numbers"], number))
            .otherwise(F.array_contains(rule["literals"], F.to_json(f["value"])))
        ))
        .when(rule["kind"] == "minimum", numeric & (number < rule["number"]))
        .when(rule["kind"] == "maximum", numeric & (number > rule["number"]))
        .when(rule["kind"] == "exclusiveMinimum", numeric & (number <= rule["number"]))
        .when(rule["kind"] == "exclusiveMaximum", numeric & (number >= rule["number"]))
        .when(rule["kind"] == "multipleOf", numeric & (F.try_divide(number, rule["number"]) != F.floor(F.try_divide(number, rule["number"]))))
        .when(rule["kind"] == "minLength", (kind == "STRING") & (F.char_length(f["text"]) < rule["number"]))
        .when(rule["kind"] == "maxLength", (kind == "STRING") & (F.char_length(f["text"]) > rule["number"]))
        .when(rule["kind"] == "maxItems", (kind == "ARRAY") & (F.size(elements) > rule["number"]))
        .when(rule["kind"] == "pattern", (kind == "STRING") & ~F.rlike(f["text"], pattern))
        .when(rule["kind"] == "minItems", (kind == "ARRAY") & (F.size(elements) < rule["number"]))
        .when(rule["kind"] == "holds", (kind == "OBJECT") & ~F.array_contains(names, pattern))
        .when(rule["kind"] == "uniqueItems", (kind == "ARRAY") & (
            F.size(F.array_distinct(F.transform(elements, lambda v: F.to_json(v)))) < F.size(elements)))
        .when(rule["kind"] == "closed", (kind == "OBJECT") & F.exists(names, lambda n: (
            ~F.array_contains(rule["texts"], n) & ~F.coalesce(F.rlike(n, pattern), F.lit(False)))))
        .when(rule["kind"] == "minProperties", (kind == "OBJECT") & (F.size(names) < rule["number"]))
        .when(rule["kind"] == "maxProperties", (kind == "OBJECT") & (F.size(names) > rule["number"]))
        .when(rule["kind"] == "never", F.lit(True))
    )
    return F.coalesce(verdict, F.lit(False))


# ---- rule trees ----

_PLACES = "array<struct<place:string,shown:string,value:variant>>"
_VIOLATIONS = (
    "array<struct<above:int,sorted:string,weak:int,rule_no:int,path:string,kind:string,arg:string,place:string,held:array<int>>>")


def _children(e: Column, s: Column) -> Column:
    """The places one step below a place."""
    members = F.try_variant_get(e["value"], "$", "map<string,variant>")
    elements = F.try_variant_get(e["value"], "$", "array<variant>")

    def named(name: Column, value: Column) -> Column:
        return F.struct(
            F.concat(e["place"], F.lit("['"), name, F.lit("']")).alias("place"), F.concat(e["shown"], F.lit("."), name).alias("shown"),
            value.alias("value"))

    def numbered(i: Column, value: Column) -> Column:
        text = F.concat(F.lit("["), i.cast("string"), F.lit("]"))
        return F.struct(F.concat(e["place"], text).alias("place"), F.concat(e["shown"], text).alias("shown"), value.alias("value"))

    def those(wanted) -> Column:
        return F.transform(F.filter(F.map_entries(members), lambda m: wanted(m["key"])), lambda m: named(m["key"], m["value"]))

    found = (
        F.when(s["how"] == "member", F.array(named(s["name"], F.try_element_at(members, s["name"]))))
        .when(s["how"] == "at", F.array(numbered(s["at"], F.get(elements, s["at"]))))
        .when(s["how"] == "each", F.transform(elements, lambda v, i: numbered(i, v)))
        .when(s["how"] == "like", those(lambda k: F.rlike(k, s["name"])))
        .when(s["how"] == "other", those(
            lambda k: ~F.array_contains(s["known"], k) & ~F.coalesce(F.rlike(k, s["name"]), F.lit(False))))
    )
    return F.coalesce(found.cast(_PLACES), F.array().cast(_PLACES))


def _below(start: Column, steps: Column) -> Column:
    """All places that steps lead to."""
    return F.aggregate(
        steps, F.array(start).cast(_PLACES), lambda places, s: F.flatten(F.transform(places, lambda e: _children(e, s))).cast(_PLACES))


def _broken_places(token: Column, start: Column) -> Column:
    """The places below a start at which a test fails."""
    known = F.transform(_below(start, token["steps"]), lambda e: F.struct(
        e.alias("e"), token.alias("r"), e["value"].alias("value"), F.lit(None).cast("boolean").alias("owned"), json_kind(e["value"]).alias("kind"),
        F.try_variant_get(e["value"], "$", "string").alias("text"), F.try_variant_get(e["value"], "$", "double").alias("number")))
    return F.transform(F.filter(known, _is_broken), lambda f: f["e"])


def _truths(tokens: Column, start: Column) -> Column:
    """Whether each token of a tree holds, in one pass over the postfix order."""
    def judge(known: Column, token: Column) -> Column:
        args, op = token["args"], token["op"]
        holds = (
            F.when(op == "test", F.size(_broken_places(token, start)) == 0)
            .when(op == "all", F.forall(args, lambda i: F.get(known, i)))
            .when(op == "any", F.exists(args, lambda i: F.get(known, i)))
            .when(op == "one", F.size(F.filter(args, lambda i: F.get(known, i))) == 1)
            .when(op == "not", ~F.get(known, F.get(args, 0)))
            .when(op == "implies", ~F.get(known, F.get(args, 0)) | F.get(known, F.get(args, 1)))
        )
        return F.concat(known, F.array(F.coalesce(holds, F.lit(True))))

    return F.aggregate(tokens, F.array().cast("array<boolean>"), judge)


def _tree_violations(tree: Column, start: Column) -> Column:
    """What a tree reports of a value: each failing place of a test, or what explains that a combination fails."""
    tokens = tree["tokens"]

    def cause(truths: Column, i: Column) -> Column:
        """The first failing token among a token's causes; the token itself where none explains it."""
        token = F.get(tokens, i)
        one_too_many = (token["op"] == "one") & F.exists(token["args"], lambda a: F.get(truths, a))
        first = F.get(F.filter(token["causes"], lambda c: ~F.get(truths, c)), 0)
        return F.when(one_too_many, i).otherwise(F.coalesce(first, i))

    def plain(truths: Column, i: Column) -> Column:
        """A condition is explained by the rule that it guards."""
        return F.when(F.get(tokens, i)["op"] == "implies", cause(truths, i)).otherwise(i)

    def report(x: Column) -> Column:
        truths, root, told = x["truths"], F.get(tokens, x["root"]), F.get(tokens, x["told"])
        chosen = root["op"].isin("any", "one")
        failing = F.when(told["op"] == "test", _broken_places(told, start)).otherwise(_below(start, told["steps"]))
        owner = F.size(tree["anchor"]) + F.size(root["steps"])
        held = F.when(told["kind"] == "oneOf", F.filter(
            F.sequence(F.lit(0), F.size(told["args"]) - F.lit(1)), lambda k: F.get(truths, F.get(told["args"], k))))
        own = F.get(_below(start, root["steps"]), 0)["shown"]
        return F.transform(F.when(chosen, F.slice(failing, 1, 1)).otherwise(failing), lambda e: F.struct(
            (-owner).cast("int").alias("above"), F.when(chosen, own).otherwise(e["shown"]).alias("sorted"), tree["weak"].alias("weak"),
            tree["rule_no"].alias("rule_no"), e["shown"].alias("path"), told["kind"].alias("kind"), told["arg"].alias("arg"),
            e["place"].alias("place"), held.alias("held")))

    judged = F.filter(
        F.array(F.struct(_truths(tokens, start).alias("truths"))),
        lambda x: F.forall(tree["guards"], lambda g: F.get(x["truths"], g)) & ~F.get(x["truths"], tree["verdict"]))
    rooted = F.transform(judged, lambda x: F.struct(
        x["truths"].alias("truths"), plain(x["truths"], tree["verdict"]).alias("root")))
    explained = F.transform(rooted, lambda x: F.struct(
        x["truths"].alias("truths"), x["root"].alias("root"),
        plain(x["truths"], cause(x["truths"], x["root"])).alias("told")))
    return F.flatten(F.transform(explained, report)).cast(_VIOLATIONS)


def _tree_issues(doc: Column, root: Column, trees: Column) -> Column:
    """Violations of all trees of a schema, at every value their anchors stand for."""
    value = F.when(root == "$", doc).otherwise(F.try_variant_get(doc, "$.properties", "variant"))
    start = F.struct(
        F.when(root == "$", F.lit("$")).otherwise(F.lit("$['properties']")).alias("place"), root.alias("shown"), value.alias("value"))
    return F.flatten(F.transform(trees, lambda tree: F.flatten(F.transform(
        _below(start, tree["anchor"]), lambda e: _tree_violations(tree, e)))))


def schema_root(contract: Column, item_keys: Column, properties_is_object: Column) -> Column:
    """JSON path of the value a schema governs: the item, or its ``properties``."""
    governs_item = F.arrays_overlap(contract, F.array(*[F.lit(x) for x in schema_rules.ITEM_FIELDS]))
    disjoint = (F.size(contract) > 0) & ~F.arrays_overlap(contract, item_keys)
    return F.when(governs_item, F.lit("$")).when(disjoint & properties_is_object, F.lit("$.properties")).otherwise(F.lit("$"))


def item_schemas(items: DataFrame, schemas: DataFrame) -> DataFrame:
    """Items with each declared schema in order; rules stay null where a schema is missing.

    ``schemas`` is the flattened registry: few rows, so the planner sends it to the items
    when it is small enough and otherwise joins on the address.
    """
    p = parsed(items)
    return p.select("item_id", F.posexplode("_urls").alias("schema_no", "url")).join(schemas, "url", "left")


#: Bytes of rules that go with the plan. The registry is configuration and does not grow with the items.
REGISTRY_BYTES = 32 << 20


def _registry(schemas: DataFrame) -> Column:
    """All schemas by address as a constant, so that items meet them without a join. The registry is read while
    the plan is built, after its size is checked."""
    own = schema_rules.SCHEMA_RULES.fieldNames()[1:]
    rows = schemas.dropDuplicates(["url"]).select("url", F.to_json(F.struct(*own)).alias("rules"))
    size = rows.agg(F.coalesce(F.sum(F.length("rules")), F.lit(0)).alias("n")).first()["n"]
    if size > REGISTRY_BYTES:
        raise ValueError(f"The schema registry holds {size} bytes, more than {REGISTRY_BYTES}")
    held = {r["url"]: json.loads(r["rules"]) for r in rows.collect()}
    kind = T.MapType(T.StringType(), T.StructType(schema_rules.SCHEMA_RULES.fields[1:]))
    return F.from_json(F.lit(json.dumps(held)), kind)


def _judged(items: DataFrame, schemas: DataFrame) -> DataFrame:
    """Items with `_asked`: each declared schema in order, whether it is missing, and the violations found.

    The document stays in its row; nothing is exchanged. Items with earlier issues ask no schema.
    """
    p = parsed(items)
    doc = F.col("_doc")
    p = with_once(
        p, _members=F.try_variant_get(doc, "$", "map<string,variant>"),
        _props=F.try_variant_get(doc, "$.properties", "map<string,variant>"),
    )
    registry = _registry(schemas)
    members, properties = F.col("_members"), F.col("_props")
    no_violation = F.array().cast(_VIOLATIONS)

    def rooted(x: Column) -> Column:
        root = schema_root(x["s"]["contract"], F.map_keys(members), properties.isNotNull())
        return F.struct(x["schema_no"].alias("schema_no"), x["url"].alias("url"), x["s"].alias("s"), root.alias("root"))

    def judged(x: Column) -> Column:
        found = F.filter(_looked_up(doc, x["root"], members, properties, x["s"]["rules"]), _is_broken)
        kept = F.transform(found, lambda f: F.struct(
            (-f["r"]["depth"]).alias("above"), f["shown"].alias("sorted"), F.lit(1).alias("weak"), f["r"]["rule_no"].alias("rule_no"),
            f["shown"].alias("path"), f["r"]["kind"].alias("kind"), f["r"]["arg"].alias("arg"), f["place"].alias("place"),
            F.lit(None).cast("array<int>").alias("held"),
        )).cast(_VIOLATIONS)
        trees = F.when(F.size(x["s"]["trees"]) > 0, _tree_issues(doc, x["root"], x["s"]["trees"])).otherwise(no_violation)
        return F.struct(
            x["schema_no"].alias("schema_no"), x["url"].alias("url"), x["s"].isNull().alias("gone"),
            F.get(x["s"]["unknown"], 0).alias("unknown"),
            F.when(x["s"].isNull(), no_violation).otherwise(F.array_sort(F.concat(kept, trees))).alias("broken"))

    declared = F.transform("_urls", lambda u, i: F.struct(
        i.alias("schema_no"), u.alias("url"), F.try_element_at(registry, u).alias("s")))
    return with_once(p, _asked=F.transform(F.transform(declared, rooted), judged)).drop("_members", "_props")


def schema_targets(items: DataFrame, schemas: DataFrame) -> DataFrame:
    """Which part of each item its declared schemas govern."""
    p = parsed(items).filter(F.col("_issues").isNull())
    e = p.select("item_id", "_doc", F.posexplode("_urls").alias("schema_no", "url")).join(schemas, "url", "left")
    members = F.try_variant_get("_doc", "$", "map<string,variant>")
    root = schema_root(F.col("contract"), F.map_keys(members), json_kind(member(F.col("_doc"), "$.properties")) == "OBJECT")
    return e.select("item_id", "schema_no", "url", F.when(F.col("contract").isNotNull(), root).alias("target"))


def _worded(path: Column, kind: Column, arg: Column, held: Column) -> Column:
    """Wording of a violation in the row that holds the document."""
    value = F.to_json(F.try_variant_get(F.col("_doc"), path, "variant"))
    # Numbers keep the spelling of the document.
    spelled = F.call_function("get_json_object", F.col("doc"), path)
    shown = F.when(value.rlike(r'^["{\[]'), value).otherwise(F.coalesce(spelled, value))
    return schema_rules.violation_text(kind, shown, arg, held)


def _word_of(kind: Column) -> Column:
    """The schema word behind a kind of rule."""
    named = kind
    for own, word in schema_rules.WORDS.items():
        named = F.when(kind == own, F.lit(word)).otherwise(named)
    return named


def _violations(items: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per broken rule, with its wording."""
    b = _judged(items, schemas).select("item_id", "doc", "_doc", F.explode("_asked").alias("a")).select(
        "item_id", "a.schema_no", "a.url", "doc", "_doc", F.explode("a.broken").alias("b"))
    worded = b.select(
        "item_id", "schema_no", F.col("url").alias("schema_url"), F.col("b.path").alias("path"),
        _word_of(F.col("b.kind")).alias("validator"), (-F.col("b.above")).alias("depth"), F.col("b.rule_no").alias("rule_no"),
        _worded(F.col("b.place"), F.col("b.kind"), F.col("b.arg"), F.col("b.held")).alias("w"),
    )
    return worded.select(
        "item_id", "schema_no", "schema_url", "path", "validator", "depth", "rule_no", "w.message",
        "w.rejected_value", "w.suggested_value", "w.suggested_repr",
    )


def concise(path: Column, message: Column, suggested_repr: Column) -> Column:
    """One-line text of an issue."""
    return F.concat(
        path, F.lit(": "), message,
        F.when(suggested_repr.isNotNull(), F.concat(F.lit(" Likely accepted value: "), suggested_repr, F.lit("."))).otherwise(""),
    )


def schema_issues(items: DataFrame, schemas: DataFrame) -> DataFrame:
    """All rule violations with their wording. Deepest first inside one schema: see ``depth``."""
    v = _violations(items, schemas)
    return v.withColumn("concise", concise(F.col("path"), F.col("message"), F.col("suggested_repr"))).drop("suggested_repr")


def item_verdicts(items: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per item file: valid, invalid or unknown (null), the first issue, the number of issues and a summary.

    An item without issues whose schemas hold rules that cannot be judged is unknown.

    Schemas are asked in declared order up to the first missing one; issues found before it
    count. The document never leaves its row, and only its first issue is worded.
    """
    early = F.col("_issues")
    g = _judged(items, schemas)
    g = g.withColumn("_gone", F.get(F.filter("_asked", lambda a: a["gone"]), 0))
    g = with_once(g, _before=F.filter("_asked", lambda a: F.col("_gone").isNull() | (a["schema_no"] < F.col("_gone.schema_no"))))
    n_late = F.aggregate("_before", F.lit(0), lambda t, a: t + F.size(a["broken"]))
    g = with_once(
        g, _n=F.when(F.size(early) > 0, F.size(early)).otherwise(F.coalesce(n_late, F.lit(0))),
        _first=F.get(F.filter("_before", lambda a: F.size(a["broken"]) > 0), 0))
    head = F.get(F.col("_first.broken"), 0)
    g = g.withColumn("_w", _worded(head["place"], head["kind"], head["arg"], head["held"]))
    late = F.coalesce(F.size(early) > 0, F.lit(False))
    unjudged = F.get(F.filter("_before", lambda a: a["unknown"].isNotNull()), 0)
    # Fixed value: message format of a missing schema. The other text is our own.
    error = F.when(
        F.col("_gone").isNotNull(), F.concat(F.col("_gone.url"), F.lit(": LookupError: schema document not available"))
    ).when(
        (F.col("_n") == 0) & unjudged.isNotNull(),
        F.concat(unjudged["url"], F.lit(": rule not supported: "), unjudged["unknown"]),
    )
    f = g.select(
        "item_id", F.col("_n").cast("bigint").alias("n_issues"), error.alias("error"),
        F.when(late, F.col("_source")).otherwise(F.col("_first.url")).alias("schema_url"),
        F.when(late, F.get(early, 0)["path"]).otherwise(head["path"]).alias("path"),
        F.when(late, F.get(early, 0)["message"]).otherwise(F.col("_w.message")).alias("message"),
        F.when(late, F.get(early, 0)["rejected_value"]).otherwise(F.col("_w.rejected_value")).alias("rejected_value"),
        F.col("_w.suggested_value").alias("suggested_value"), F.col("_w.suggested_repr").alias("suggested_repr"),
    )
    valid = F.when(F.col("n_issues") > 0, F.lit(False)).when(F.col("error").isNotNull(), F.lit(None)).otherwise(F.lit(True))
    # Summary formats.
    summary = (
        F.when(valid, F.lit("Local STAC validation passed."))
        .when(F.col("n_issues") > 0, F.concat(
            F.lit("Local STAC validation failed: "), concise(F.col("path"), F.col("message"), F.col("suggested_repr"))
        ))
        .otherwise(F.concat(F.lit("Local STAC validation unavailable: "), F.col("error")))
    )
    return f.select(
        "item_id", valid.alias("valid"), "n_issues", "schema_url", "path", "rejected_value", "suggested_value",
        "error", summary.alias("summary"),
    )


def retention(results: DataFrame, retained: DataFrame, staged: DataFrame) -> DataFrame:
    """What happens to kept item files after results (dataset_id, status).

    ``retained`` and ``staged`` list file names (name); a retained name that is no regular
    file (is_regular false) does not count.
    """
    name = F.concat(publisher_id(F.col("dataset_id")), F.lit(".json"))
    r = results.select("dataset_id", "status", name.alias("name"))
    kept = retained.filter(F.coalesce(F.col("is_regular"), F.lit(True))).select("name").distinct().withColumn("_kept", F.lit(True))
    new = staged.select("name").distinct().withColumn("_new", F.lit(True))
    j = r.join(kept, "name", "left").join(new, "name", "left")
    action = states.retention_action(F.col("status"), F.col("_kept").isNotNull(), F.col("_new").isNotNull())
    return j.select("dataset_id", "status", action.alias("action"), F.when(action == "retained", F.col("name")).alias("stored_as"))
