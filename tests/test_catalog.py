import json
import random

import pytest
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions.ranking import with_position
from mapledger.functions.schema_rules import contract_names, flatten_schemas, read_schema, rule_rows
from mapledger.operators import archive, batching, integrity, items, reconcile, registration, reports, restore, sync
from mapledger.sinks import outputs
from mapledger.sources import files
from tests.helpers import NOW, by, datasets, one, ts

# ---- items and schema rules ----


def greedy_reference(sizes: list[int], max_records: int, max_bytes: int) -> list[int]:
    """The plain sequential rule, for checking small inputs against the distributed form."""
    out, batch, used, count = [], 0, 0, 0
    for size in sizes:
        fits = count < max_records and used + batching.SEPARATOR_BYTES + size <= max_bytes
        if count and fits:
            used, count = used + batching.SEPARATOR_BYTES + size, count + 1
        else:
            batch, used, count = batch + 1, batching.ENVELOPE_BYTES + size, 1
        out.append(batch)
    return out


def item(name="i", **changes):
    base = {
        "type": "Feature", "stac_version": "1.1.0", "id": name, "geometry": {"type": "Point", "coordinates": [0, 0]},
        "links": [], "assets": {}, "bbox": [-180.0, -90.0, 180.0, 90.0], "properties": {"datetime": "2024-01-01T00:00:00Z"},
        "stac_extensions": ["s"]}
    return {k: v for k, v in {**base, **changes}.items() if v is not ...}


def verdicts(spark, documents, schemas_by_url):
    rows = [(str(i), f"{i}.json", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    docs = spark.createDataFrame([(u, json.dumps(s)) for u, s in schemas_by_url.items()], "url string, doc string")
    frame = spark.createDataFrame(rows, "item_id string, file_name string, doc string")
    out = by(items.item_verdicts(frame, flatten_schemas(docs)), "item_id")
    return [out[str(i)] for i in range(len(documents))]


def test_item_verdicts(spark):
    status = {"properties": {"properties": {"properties": {"x:status": {"enum": ["published", "retracted"]}, "x:n": {"minimum": 2, "maximum": 4}}}}}
    props = {"type": "object", "required": ["base_id", "x:list"], "properties": {
        "base_id": {"type": "string", "pattern": "^P"}, "x:list": {"type": "array", "items": {"type": "string"}, "minItems": 1}}}
    odd = {"properties": {"assets": {"propertyNames": {"maxLength": 3}}, "id": {"const": "i"}}}
    known = {"s": status, "p": props, "o": odd}

    def p(urls, **properties):
        return item(stac_extensions=urls, properties={"datetime": "x", **properties})

    out = verdicts(spark, [
        p(["s"], **{"x:status": "publshed"}), p(["s"], **{"x:status": "published", "x:n": 3}), p(["s"], **{"x:n": 5}),
        p(["p"], base_id="P.A", **{"x:list": ["T"]}), p(["p"], **{"x:list": ["T"]}), p(["p"], base_id="Q", **{"x:list": []}),
        p(["p"], base_id="P", **{"x:list": ["T", 1]}), p(["gone"]), p(["s", "gone"], **{"x:status": "nope"}), p(["gone", "s"], **{"x:status": "nope"}),
        "{bad", item(links=...), item(bbox=[-190.0, 0, 1, 1]), item(stac_extensions=[]), p(["o"]), item(bbox=...), "[1]",
    ], known)
    assert [v.valid for v in out] == [False, True, False, True, False, False, False, None, False, None, False, False, False, False, None, False, False]
    assert (out[0].path, out[0].rejected_value, out[0].suggested_value) == ("$.properties.x:status", "publshed", "published")
    assert out[0].summary == (
        "Local STAC validation failed: $.properties.x:status: 'publshed' is not one of ['published', 'retracted'] Likely accepted value: 'published'.")
    assert out[1].summary == "Local STAC validation passed."
    assert out[2].summary.endswith("$.properties.x:n: 5 is greater than the maximum of 4")
    assert out[4].path == "$.properties" and "'base_id' is a required property" in out[4].summary
    assert out[5].n_issues == 2 and "'Q' does not match '^P'" in out[5].summary
    assert out[6].path == "$.properties.x:list[1]" and "1 is not of type 'string'" in out[6].summary
    assert out[7].summary.startswith("Local STAC validation unavailable: gone: ")
    assert out[8].n_issues == 1 and out[8].error.startswith("gone: ") and out[9].error.startswith("gone: ")
    assert out[10].schema_url == "stac-item-json" and out[11].path == "$.links"
    assert "bbox is outside WGS84 bounds: [-190.0, 0, 1, 1]" in out[12].summary and out[13].path == "$.stac_extensions"
    assert "propertyNames" in out[14].summary  # never silently valid
    assert "KeyError: 'bbox'" in out[15].summary


def test_schema_flattening_follows_references():
    doc = {"$ref": "#/definitions/a~1b", "definitions": {"a/b": {"required": ["x"], "allOf": [{"properties": {"y": {"type": "string"}}}], "$ref": "#/definitions/a~1b"}},
           "anyOf": [{"required": ["z"]}]}
    assert contract_names(doc) == ["x", "y", "z"]
    assert {(r["kind"], r["shown"]) for r in rule_rows(doc)} == {("required", "$"), ("type", "$.y")}
    assert [t["tokens"][t["verdict"]]["kind"] for t in read_schema(doc)[2]] == ["anyOf"]
    assert contract_names({}) == [] and rule_rows({}) == []


def test_item_recognition(spark):
    good = {"type": "Feature", "stac_version": "1", "stac_extensions": [], "id": "a"}
    rows = [("a.json", json.dumps(good)), ("b.json", json.dumps(good)), ("a.json", json.dumps({**good, "stac_version": 1})),
            ("a.json", json.dumps({**good, "stac_extensions": {}})), ("a.json", "[1]"), ("a.json", "{bad"), ("a.json", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, file_name string, doc string")
    assert [r.is_item for r in items.is_generated_item(df).orderBy("n").collect()] == [True] + [False] * 6


def test_item_folder_scan(spark, tmp_path):
    (tmp_path / "CMIP6.x.json").write_text(json.dumps({"type": "Feature", "stac_version": "1", "stac_extensions": [], "id": "CMIP6.x"}))
    (tmp_path / "other.json").write_text("{}")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "CMIP6.y.json").write_text("{}")
    found = items.clean_preview(files.read_item_folder(spark, str(tmp_path)))
    assert [r.file_name for r in found.collect()] == ["CMIP6.x.json"]
    for bad in ("", "a/b", "..", "../x"):
        with pytest.raises(ValueError):
            files.check_pattern(bad)


# ---- comparison with the remote catalog ----


def test_response_judgement(spark):
    ok = json.dumps({"type": "Feature", "id": "i", "collection": "P"})
    cases = {
        "present": [(0, 200, ok)], "absent": [(0, 404, None)], "mismatch": [(0, 200, ok.replace('"i"', '"j"'))], "list": [(0, 200, "[1]")],
        "retry": [(0, 503, None), (1, 200, ok)], "gaveup": [(0, 500, None), (1, 429, None), (2, 502, None)], "late": [(0, 500, None), (3, 200, ok)],
        "forbidden": [(0, 403, "no"), (1, 200, ok)], "broken": [(0, 200, "{bad"), (1, 404, None)], "numeric": [(0, 200, ok.replace('"i"', "5"))]}
    rows = [(f"{k}", "5" if k == "numeric" else "i", n, s, b, None) for k, v in cases.items() for n, s, b in v]
    df = spark.createDataFrame(rows, "k string, item_id string, attempt_no int, http_status int, body string, error string")
    df = df.select(F.lit("P").alias("collection_id"), "*")
    out = {}
    for k in cases:
        out[k] = one(reconcile.judged_responses(df.filter(F.col("k") == k).drop("k")))
    assert {k: r.outcome for k, r in out.items()} == {
        "present": "PRESENT", "absent": "ABSENT", "mismatch": "MISMATCH", "list": "MISMATCH", "retry": "PRESENT", "gaveup": "ERROR", "late": "PRESENT",
        "forbidden": "ERROR", "broken": "ABSENT", "numeric": "MISMATCH"}
    # The bound belongs to requests: what is recorded counts unless a bound is given.
    late = df.filter(F.col("k") == "late").drop("k")
    assert one(reconcile.judged_responses(late, retries=2)).outcome == "ERROR"
    assert out["gaveup"].http_status is None and out["gaveup"].error_message == "HTTPError: 502 Server Error"
    assert out["forbidden"].http_status == 403 and out["forbidden"].error_message == "Unexpected HTTP status 403"
    assert out["mismatch"].response_item_id == "j" and out["gaveup"].response_hash is None


def test_grace_is_strict_and_decided_first(spark):
    scope = spark.createDataFrame([(x, "c", "P", s) for x, s in (("new", "SUCCESS"), ("edge", "SUCCESS"), ("failed", "FAILED"))],
                                  "dataset_id string, campaign string, project string, publication_status string")
    done = [("1", "new", ts("2024-01-31 23:50:01")), ("2", "edge", ts("2024-01-31 23:50:00")), ("3", "failed", ts("2024-01-31 23:59:00"))]
    attempts = spark.createDataFrame([(a, d, "r", t, t, "SUCCESS", 0, None, None) for a, d, t in done], schemas.ATTEMPTS)
    responses = spark.createDataFrame([("P", x, 0, 404, None, None) for x in ("new", "edge", "failed")], schemas.RESPONSES)
    out = by(reconcile.classified(reconcile.compare(scope, attempts, responses, "https://h", NOW)), "dataset_id")
    assert {k: (r.outcome, r.classification) for k, r in out.items()} == {
        "new": ("WAITING", "WAITING"), "edge": ("ABSENT", "DRIFT"), "failed": ("ABSENT", "CONSISTENT")}
    assert out["new"].http_status is None and out["edge"].request_url == "https://h/collections/P/items/edge"


# ---- archive ----


def test_import_applies_in_order_and_twice_equals_once(spark):
    d = datasets(spark, {"dataset_id": "a", "publication_status": "SUCCESS"}, {"dataset_id": "b", "publication_status": "SUCCESS", "registration_status": "RETIRED"})
    tasks = spark.createDataFrame(
        [(f"t-{x}", x, "c", "s", "/m", "/arc", NOW, None, "PENDING", None) for x in "ab"], schemas.ARCHIVE_TASKS)
    results = spark.createDataFrame([
        (1, "t-a", "a", "s", "/arc", "FAILED", "first"), (2, "t-a", "a", "s", "/arc", "SUCCESS", ""), (3, "t-a", "a", "x", "/arc", "CONFLICT", "tampered"),
        (4, "t-b", "b", "s", "/arc", "SUCCESS", "gone"), (5, "none", "a", "s", "/arc", "SUCCESS", ""), (6, "t-a", "a", "s", "/arc", "WOULD_ARCHIVE", "")],
        "row_no bigint, task_id string, dataset_id string, mapfile_checksum string, archive_path string, status string, error_message string")
    c = archive.classified_results(results, tasks, d)
    assert [r.label for r in c.orderBy("row_no").collect()] == ["FAILED", "SUCCESS", "INVALID_TASK", "UNKNOWN_DATASET", "INVALID_TASK", "UNKNOWN"]
    counts = {r.label: r.n for r in archive.import_counts(c).collect()}
    assert counts == {"SUCCESS": 1, "ALREADY_EXISTS": 0, "CONFLICT": 0, "FAILED": 1, "UNKNOWN_DATASET": 1, "INVALID_TASK": 2, "UNKNOWN": 1}
    t2, d2 = archive.import_into_tasks(tasks, c, NOW), archive.import_into_datasets(d, c, NOW)
    state = by(t2, "task_id")
    assert (state["t-a"].status, state["t-b"].status, state["t-b"].error_message) == ("SUCCESS", "SUCCESS", "gone")
    assert {k: r.archive_status for k, r in by(d2, "dataset_id").items()} == {"a": "SUCCESS", "b": "PENDING"}
    again = archive.classified_results(results, t2, d2)
    assert archive.import_into_tasks(t2, again, NOW).collect() == t2.collect()
    assert by(archive.import_into_datasets(d2, again, NOW), "dataset_id") == by(d2, "dataset_id")


def test_archive_paths_and_gate(spark):
    names = ["mip_era", "activity_id", "institution_id", "source_id", "experiment_id", "version"]
    rows = {"P.A.I.MODEL.historical.v1": None, "P.A.X.MODEL.historical.v1": "does not match", "P.A.I": "Unexpected DRS format"}
    d = datasets(spark, *[{"dataset_id": x, "publication_status": "SUCCESS", "mapfile": "/in/dataset.map"} for x in rows])
    campaigns = spark.createDataFrame([("c", "P", "A", "I", "/m", "/arc/", "experiment_id")], schemas.CAMPAIGNS)
    out = by(archive.with_paths(d.select("dataset_id", "campaign", "mapfile"), campaigns, names), "dataset_id")
    assert out["P.A.I.MODEL.historical.v1"].archive_path == "/arc/MODEL/historical/.mapfiles/dataset.map"
    for k, text in rows.items():
        assert text is None or text in out[k].path_error
    checks = d.select("dataset_id", "campaign", F.lit("ABSENT").alias("outcome"))
    assert archive.planned_tasks(d, campaigns, names, NOW, checks).count() == 0
    assert archive.planned_tasks(d, campaigns, names, NOW, checks.withColumn("outcome", F.lit("PRESENT"))).count() == 3


# ---- batches and positions ----


def test_positions_of_one_huge_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("g"), (F.col("id") * 7919 % 5000).alias("k"))
    got = with_position(df, ["g"], ["k"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append((r.k, r.position))
    for rows in groups.values():
        assert [p for _, p in sorted(rows)] == list(range(len(rows)))


@pytest.mark.parametrize("limit,room", [(7, 300), (50, 120), (3, 10_000), (1, 5)])
def test_greedy_batches_are_exact_over_chunks(spark, monkeypatch, limit, room):
    monkeypatch.setattr(batching, "CHUNK_ROWS", 16)
    monkeypatch.setattr(batching, "CHUNKS_PER_BLOCK", 4)
    rng = random.Random(limit)
    sizes = {"a": [rng.choice([5, 20, 60, 400]) for _ in range(333)], "b": [30] * 64, "c": [500]}
    rows = [(g, i, s) for g, v in sizes.items() for i, s in enumerate(v)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k bigint, n bigint")
    out = {}
    for r in batching.payload_batches(df, ["g"], ["k"], "n", limit, room).collect():
        out.setdefault(r.g, {})[r.k] = r.batch_no
    for g, v in sizes.items():
        assert [out[g][i] for i in range(len(v))] == greedy_reference(v, limit, room)


def test_batch_limits_must_be_positive(spark):
    df = spark.createDataFrame([("a", 1, 1)], "g string, k bigint, n bigint")
    for limits in ((0, 5), (5, 0)):
        with pytest.raises(ValueError):
            batching.payload_batches(df, ["g"], ["k"], "n", *limits)


# ---- sheet and restore ----


def test_sheet_documents(spark):
    text = '{"records": [{"id": 1, "fields": {"a": "x", "n": 1.0}}, {"id": 2, "fields": "text"}, {"id": 3}]}'
    rows = files.sheet_records(spark.createDataFrame([(text,)], "content string")).collect()
    assert [(r.record_no, r.record_id) for r in rows] == [(0, 1), (2, 3)] and json.loads(rows[0].fields)["a"] == "x"
    with pytest.raises(Exception, match="missing records list"):
        files.sheet_records(spark.createDataFrame([('{"x": 1}',)], "content string")).collect()


def test_upserts_take_the_last_record_and_match_null_keys(spark):
    rows = spark.createDataFrame([("a", None), ("a", "r"), ("b", "r")], "dataset_id string, run_id string")
    snap = spark.createDataFrame([(1, 10, "a", None), (2, 11, "a", None), (3, 12, "a", "r")], "record_no bigint, record_id bigint, dataset_id string, run_id string")
    got = {(r.dataset_id, r.run_id): (r.kind, r.record_id) for r in sync.upserts(rows, snap, ["dataset_id", "run_id"]).collect()}
    assert got == {("a", None): ("update", 11), ("a", "r"): ("update", 12), ("b", "r"): ("create", None)}


def test_restore(spark):
    d = datasets(spark, {"dataset_id": "a"}, {"dataset_id": "b", "retired_at": ts("2020-01-01")}, {"dataset_id": "c"})
    snap = spark.createDataFrame([(1, " a ", "SUCCESS"), (2, "b", "Retired"), (3, "ghost", "RETIRED"), (4, "lost", "FAILED")],
                                 "record_no bigint, dataset_id string, publication_status string")
    state = by(restore.restore_state(d, snap, NOW), "dataset_id")
    assert (state["a"].publication_status, state["a"].registration_status) == ("SUCCESS", "ACTIVE")
    assert (state["b"].registration_status, state["b"].retired_at, state["b"].publication_status) == ("RETIRED", ts("2020-01-01"), "PENDING")
    assert state["c"].publication_status == "PENDING"
    fails = spark.createDataFrame([("nowhere",)], "dataset_id string")
    cover = restore.coverage(snap, fails, d)
    assert [r.dataset_id for r in cover.filter("blocks").collect()] == ["lost"]
    assert {r.dataset_id for r in restore.blocking_missing(snap, d).collect()} == {"lost"}
    assert cover.count() == 6 and restore.missing_local(snap, fails, d).count() == 3


def test_new_attempts_compare_nulls(spark):
    kind = "dataset_id string, run_id string, status string, exit_code int"
    old = spark.createDataFrame([("a", None, "FAILED", 1)], kind)
    new = spark.createDataFrame([("a", None, "FAILED", 1), ("a", None, "FAILED", 2), ("a", None, "FAILED", 2), ("a", "r", "FAILED", 1)], kind)
    assert sorted((r.run_id or "", r.exit_code) for r in restore.new_attempts(new, old).collect()) == [("", 2), ("r", 1)]


# ---- reports, upgrade, writers ----


def test_latest_attempt_puts_nulls_last(spark):
    rows = [("1", "a", "r", ts("2024-01-01"), None, "RUNNING", None, None, None), ("2", "a", "r", ts("2023-01-01"), ts("2023-01-02"), "FAILED", 1, "/l", "x"),
            ("3", "b", "r", ts("2024-01-01"), ts("2024-01-01"), "SUCCESS", 0, "/l", None), ("4", "b", "r", ts("2024-01-01"), ts("2024-01-01"), "FAILED", 1, "/l", None)]
    got = by(reports.latest_attempt(spark.createDataFrame(rows, schemas.ATTEMPTS)), "dataset_id")
    assert (got["a"].attempt_id, got["b"].attempt_id) == ("2", "4")


def test_upgrade_of_an_old_catalog(spark):
    old = spark.createDataFrame([("a", "c", "SUCCESS")], "dataset_id string, campaign string, publication_status string")
    row = one(integrity.upgrade_datasets(old))
    assert (row.registration_status, row.archive_status, row.stac_status, row.mapfile_checksum) == ("ACTIVE", "PENDING", "UNCHECKED", None)
    attempts = spark.createDataFrame([("a",), ("b",)], "dataset_id string")
    ids = [r.attempt_id for r in integrity.upgrade_attempts(attempts).collect()]
    assert len(set(ids)) == 2 and all(ids)


def test_unknown_campaign_is_an_error(spark):
    from mapledger.operators import selections

    campaigns = spark.createDataFrame([("c", "P", "A", "I", "/m", None, None)], schemas.CAMPAIGNS)
    assert one(selections.campaign_lookup(campaigns, "c")).project == "P"
    with pytest.raises(Exception, match="Unknown campaign: x"):
        selections.campaign_lookup(campaigns, "x").collect()


def test_csv_keeps_quotes_commas_and_blanks(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "x"', None, ts("2024-01-01 00:00:00.5"))], "a string, b string, c string, t timestamp_ntz")
    path = outputs.write_csv(df, str(tmp_path / "o"), ["a", "b", "c", "t", "absent"])
    row = one(outputs.read_back(spark, path, ["a", "b", "c", "t", "absent"]))
    assert tuple(row) == ("a,b", 'say "x"', None, "2024-01-01 00:00:00.500000", None)


def test_missing_csv_columns_are_listed_sorted(spark, tmp_path):
    (tmp_path / "r.csv").write_text("task_id,status\n1,SUCCESS\n")
    with pytest.raises(ValueError, match="lacks the columns archive_path, dataset_id, mapfile_checksum"):
        files.read_archive_results(spark, str(tmp_path / "r.csv"))


def test_readers_follow_the_newest_commit(spark, tmp_path):
    root = str(tmp_path / "state")
    for version, status in ((1, "PENDING"), (2, "SUCCESS")):
        outputs.write_state(datasets(spark, {"dataset_id": "a", "publication_status": status}), root, version, NOW)
        assert one(outputs.read_state(spark, root, schemas.DATASETS)).publication_status == status


def test_log_batches_carry_over_splits(spark):
    rows = [("f", 0, 1, "head"), ("f", 0, 2, "Batch: 1"), ("f", 0, 3, "x"), ("f", 100, 4, "y"), ("f", 200, 5, "z"), ("f", 200, 6, "Batch: 2-retry-1"), ("f", 300, 7, "w")]
    df = spark.createDataFrame([("r", *x) for x in rows], "run_id string, file string, block bigint, seq bigint, line string")
    got = {r.line: r.batch_no for r in files.with_batches(df).collect()}
    assert got == {"head": None, "Batch: 1": "1", "x": "1", "y": "1", "z": "1", "Batch: 2-retry-1": "2-retry-1", "w": "2-retry-1"}


def test_reading_log_files(spark, tmp_path):
    (tmp_path / "run-1.log").write_text("Batch: 1\nPUB_STATUS=PASS id=a\nBatch: 2\nPUB_STATUS=FAIL id=b\n")
    got = {r.line: (r.run_id, r.batch_no) for r in files.read_logs(spark, str(tmp_path)).collect()}
    assert got["PUB_STATUS=PASS id=a"] == ("run-1", "1") and got["PUB_STATUS=FAIL id=b"] == ("run-1", "2")


def test_register_summary_counts_nothing_twice(spark):
    d = datasets(spark, {"dataset_id": "a"}, {"dataset_id": "old"})
    changes = spark.createDataFrame([("a", "c", None), (None, "c", "bad")], "dataset_id string, campaign string, error string")
    row = one(registration.registration_summary(d, changes))
    assert (row.succeeded, row.failed, row.current, row.retired) == (1, 1, 1, 0)
