import pytest
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import logs
from mapledger.operators import batching, diagnostics, publication, selections
from mapledger.plans import workflows
from tests.helpers import NOW, by, datasets, one, ts

MEMBERS = "run_id string, batch_no bigint, pos bigint, dataset_id string, mapfile string, stage_error string"
RUNS = "run_id string, batch_no bigint, exit_code int, timed_out boolean, output_length bigint, batch_error string, log_file string"
LOG = "run_id string, batch_no bigint, line_no bigint, line string"


def outcomes(spark, members, log=(), run=(0, False, 0, None), record=True):
    m = spark.createDataFrame([("r", 1, i, d, p, e) for i, (d, p, e) in enumerate(members, 1)], MEMBERS)
    r = spark.createDataFrame([("r", 1, *run, "/log")], RUNS)
    lines = spark.createDataFrame([("r", 1, i, t) for i, t in enumerate(log, 1)], LOG)
    return by(publication.batch_outcomes(m, r, lines, record, 600), "dataset_id")


def short(row):
    return row.attempt_status, row.exit_code, row.new_status, row.clears_claim, row.counted


def test_reported_and_unreached(spark):
    out = outcomes(
        spark, [("a#1", "/1", None), ("b#1", "/2", None), ("c#1", "/3", None)],
        ["x ERROR first", "PUB_STATUS=PASS id=b.v1|n", "PUB_STATUS=FAIL id=a.v1|n", "PUB_STATUS=PASS id=zz.v1|n", "ERROR last  "], (3, False, 10, None))
    assert short(out["a#1"]) == ("FAILED", 3, "FAILED", True, True) and out["a#1"].error_message == "ERROR last"
    assert short(out["b#1"]) == ("SUCCESS", 3, "SUCCESS", True, True) and out["b#1"].error_message is None
    assert short(out["c#1"]) == ("UNREACHED", 3, None, False, False)
    assert out["c#1"].error_message == "Publisher emitted no status for this dataset"


def test_last_report_wins_also_inside_one_line(spark):
    out = outcomes(spark, [("a#1", "/1", None)], ["PUB_STATUS=FAIL id=a.v1|n PUB_STATUS=PASS id=a.v1|n"])
    assert short(out["a#1"]) == ("SUCCESS", 0, "SUCCESS", True, True)
    out = outcomes(spark, [("a#1", "/1", None)], ["PUB_STATUS=PASS id=a.v1", "PUB_STATUS=FAIL id=a.v1"])
    assert out["a#1"].attempt_status == "FAILED" and out["a#1"].error_message == "PUB_STATUS=FAIL id=a.v1"


def test_silent_batch_defers_the_first(spark):
    members = [("a", "/1", None), ("b", "/2", None)]
    out = outcomes(spark, members, [], (1, False, 0, None))
    assert short(out["a"]) == ("NO_STATUS", 1, None, True, False) and short(out["b"]) == ("UNREACHED", 1, None, False, False)
    assert out["a"].error_message == "esgpublish returned no recognizable PUB_STATUS line (exit code 1, output length 0)"
    out = outcomes(spark, members, ["ERROR boom"], (1, False, 11, None))
    assert out["a"].error_message == "ERROR boom"
    out = outcomes(spark, members, ["ERROR boom"], (124, True, 11, None))
    assert short(out["a"]) == ("TIMEOUT", 124, None, True, False) and out["a"].error_message == "esgpublish timed out after 600 seconds"


def test_silent_batch_with_retries_left_marks_all_unreached(spark):
    out = outcomes(spark, [("a", "/1", None), ("b", "/2", None)], [], (1, False, 0, None), record=False)
    assert {short(r) for r in out.values()} == {("UNREACHED", 1, None, False, False)}


def test_unknown_ids_alone_are_silence(spark):
    out = outcomes(spark, [("a#1", "/1", None)], ["PUB_STATUS=PASS id=other.v1"])
    assert out["a#1"].attempt_status == "NO_STATUS"


def test_refused_members(spark):
    members = [("a", "/x/same.map", "OSError: no"), ("b", "/y/same.map", None), ("c", "/z/same.map", None), ("d", "/z/d.map", None)]
    out = outcomes(spark, members, [], (0, False, 0, None))
    assert short(out["a"]) == ("FAILED", -1, "FAILED", True, True) and out["a"].error_message == "OSError: no"
    assert out["c"].error_message == "ValueError: Duplicate mapfile basename in batch: same.map"
    # With results already there, a silent publisher call defers nobody.
    assert short(out["b"]) == ("UNREACHED", 0, None, False, False) and out["d"].attempt_status == "UNREACHED"


def test_broken_call_fails_everyone(spark):
    out = outcomes(spark, [("a", "/1", None), ("b", "/2", "OSError: no")], ["PUB_STATUS=PASS id=a"], (0, False, 0, "FileNotFoundError: p"))
    assert short(out["a"]) == ("FAILED", -1, "FAILED", True, True) and out["a"].error_message == "FileNotFoundError: p"
    assert out["b"].error_message == "OSError: no"


def test_claims(spark):
    d = datasets(
        spark, {"dataset_id": "a"}, {"dataset_id": "b", "publication_claim_id": "old", "publication_claimed_at": ts("2024-01-31 20:00:00")},
        {"dataset_id": "c", "publication_claim_id": "live", "publication_claimed_at": ts("2024-01-31 23:30:00")},
        {"dataset_id": "d", "publication_status": "FAILED"}, {"dataset_id": "e", "registration_status": "RETIRED"})
    state = publication.claim(d, "new", NOW, "c", timeout_seconds=3600)
    assert {k: r.publication_claim_id for k, r in by(state, "dataset_id").items()} == {"a": "new", "b": "new", "c": "live", "d": None, "e": None}
    again = publication.claim(state, "second", NOW, "c", timeout_seconds=3600)
    assert again.filter("publication_claim_id = 'second'").count() == 0
    assert by(publication.claim(d, "new", NOW, limit=0), "dataset_id")["a"].publication_claim_id is None
    assert selections.pending(d, "c", 0).count() == 3 and selections.claimable(d, "c", 0).count() == 0
    attempts = spark.createDataFrame(
        [("1", "b", "old", ts("2024-01-31"), None, "RUNNING", None, None, None), ("2", "b", "other", ts("2024-01-31"), None, "RUNNING", None, None, None),
         ("3", "b", "old", ts("2024-01-31"), None, "FAILED", None, None, "x")], schemas.ATTEMPTS)
    closed = by(publication.abandon_attempts(attempts, d, NOW, 3600, "c"), "attempt_id")
    assert closed["1"].status == "ABANDONED" and closed["1"].error_message == "Publication claim lease expired" and closed["1"].finished_at == NOW
    assert closed["2"].status == "RUNNING" and closed["3"].status == "FAILED"


def test_retry_keeps_catalog_columns_and_result_resets_them(spark):
    d = datasets(spark, {"dataset_id": "a", "publication_status": "FAILED", "stac_status": "PRESENT", "publication_claim_id": "x"})
    assert one(publication.retry_failed(d, "c")).stac_status == "PRESENT"
    done = spark.createDataFrame([("a", "SUCCESS")], "dataset_id string, status string")
    row = one(publication.apply_results(d, done))
    assert (row.publication_status, row.stac_status, row.publication_claim_id) == ("SUCCESS", "UNCHECKED", None)


def test_releasing_claims_never_repeats_a_dataset(spark):
    d = datasets(spark, *[{"dataset_id": x, "publication_claim_id": "mine"} for x in "abc"], {"dataset_id": "d"})
    released = spark.createDataFrame(
        [("a", None), ("a", "mine"), ("a", "other"), ("b", "other"), ("c", "mine"), ("d", None)], "dataset_id string, claim_id string")
    state = publication.clear_claims(d, released)
    assert sorted((r.dataset_id, r.publication_claim_id) for r in state.collect()) == [("a", None), ("b", "mine"), ("c", None), ("d", None)]


def test_publication_workflow(spark):
    d = datasets(spark, *[{"dataset_id": f"d{i}#1", "mapfile": f"/m/{i}.map"} for i in range(5)])
    none = spark.createDataFrame([], schemas.ATTEMPTS)
    plan = workflows.plan_publication(d, none, "r", NOW, "c", limit=4, batch_size=3)
    assert sorted((r.dataset_id, r.batch_no) for r in plan.batches.collect()) == [("d0#1", 1), ("d1#1", 1), ("d2#1", 1), ("d3#1", 2)]
    members = plan.batches.select(
        F.lit("r").alias("run_id"), "batch_no", (F.col("batch_pos") + 1).alias("pos"), "dataset_id", "mapfile", F.lit(None).cast("string").alias("stage_error"))
    runs = spark.createDataFrame([("r", 1, 0, False, 9, None, "/l"), ("r", 2, 1, False, 0, None, "/l")], RUNS)
    log = spark.createDataFrame([("r", 1, 1, "PUB_STATUS=PASS id=d0.v1|n"), ("r", 1, 2, "PUB_STATUS=FAIL id=d1.v1|n")], LOG)
    out = workflows.finish_publication(plan.datasets, members, runs, log, NOW)
    state = by(out.datasets, "dataset_id")
    assert [state[f"d{i}#1"].publication_status for i in range(5)] == ["SUCCESS", "FAILED", "PENDING", "PENDING", "PENDING"]
    assert state["d2#1"].publication_claim_id == "r" and state["d3#1"].publication_claim_id is None
    s = one(out.summary)
    assert (s.total, s.success, s.failed, s.deferred) == (2, 1, 1, 1)
    assert out.new_attempts.count() == 4 and out.new_attempts.select("attempt_id").distinct().count() == 4


def test_batch_plan_rejects_zero(spark):
    with pytest.raises(ValueError):
        batching.batch_plan(datasets(spark, {"dataset_id": "a"}), 0)


DETAIL = (
    "Item `x` failed validation against `https://example.test/s.json`: 'aerosol_optical_thicknes' is not one of "
    "['air_temperature', 'aerosol_optical_thickness_particles', 'aerosol_optical_thickness']"
)


def parse(spark, text):
    df = logs.server_fields(spark.createDataFrame([(text,)], "t string"), text="t")
    return df.first()


def test_server_errors(spark):
    import json

    body = {"status_code": 400, "type": "https://t", "title": "T", "detail": DETAIL, "instance": "i"}
    r = parse(spark, "a ERROR Failed to publish: Error 500: {\"detail\": \"old\"}\nx Failed to publish: Error 422: " + json.dumps(body) + "\nPUB_STATUS=FAIL id=x")
    assert (r.http_status, r.error_type, r.schema_url, r.server_instance) == (400, "https://t", "https://example.test/s.json", "i")
    assert (r.rejected_value, r.suggested_value) == ("aerosol_optical_thicknes", "aerosol_optical_thickness")
    assert r.summary == (
        "STAC validation failed against https://example.test/s.json: 'aerosol_optical_thicknes' is not an allowed value."
        " Likely accepted value: 'aerosol_optical_thickness'.")
    r = parse(spark, "ERROR Failed to publish: Error 500")
    assert r.http_status is None and "without a structured" in r.summary
    r = parse(spark, "Failed to publish: Error 502: {broken}")
    assert (r.http_status, r.summary, r.error_type) == (502, "Publisher server returned HTTP 502.", None)
    r = parse(spark, 'Failed to publish: Error 409: {"detail": "", "title": "Conflict", "status_code": null}')
    assert (r.http_status, r.summary) == (None, "Conflict")
    r = parse(spark, "Failed to publish: Error 400: " + json.dumps({"detail": "x" * 1001}))
    assert len(r.summary) == 1000 and r.summary.endswith("...")
    r = parse(spark, "Failed to publish: Error 400: {}")
    assert r.summary == "Publisher server returned HTTP 400."
    quoted = {"detail": "against: failed validation against `u`: \"it's\" is not one of [\"its\"]"}
    r = parse(spark, "Failed to publish: Error 400: " + json.dumps(quoted))
    assert r.rejected_value == "it's" and "\"it's\" is not an allowed value." in r.summary


def test_diagnostic_outcomes(spark):
    d = datasets(spark, *[{"dataset_id": x} for x in "abcde"])
    statuses = spark.createDataFrame(
        [("a", "SUCCESS", 0, "/l"), ("b", "FAILED", 1, "/l"), ("c", "FAILED", 1, "/l"), ("d", "FAILED", 1, "/l")], "dataset_id string, status string, exit_code int, log_file string")
    errors = spark.createDataFrame(
        [(x, 400, "t", None, None, None, "server said", "i") for x in "bc"],
        "dataset_id string, http_status int, error_type string, schema_url string, rejected_value string, suggested_value string, summary string, server_instance string")
    verdicts = spark.createDataFrame(
        [("b", False, "s", "bad", "good", "Local STAC validation failed: p", "/f"), ("c", None, None, None, None, "n/a", None)],
        "dataset_id string, valid boolean, schema_url string, rejected_value string, suggested_value string, summary string, stac_file string")
    rows = by(diagnostics.diagnose(d, statuses, errors, verdicts, "run", NOW), "dataset_id")
    assert {k: r.outcome for k, r in rows.items()} == {
        "a": "RECOVERED", "b": "DIAGNOSED", "c": "DIAGNOSED", "d": "UNCLASSIFIED", "e": "EXECUTION_ERROR"}
    assert (rows["b"].error_type, rows["b"].suggested_value, rows["b"].summary) == ("local-stac-validation", "good", "Local STAC validation failed: p")
    assert (rows["c"].error_type, rows["c"].summary) == ("t", "server said") and rows["e"].exit_code == -1
