"""Rows that must be neither lost nor invented: empty scans, refused batches, repeated ids, null groups."""

import datetime as dt

from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.operators import archive, batching, publication, registration, restore, validation
from mapledger.plans import workflows
from mapledger.sinks import outputs
from mapledger.sources import files
from tests.helpers import NOW, by, datasets

NAMES = ["project", "activity", "name"]


def _batch(spark, refused_all):
    members = spark.createDataFrame(
        [("r", "1", 0, "P.A.x#1", "/m/x.map", "ValueError: gone"),
         ("r", "1", 1, "P.A.y#1", "/m/y.map", "ValueError: gone" if refused_all else None),
         ("r", "1-retry-1", 0, "P.A.z#1", "/m/z.map", None)],
        "run_id string, batch_no string, pos int, dataset_id string, mapfile string, stage_error string")
    runs = spark.createDataFrame(
        [("r", "1-retry-1", 0, False, 10, None, "/l")] + ([] if refused_all else [("r", "1", 3, False, 5, None, "/l")]),
        "run_id string, batch_no string, exit_code int, timed_out boolean, output_length int, batch_error string, log_file string")
    log = spark.createDataFrame([("r", "1-retry-1", 1, "nothing to see")], "run_id string, batch_no string, line_no int, line string")
    return members, runs, log


def test_members_of_a_batch_that_was_refused_as_a_whole_fail(spark):
    out = by(publication.batch_outcomes(*_batch(spark, True)), "dataset_id")
    assert len(out) == 3
    for name in ("P.A.x#1", "P.A.y#1"):
        r = out[name]
        assert (r.attempt_status, r.exit_code, r.error_message, r.new_status, r.clears_claim) == ("FAILED", -1, "ValueError: gone", "FAILED", True)
    assert out["P.A.z#1"].attempt_status == "NO_STATUS"


def test_numbered_batches_meet_logs_with_text_numbers(spark):
    members, runs, log = _batch(spark, True)
    numbered = members.filter("batch_no = '1'").withColumn("batch_no", F.lit(1).cast("bigint"))
    assert publication.batch_outcomes(numbered, runs, log).count() == 2
    ranked = spark.createDataFrame([("2",), ("10-retry-1",), ("10",)], "b string").orderBy(publication.batch_rank(F.col("b")))
    assert [r.b for r in ranked.collect()] == ["2", "10", "10-retry-1"]


def _register(spark, state, lines, scanned, allow_empty, roots=()):
    table = spark.createDataFrame([(m, i, t) for i, (m, t) in enumerate(lines)], "mapfile string, line_no int, line string")
    sums = spark.createDataFrame([(m, "s") for m in dict(lines)], "mapfile string, mapfile_checksum string")
    owners = spark.createDataFrame(list(roots), "mapfile string, campaign string, project string, activity string, institution string")
    files = spark.createDataFrame([], schemas.FILES)
    named = spark.createDataFrame([(s,) for s in scanned], "campaign string")
    return workflows.register(state, files, table, sums, owners, NAMES, NOW, True, allow_empty, named)


def test_empty_scan_retires_only_when_allowed(spark):
    state = datasets(spark, {"dataset_id": "P.A.x#1", "campaign": "c"}, {"dataset_id": "P.A.y#1", "campaign": "other"})
    out = _register(spark, state, [], ["c"], True)
    assert by(out.datasets, "dataset_id")["P.A.x#1"].registration_status == "RETIRED"
    assert by(out.datasets, "dataset_id")["P.A.y#1"].registration_status == "ACTIVE"
    assert by(out.summary, "campaign")["c"].retired == 1
    kept = _register(spark, state, [], ["c"], False)
    assert by(kept.datasets, "dataset_id")["P.A.x#1"].registration_status == "ACTIVE"
    assert by(kept.summary, "campaign")["c"].retired == 0


def test_failure_of_an_unknown_campaign_blocks_retirement(spark):
    state = datasets(spark, {"dataset_id": "P.A.x#1", "campaign": "c"})
    out = _register(spark, state, [("/m/bad.map", "broken line")], ["c"], True)
    assert by(out.datasets, "dataset_id")["P.A.x#1"].registration_status == "ACTIVE"


def test_files_of_the_last_mapfile_and_repeated_paths(spark):
    roots = [(m, "c", "P", "A", "I") for m in ("/m/1.map", "/m/2.map", "/m/3.map")]
    def line(name, path):
        return f"P.A.{name}#1 | {path} | 5 | checksum=1 | mod_time=1.0"

    out = _register(spark, datasets(spark), [
        ("/m/1.map", line("x", "/f1")), ("/m/1.map", line("x", "/f2")), ("/m/2.map", line("x", "/f2")),
        ("/m/3.map", line("y", "/f3")), ("/m/3.map", line("y", "/f3"))], ["c"], False, roots)
    assert [(r.dataset_id, r.file_path) for r in out.files.collect()] == [("P.A.x#1", "/f2")]
    rejected = by(out.rejected, "mapfile")
    assert set(rejected) == {"/m/3.map"} and "more than once" in rejected["/m/3.map"].error


def test_null_group_keeps_its_records(spark):
    rows = spark.createDataFrame([(None, i, 10) for i in range(7)] + [("g", i, 10) for i in range(3)], "g string, k int, n int")
    out = batching.payload_batches(rows, ["g"], ["k"], "n", max_records=3)
    assert sorted((r.g or "", r.k, r.batch_no) for r in out.collect()) == sorted(
        [("", i, i // 3 + 1) for i in range(7)] + [("g", i, 1) for i in range(3)])


def test_repeated_sheet_ids_refuse_the_restore(spark):
    state = datasets(spark, {"dataset_id": "P.A.x#1"}, {"dataset_id": "P.A.y#1"})
    def sheet(*rows):
        return spark.createDataFrame(list(rows), "record_no int, dataset_id string, publication_status string")

    failures = spark.createDataFrame([("P.A.x#1", "r", "FAILED")], "dataset_id string, run_id string, status string")
    attempts = spark.createDataFrame([], schemas.ATTEMPTS)
    bad = workflows.restore_catalog(state, attempts, sheet((1, "P.A.x#1", "SUCCESS"), (2, "P.A.x#1", "FAILED"), (3, " ", None)), failures, NOW)
    assert {(r.reason, r.dataset_id) for r in bad.problems.collect()} == {("repeated", "P.A.x#1"), ("blank", None)}
    assert {r.publication_status for r in bad.datasets.collect()} == {"PENDING"} and bad.datasets.count() == 2
    assert bad.new_attempts.count() == 0
    good = workflows.restore_catalog(state, attempts, sheet((1, "P.A.x#1", "SUCCESS")), failures, NOW)
    assert by(good.datasets, "dataset_id")["P.A.x#1"].publication_status == "SUCCESS" and good.problems.count() == 0
    assert good.new_attempts.count() == 1
    twice = restore.restore_state(state, sheet((1, "P.A.x#1", "SUCCESS"), (2, "P.A.x#1", "FAILED")), NOW)
    assert twice.count() == 2


def test_planned_attempts_are_closed_by_id(spark):
    state = datasets(spark, {"dataset_id": "P.A.x#1", "mapfile": "/m/x.map"}, {"dataset_id": "P.A.y#1", "mapfile": "/m/y.map"})
    plan = workflows.plan_publication(state, spark.createDataFrame([], schemas.ATTEMPTS), "r", NOW)
    assert {r.status for r in plan.attempts.collect()} == {"RUNNING"} and plan.attempts.count() == 2
    members = plan.batches.select(
        F.lit("r").alias("run_id"), "batch_no", F.col("batch_pos").alias("pos"), "dataset_id", "mapfile", F.lit(None).cast("string").alias("stage_error"))
    runs = spark.createDataFrame([("r", 1, 0, False, 9, None, "/l")],
                                 "run_id string, batch_no bigint, exit_code int, timed_out boolean, output_length int, batch_error string, log_file string")
    log = spark.createDataFrame([], "run_id string, batch_no bigint, line_no int, line string")
    done = workflows.finish_publication(plan.datasets, members, runs, log, NOW, attempts=plan.attempts)
    closed = by(done.new_attempts, "dataset_id")
    ids = {r.dataset_id: r.attempt_id for r in plan.attempts.collect()}
    assert {d: r.attempt_id for d, r in closed.items()} == ids
    assert {r.status for r in closed.values()} <= {"NO_STATUS", "UNREACHED"} and all(r.finished_at for r in closed.values())
    stale = publication.abandon_attempts(plan.attempts, plan.datasets, NOW + dt.timedelta(hours=2), 3600)
    assert "RUNNING" not in {r.status for r in stale.collect()}


def test_scan_totals_name_empty_campaigns(spark):
    changes = spark.createDataFrame([("c", None), (None, "broken")], "campaign string, error string")
    totals = by(registration.scan_totals(changes, spark.createDataFrame([("c",), ("e",)], "campaign string")), "campaign")
    assert (totals["c"].failed, totals["e"].scanned, totals["e"].failed) == (1, 0, 1)


def test_line_breaks_inside_fields_survive(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'first\nsecond, "third"'), ("b", None), ("c", "plain")], "task_id string, error_message string")
    path = outputs.write_csv(rows, str(tmp_path / "out"), ["task_id", "error_message"])
    assert by(outputs.read_back(spark, path, ["task_id", "error_message"]), "task_id")["a"].error_message == 'first\nsecond, "third"'
    back = by(files.read_csv(spark, path, ["task_id"]), "task_id")
    assert set(back) == {"a", "b", "c"} and back["a"].error_message == 'first\nsecond, "third"'


def test_retried_append_replaces_its_own_rows(spark, tmp_path):
    rows = spark.createDataFrame([("r1", "x"), ("r2", "y")], "run_id string, dataset_id string")
    for part in ("one", "one", "two"):
        outputs.append_history(rows, str(tmp_path / "h"), part=part)
    assert spark.read.parquet(str(tmp_path / "h")).count() == 4


def test_malformed_lines_and_missing_files_without_a_distinct_inventory(spark):
    lines = spark.createDataFrame([("m", 1, "id | /a | 1"), ("m", 2, "bad"), ("m", 3, "bad"), ("m", 4, "id | /gone | 1")],
                                  "mapfile string, line_no bigint, line string")
    inventory = spark.createDataFrame([("/a",), ("/a",), (None,)], "path string")
    found = {r.line_no: r.problem for r in validation.line_problems(lines, inventory).collect()}
    assert set(found) == {2, 3, 4} and "missing file /gone" in found[4] and "malformed" in found[2]


def test_any_problem_refuses_all_archive_tasks(spark):
    good = spark.createDataFrame([("t1", None), ("t2", None)], "task_id string, problem string")
    assert archive.unless_refused(good).count() == 2
    assert archive.unless_refused(good.union(spark.createDataFrame([("t3", "no path")], good.schema))).count() == 0
