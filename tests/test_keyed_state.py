"""Merge on read, optimistic commits, streamed statuses in dataset state."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.operators import publication
from mapledger.plans import state_changes
from mapledger.session import fresh_folder
from mapledger.sinks.keyed_state import Contended, KeyedState, changed_rows
from tests.helpers import NOW, by, datasets


def fresh(spark, rows, buckets=16, name="state", **kind):
    state = KeyedState(spark, fresh_folder(spark, name), buckets=buckets, tables=state_changes.STREAMED, **kind)
    empty = {t: spark.createDataFrame([], state.tables[t].schema) for t in ("publication_attempts", "status_marks", "files")}
    state.create({"datasets": rows, **empty}, NOW)
    return state


def many(spark, n=400, **values):
    return datasets(spark, *[{"dataset_id": f"d{i:04}#1", "mapfile": f"/m/{i}.map", **values} for i in range(n)])


def rows_of(df):
    return sorted(map(tuple, df.select(*schemas.DATASETS.names).collect()))


def test_a_small_change_writes_its_rows_into_its_buckets_only(spark):
    state = fresh(spark, many(spark), spread=2)
    ids = spark.createDataFrame([(f"d{i:04}#1",) for i in (3, 77, 200, 399)], "dataset_id string")

    def change(read):
        return {"datasets": read("datasets", ids).withColumn("publication_status", F.lit("FAILED"))}

    before = state.read("datasets")
    assert state.update(change, NOW) == 2
    part = state.commits()[-1]["parts"][0]
    held = ids.select(F.pmod(F.xxhash64("dataset_id"), F.lit(16)).cast("int").alias("b")).distinct().collect()
    assert part["kind"] == "delta" and sorted(part["buckets"]) == sorted(r.b for r in held)
    assert spark.read.parquet(part["folder"]).count() == 4
    whole = before.join(ids.withColumn("hit", F.lit(True)), "dataset_id", "left").withColumn(
        "publication_status", F.when(F.col("hit"), "FAILED").otherwise(F.col("publication_status")))
    assert rows_of(state.read("datasets")) == rows_of(whole)
    assert rows_of(state.read("datasets", 1)) == rows_of(before)


def test_lookups_open_the_files_of_their_buckets_only(spark):
    state = fresh(spark, many(spark))
    ids = spark.createDataFrame([("d0003#1",), ("none",), (None,)], "dataset_id string")
    found = state.read_keys("datasets", ids)
    assert [r.dataset_id for r in found.collect()] == ["d0003#1"]
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", found._jdf.queryExecution().executedPlan().toString())
    assert filters and all("_bucket" in f for f in filters)


def test_newest_row_wins_and_compaction_rewrites_touched_buckets(spark):
    state = fresh(spark, many(spark, 60))

    def put(i, status, gone=None):
        rows = datasets(spark, {"dataset_id": f"d{i:04}#1", "publication_status": status})
        return lambda read: {"datasets": rows if gone is None else rows.withColumn("_deleted", F.lit(gone))}

    for step in (put(1, "FAILED"), put(1, "SUCCESS"), put(2, "FAILED", True), put(500, "PENDING"), put(3, "FAILED", True), put(3, "SUCCESS")):
        state.update(step, NOW)
    expected = rows_of(state.read("datasets"))
    found = by(state.read("datasets"), "dataset_id")
    assert len(found) == 60 and "d0002#1" not in found
    assert [found[f"d{i:04}#1"].publication_status for i in (1, 3, 500)] == ["SUCCESS", "SUCCESS", "PENDING"]
    touched = {b for c in state.commits()[1:] for p in c["parts"] for b in p["buckets"]}
    at = state.compact(NOW)
    assert set(state.commits()[-1]["parts"][0]["buckets"]) == touched
    assert rows_of(state.read("datasets")) == expected
    assert state.compact(NOW) == at, "nothing is left to compact"
    state.update(put(1, "FAILED"), NOW)
    assert by(state.read("datasets"), "dataset_id")["d0001#1"].publication_status == "FAILED"
    assert rows_of(state.read("datasets", at)) == expected


def test_a_job_is_applied_once_even_if_it_changes_nothing(spark):
    state = fresh(spark, many(spark, 5))
    calls = []

    def change(read):
        calls.append(1)
        return {"datasets": read("datasets").where("false")}

    assert [state.update(change, NOW, job="j") for _ in range(2)] == [2, 2] and len(calls) == 1
    assert state.commits()[-1]["parts"] == []


def test_interleaved_claims_are_disjoint(spark):
    state = fresh(spark, many(spark, 40))
    other = state_changes.claim("run-b", NOW, "c", limit=15)
    mine = state_changes.claim("run-a", NOW, "c", limit=15)
    tried = []

    def interrupted(read):
        planned = mine(read)
        if not tried:
            # The other run commits after this one has planned on the same version.
            state.update(other, NOW)
        tried.append([r.dataset_id for r in planned["datasets"].orderBy("dataset_id").collect()])
        return planned

    state.update(interrupted, NOW)
    assert len(tried) == 2 and tried[0][0] == "d0000#1" and tried[1][0] == "d0015#1"
    claimed = state.read("datasets").groupBy("publication_claim_id").agg(F.sort_array(F.collect_list("dataset_id")).alias("ids"))
    held = {r.publication_claim_id: r.ids for r in claimed.collect()}
    assert held["run-b"] == [f"d{i:04}#1" for i in range(15)] and held["run-a"] == [f"d{i:04}#1" for i in range(15, 30)]


def test_a_writer_that_always_loses_gives_up(spark):
    state = fresh(spark, many(spark, 5))
    nothing = lambda read: {"datasets": read("datasets").where("false")}

    def beaten(read):
        state.update(nothing, NOW)
        return nothing(read)

    with pytest.raises(Contended):
        state.update(beaten, NOW, tries=3)
    assert state.version() == 4
    with pytest.raises(ValueError, match="there already"):
        state.create({}, NOW)


def test_expired_claims_and_their_attempts_change_together(spark):
    old = NOW - dt.timedelta(hours=5)
    rows = datasets(
        spark, {"dataset_id": "a#1", "publication_claim_id": "run-0", "publication_claimed_at": old},
        {"dataset_id": "b#1", "publication_claim_id": "run-1", "publication_claimed_at": NOW}, {"dataset_id": "x#1", "publication_status": "SUCCESS"})
    state = fresh(spark, rows)
    attempts = spark.createDataFrame(
        [("t1", "a#1", "run-0", old, None, "RUNNING", None, None, None), ("t2", "b#1", "run-1", old, None, "RUNNING", None, None, None)], schemas.ATTEMPTS)
    state.update(lambda read: {"publication_attempts": attempts}, NOW)
    state.update(state_changes.claim("run-2", NOW, "c", timeout_seconds=3600), NOW)
    found = by(state.read("datasets"), "dataset_id")
    assert [found[i].publication_claim_id for i in ("a#1", "b#1", "x#1")] == ["run-2", "run-1", None]
    closed = by(state.read("publication_attempts"), "attempt_id")
    assert (closed["t1"].status, closed["t1"].finished_at, closed["t2"].status) == ("ABANDONED", NOW, "RUNNING")
    assert {p["table"] for p in state.commits()[-1]["parts"]} == {"datasets", "publication_attempts"}


def test_registration_writes_only_what_differs(spark):
    state = fresh(spark, many(spark, 30, mapfile_checksum="s"))
    kind = "dataset_id string, campaign string, project string, activity string, institution string, drs string, mapfile string, mapfile_checksum string"
    changes = spark.createDataFrame(
        [("d0001#1", "c", "P", "A", "I", None, "/m/1.map", "s"), ("d0002#1", "c", "P", "A", "I", None, "/m/2.map", "new"),
         ("fresh#1", "c", "P", "A", "I", None, "/m/f.map", "s")], kind)
    state.update(state_changes.register(changes, NOW), NOW)
    written = spark.read.parquet(state.commits()[-1]["parts"][0]["folder"])
    assert sorted(r.dataset_id for r in written.collect()) == ["d0002#1", "fresh#1"]
    assert state.read("datasets").count() == 31


def test_removed_datasets_take_their_files_along(spark):
    state = fresh(spark, many(spark, 4))
    files = spark.createDataFrame([("d0001#1", "/a", 1, None, None), ("d0002#1", "/b", 1, None, None)], schemas.FILES)
    state.update(lambda read: {"files": files}, NOW)
    state.update(state_changes.remove(spark.createDataFrame([("d0001#1",)], "dataset_id string")), NOW)
    assert state.read("datasets").count() == 3
    assert [r.file_path for r in state.read("files").collect()] == ["/b"]


def test_changed_rows_compares_nulls(spark):
    one = datasets(spark, {"dataset_id": "a#1"}, {"dataset_id": "b#1"}, {"dataset_id": "c#1", "drs": "x"})
    two = datasets(spark, {"dataset_id": "a#1"}, {"dataset_id": "b#1", "drs": "y"}, {"dataset_id": "c#1"}, {"dataset_id": "n#1"})
    assert sorted(r.dataset_id for r in changed_rows(one, two, ["dataset_id"]).collect()) == ["b#1", "c#1", "n#1"]


def test_streamed_statuses_reach_the_state_once_and_in_order(spark):
    state = fresh(spark, many(spark, 6, publication_claim_id="run-1", publication_claimed_at=NOW, stac_status="PRESENT"))
    members = spark.createDataFrame([("run-1", i, f"d{i:04}#1") for i in range(6)], "run_id string, pos bigint, dataset_id string")
    write = state_changes.status_updates(state, members, NOW, "tail")

    def lines(*rows):
        return spark.createDataFrame(
            [("run-1", n, f"PUB_STATUS={s} id=d{i:04}.v1|node") for n, i, s in rows], "run_id string, line_no bigint, line string")

    write(lines((10, 0, "FAIL"), (11, 1, "PASS")), 0)
    write(lines((5, 1, "FAIL"), (12, 0, "PASS"), (13, 9, "PASS")), 1)
    version = state.version()
    write(lines((99, 2, "FAIL")), 1)
    assert state.version() == version, "the replayed micro-batch is no new commit"
    write(lines((14, 3, "PASS"), (15, 3, "FAIL")), 2)
    found = by(state.read("datasets"), "dataset_id")
    assert [found[f"d{i:04}#1"].publication_status for i in range(6)] == ["SUCCESS", "SUCCESS", "PENDING", "FAILED", "PENDING", "PENDING"]
    assert [found[f"d{i:04}#1"].publication_claim_id for i in (0, 2)] == [None, "run-1"]
    assert found["d0000#1"].stac_status == "UNCHECKED" and found["d0002#1"].stac_status == "PRESENT"
    assert [c["job"] for c in state.commits()[1:]] == ["tail:0", "tail:1", "tail:2"]


def test_stream_equals_batch_after_a_restart(spark):
    rows = many(spark, 30)
    state = fresh(spark, rows)
    members = spark.createDataFrame([(f"run-{i % 3}", i, f"d{i:04}#1") for i in range(30)], "run_id string, pos bigint, dataset_id string")
    log = [(f"run-{i % 3}", 100 * k + i, f"PUB_STATUS={'PASS' if (i + k) % 3 else 'FAIL'} id=d{i:04}.v1|n") for k in range(4) for i in range(30) if (i * k) % 5 != 1]
    folder = fresh_folder(spark, "log")
    frame = spark.createDataFrame(log, "run_id string, line_no bigint, line string")

    def follow():
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        state_changes.follow_log(stream, state, members, NOW, "log", f"{folder}/check").awaitTermination()

    frame.where("line_no < 200").repartition(4).write.parquet(f"{folder}/in")
    follow()
    frame.where("line_no >= 200").repartition(4).write.mode("append").parquet(f"{folder}/in")
    follow()
    assert len([c for c in state.commits() if (c["job"] or "").startswith("log:")]) >= 3
    told = publication.last_statuses(publication.resolve_statuses(frame, members, ["run_id"]), ["run_id"])
    assert rows_of(state.read("datasets")) == rows_of(publication.apply_results(rows, told.select("dataset_id", "status")))


def test_outcomes_of_a_run_are_one_commit(spark):
    state = fresh(spark, many(spark, 4, publication_claim_id="r", publication_claimed_at=NOW))
    members = spark.createDataFrame([("r", 1, i + 1, f"d{i:04}#1", f"/m/{i}", None) for i in range(3)],
                                    "run_id string, batch_no bigint, pos bigint, dataset_id string, mapfile string, stage_error string")
    runs = spark.createDataFrame([("r", 1, 0, False, 5, None, "/log")],
                                 "run_id string, batch_no bigint, exit_code int, timed_out boolean, output_length bigint, batch_error string, log_file string")
    log = spark.createDataFrame([("r", 1, 1, "PUB_STATUS=PASS id=d0000.v1|n"), ("r", 1, 2, "PUB_STATUS=FAIL id=d0001.v1|n")],
                                "run_id string, batch_no bigint, line_no bigint, line string")
    outcomes = publication.batch_outcomes(members, runs, log)
    state.update(state_changes.apply_outcomes(outcomes, NOW), NOW, job="r")
    state.update(state_changes.apply_outcomes(outcomes, NOW), NOW, job="r")
    found = by(state.read("datasets"), "dataset_id")
    assert [found[f"d{i:04}#1"].publication_status for i in range(4)] == ["SUCCESS", "FAILED", "PENDING", "PENDING"]
    assert sorted(r.status for r in state.read("publication_attempts").collect()) == ["FAILED", "SUCCESS", "UNREACHED"]
    assert state.version() == 2
