import hashlib

import pytest
from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import ids, mapfile
from mapledger.operators import registration
from mapledger.plans import workflows
from mapledger.sources import files
from tests.helpers import NOW, by, datasets, one, ts

NAMES = list(schemas.DRS_FIELDS)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), "mapfile string, line_no bigint, line string")


def test_components_and_errors(spark):
    df = spark.createDataFrame([("P.A.I.S.E.M.T.V.G#1",), ("P.A.I.S.E.M.T.V.G#v1",), ("P.A.I.S.E.M.T.V.G.v1",), ("P.A",)], "id string")
    rows = df.select("id", ids.drs_map(F.col("id"), NAMES)["version"].alias("v"), ids.components_error(F.col("id"), NAMES).alias("e")).collect()
    assert [r.v for r in rows] == ["v1", "vv1", "v1", None]
    assert rows[3].e.startswith("Unexpected DRS format: dataset ID contains 2 components") and rows[0].e is None


def test_components_split_at_first_mark_and_last_duplicate_name_wins(spark):
    df = spark.createDataFrame([("a.b#c#d",)], "id string")
    names = ["x", "y", "z"]
    assert ids_map(df, names) == {"x": "a", "y": "b", "z": "vc#d"}
    assert ids_map(df, ["x", "y", "x"]) == {"x": "vc#d", "y": "b"}
    dynamic = df.withColumn("names", F.array(F.lit("x"), F.lit("y"), F.lit("x")))
    got = dynamic.select(ids.drs_map(F.col("id"), F.col("names")).alias("m")).first()["m"]
    assert got == {"x": "vc#d", "y": "b"}


def ids_map(df, names):
    return df.select(ids.drs_map(F.col("id"), names).alias("m")).first()["m"]


def test_prefix_rejects_unknown_depth():
    with pytest.raises(ValueError, match="Invalid archival depth"):
        ids.drs_prefix(None, "nowhere")


def test_scan_names_the_first_fault(spark):
    df = lines(
        spark,
        ("ok", 1, "a | /p | 5 | checksum=1 | checksum = 2 | x | mod_time=a=b"), ("ok", 2, ""), ("ok", 3, "a | /q | 1_0"),
        ("two", 1, "a | /p | 1"), ("two", 2, "b | /p | 1"), ("two", 3, "short"), ("two", 4, "c | /p | 1"),
        ("short", 1, "a | /p | 1"), ("short", 2, "only | two"), ("short", 3, "b | /p | 1"),
        ("size", 1, "a | /p | 1.5"), ("size", 2, "b | /p | 1"),
        ("blank", 1, "  "),
    )
    full = by(registration.scan_mapfiles(df, include_files=True), "mapfile")
    assert full["ok"].dataset_id == "a" and full["ok"].n_files == 2 and full["ok"].error is None
    assert full["blank"].error == "No dataset found in blank"
    assert full["two"].error == "Multiple dataset IDs found in two" and full["two"].dataset_id is None
    assert full["short"].error == "Malformed mapfile line in short: only | two"
    assert full["size"].error == "invalid literal for int() with base 10: '1.5'"
    plain = by(registration.scan_mapfiles(df), "mapfile")
    assert plain["size"].error == "Multiple dataset IDs found in size"
    rows = registration.file_rows(df.filter("mapfile = 'ok'")).orderBy("file_path").collect()
    assert [(r.file_path, r.file_size, r.checksum, r.mod_time) for r in rows] == [("/p", 5, "2", "a=b"), ("/q", 10, None, None)]


def test_reading_mapfile_folders(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.map").write_bytes(b"P.A | /d/1 | 3\r\nP.A | /d/2 | 4\n")
    (tmp_path / "a" / "b" / "y.map").write_text("bad line\n")
    (tmp_path / "a" / "z.txt").write_text("no")
    raw = files.read_mapfiles(spark, str(tmp_path))
    got = by(registration.scan_mapfiles(files.mapfile_lines(raw), True), "mapfile")
    assert got[f"{tmp_path}/a/x.map"].n_files == 2
    assert got[f"{tmp_path}/a/b/y.map"].error.endswith("bad line") and len(got) == 2
    sums = by(files.fingerprints(raw), "mapfile")
    assert sums[f"{tmp_path}/a/x.map"].mapfile_checksum == hashlib.sha256((tmp_path / "a" / "x.map").read_bytes()).hexdigest()
    inventory = spark.createDataFrame(
        [(f"{tmp_path}/a/x.map", 5), (f"{tmp_path}/.h/q.map", 5), (f"{tmp_path}/a/_u.map", 5), (f"{tmp_path}/a/e.map", 0)], "path string, length bigint")
    assert {r.path.rsplit("/", 1)[1] for r in files.unread_paths(inventory, str(tmp_path)).collect()} == {"q.map", "_u.map", "e.map"}


CHANGE = "dataset_id string, campaign string, project string, activity string, institution string, drs string, mapfile string, mapfile_checksum string"


@pytest.mark.parametrize(
    "old_sum,new_sum,kept", [("one", "one", True), (None, "one", True), ("one", "two", False)],
)
def test_registering_again_keeps_or_resets_state(spark, old_sum, new_sum, kept):
    old = datasets(spark, {
        "dataset_id": "d", "mapfile_checksum": old_sum, "registration_status": "RETIRED", "retired_at": ts("2024-01-01"),
        "publication_status": "SUCCESS", "publication_claim_id": "r", "publication_claimed_at": ts("2024-01-02"), "archive_status": "SUCCESS",
        "archive_completed_at": ts("2024-01-03"), "stac_status": "PRESENT", "stac_checked_at": ts("2024-01-04"), "stac_http_status": 200,
        "registered_at": ts("2023-01-01")})
    new = spark.createDataFrame([("d", "c2", "P", "A", "I", "{}", "/new.map", new_sum)], CHANGE)
    state = registration.register_upsert(old, new, NOW)
    row = one(state)
    assert (row.registration_status, row.retired_at, row.campaign, row.mapfile, row.mapfile_checksum) == ("ACTIVE", None, "c2", "/new.map", new_sum)
    assert row.registered_at == ts("2023-01-01")
    expected = ("SUCCESS", "r", "SUCCESS", "PRESENT", 200) if kept else ("PENDING", None, "PENDING", "UNCHECKED", None)
    assert (row.publication_status, row.publication_claim_id, row.archive_status, row.stac_status, row.stac_http_status) == expected
    assert one(registration.register_upsert(state, new, ts("2025-01-01"))) == row  # registering twice changes nothing


def test_two_mapfiles_of_one_id_apply_in_order(spark):
    old = datasets(spark, {"dataset_id": "d", "mapfile_checksum": "s1", "publication_status": "SUCCESS"})
    changes = spark.createDataFrame(
        [("d", "c", "P", "A", "I", "{}", "/a.map", "s1"), ("d", "c", "P", "A", "I", "{}", "/b.map", "s2")], CHANGE)
    row = one(registration.register_upsert(old, changes, NOW))
    assert (row.mapfile, row.mapfile_checksum, row.publication_status) == ("/b.map", "s2", "PENDING")


def test_retire_guards(spark):
    old = datasets(
        spark, *[{"dataset_id": f"{c}-{i}", "campaign": c, "publication_claim_id": "x"} for c in ("clean", "failed", "empty", "unscanned") for i in (1, 2)])
    current = spark.createDataFrame([("clean", "clean-1"), ("failed", "failed-1")], "campaign string, dataset_id string")
    scans = spark.createDataFrame([("clean", 1, 0), ("failed", 2, 1), ("empty", 0, 0)], "campaign string, scanned bigint, failed bigint")
    state = by(registration.retire(old, current, scans, NOW), "dataset_id")
    assert {k for k, r in state.items() if r.registration_status == "RETIRED"} == {"clean-2"}
    assert state["clean-2"].retired_at == NOW and state["clean-2"].publication_claim_id is None
    assert state["clean-1"].publication_claim_id == "x"
    allowed = by(registration.retire(old, current, scans, NOW, allow_empty=True), "dataset_id")
    assert {k for k, r in allowed.items() if r.registration_status == "RETIRED"} == {"clean-2", "empty-1", "empty-2"}


def test_register_workflow(spark):
    ident = "P.A.I.S.E.M.T.V.G#1"
    state = datasets(spark, {"dataset_id": "P.A.I.S.E.M.T.V.G#old"})
    prior = spark.createDataFrame([(ident, "/gone", 1, None, None)], schemas.FILES)
    new = lines(spark, ("/m/1.map", 1, f"{ident} | /f1 | 10"), ("/m/1.map", 2, f"{ident} | /f2 | 20"))
    sums = spark.createDataFrame([("/m/1.map", "s")], "mapfile string, mapfile_checksum string")
    roots = spark.createDataFrame([("/m/1.map", "c", "P", "A", "I")], "mapfile string, campaign string, project string, activity string, institution string")
    out = workflows.register(state, prior, new, sums, roots, NAMES, NOW, include_files=True)
    rows = by(out.datasets, "dataset_id")
    assert rows[ident].registration_status == "ACTIVE" and rows[ident].drs.startswith('{"project": "P"')
    assert rows["P.A.I.S.E.M.T.V.G#old"].registration_status == "RETIRED"
    assert {r.file_path for r in out.files.collect()} == {"/f1", "/f2"}
    s = one(out.summary)
    assert (s.succeeded, s.failed, s.current, s.retired) == (1, 0, 1, 1) and out.rejected.count() == 0


def test_path_mappings(spark):
    pairs = [("/a/", "/b"), ("/c", "/d/"), ("/c/x", "/never")]
    cases = {"/a/x": "/b/x", "/a/": "/b", "/c": "/d/", "/c/x": "/d/x", "/cx": "/cx"}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert {r.p: r.m for r in df.select("p", mapfile.mapped_path(F.col("p"), pairs).alias("m")).collect()} == cases
    strict = {"/c/x": "/d//x", "/c": "/c"}
    df = spark.createDataFrame([(k,) for k in strict], "p string")
    assert {r.p: r.m for r in df.select("p", mapfile.mapped_path(F.col("p"), pairs, True).alias("m")).collect()} == strict
    df = spark.createDataFrame([("id|/c/x|1",), ("id",), ("id|/c/x",)], "l string")
    assert [r.m for r in df.select(mapfile.rewritten_line(F.col("l"), pairs).alias("m")).collect()] == ["id| /d/x |1", "id", "id| /d/x "]
    assert [r.m for r in df.select(mapfile.rewritten_line(F.col("l"), pairs, True).alias("m")).collect()] == ["id| /d//x |1", "id", "id|/c/x"]


def test_campaign_configuration(spark, tmp_path):
    (tmp_path / "c.yml").write_text(
        "campaigns:\n  a:\n    project: P\n    activity: A\n    institution: I\n    mapfile_root: $BASE/maps\n    archive:\n      enabled: true\n      root: /arc\n      depth: grid\n"
        "  b:\n    project: P\n    activity: A\n    institution: I\n    mapfile_root: rel/maps\n    archive:\n      enabled: false\n      root: /arc\n      depth: grid\n"
        "  c:\n    project: P\n    activity: A\n    institution: I\n    mapfile_root: ~/maps\n")
    rows = by(files.read_campaigns(spark, str(tmp_path / "c.yml"), "/root-dir", env={"BASE": "/base"}, home="/home/me"), "name")
    assert (rows["a"].mapfile_root, rows["a"].archive_root, rows["a"].archive_depth) == ("/base/maps", "/arc", "grid")
    assert (rows["b"].mapfile_root, rows["b"].archive_root) == ("/root-dir/rel/maps", None)
    assert (rows["c"].mapfile_root, rows["c"].archive_depth) == ("/home/me/maps", None)
