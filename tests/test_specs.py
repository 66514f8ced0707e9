"""Component names by project: two depths in one run."""

import json

from pyspark.sql import functions as F

from mapledger import schemas
from mapledger.functions import ids
from mapledger.functions.text import json_string
from mapledger.operators import archive
from mapledger.plans import workflows
from tests.helpers import NOW, by, datasets, value

SHORT = list(schemas.DRS_FIELDS)
LONG = [*SHORT[:3], "subproject", *SHORT[3:]]


def _specs(spark):
    return spark.createDataFrame([("P", SHORT), ("Q", LONG)], "project string, names array<string>")


def _id(project, depth):
    return ".".join([project, "A", "I", *(["sub"] if depth == 11 else []), "S", "E", "M", "T", "V", "G#1"])


def test_one_run_registers_projects_of_different_depth(spark):
    rows = [("/p.map", _id("P", 10)), ("/q.map", _id("Q", 11)), ("/bad.map", _id("Q", 10)), ("/x.map", _id("X", 10))]
    lines = spark.createDataFrame([(m, 1, f"{i} | /f{k} | 1") for k, (m, i) in enumerate(rows)], "mapfile string, line_no bigint, line string")
    prints = spark.createDataFrame([(m, "s") for m, _ in rows], "mapfile string, mapfile_checksum string")
    roots = spark.createDataFrame([(m, "c", i[0], "A", "I") for m, i in rows], "mapfile string, campaign string, project string, activity string, institution string")
    files = spark.createDataFrame([], schemas.FILES)
    out = workflows.register(datasets(spark), files, lines, prints, roots, _specs(spark), NOW)
    found = by(out.datasets, "dataset_id")
    assert json.loads(found[_id("P", 10)].drs)["source"] == "S" and "subproject" not in found[_id("P", 10)].drs
    long = json.loads(found[_id("Q", 11)].drs)
    assert list(long) == LONG and long["subproject"] == "sub" and long["version"] == "v1"
    errors = by(out.rejected, "mapfile")
    assert "ESGVOC defines 11 DRS components" in errors["/bad.map"].error
    assert errors["/x.map"].error == "No identifier specification for project: X"


def test_archive_plans_follow_the_project(spark):
    campaigns = spark.createDataFrame(
        [("p", "P", "A", "I", "/m", "/arch", "experiment"), ("q", "Q", "A", "I", "/m", "/arch", "experiment"), ("x", "X", "A", "I", "/m", "/arch", "experiment")],
        schemas.CAMPAIGNS)
    rows = datasets(
        spark, *[{"dataset_id": _id(p, d), "campaign": p.lower(), "project": p, "mapfile": f"/m/{p}.map", "publication_status": "SUCCESS", "mapfile_checksum": "s"}
                 for p, d in (("P", 10), ("Q", 11), ("X", 10))])
    tasks = by(archive.planned_tasks(rows, campaigns, _specs(spark), NOW), "campaign")
    assert tasks["p"].archive_path == "/arch/S/E/.mapfiles/P.map" and tasks["q"].archive_path == "/arch/sub/S/E/.mapfiles/Q.map"
    assert tasks["x"].archive_path is None and tasks["x"].problem == "No identifier specification for project: X"
    planned = archive.planned_tasks(rows, campaigns, _specs(spark), NOW)
    assert archive.unless_refused(planned).count() == 0
    assert archive.unless_refused(planned.where("campaign <> 'x'")).count() == 2


def test_components_are_not_split_again_for_each_name(spark):
    frame = spark.createDataFrame([(_id("P", 10),)], "dataset_id string")
    plan = frame.select(ids.drs_json(F.col("dataset_id"), SHORT))._jdf.queryExecution().executedPlan().toString()
    few = frame.select(ids.drs_json(F.col("dataset_id"), SHORT[:1]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == few.count("split(")


def test_json_text_of_odd_identifiers(spark):
    for text in ('a.b."q".d\\e', "ü.b", "plain", "tab\t", "\U0001f600"):
        assert json.loads(value(spark, json_string(F.col("x")), x=text)) == text
    odd = 'P.A.I."S".E.M.T\\.V.ü#1'
    found = json.loads(value(spark, ids.drs_json(F.col("x"), SHORT), x=odd))
    assert found["source"] == '"S"' and found["table"] == "T\\" and found["grid"] == "ü"
