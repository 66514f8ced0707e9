"""Request bodies of all four sheet tables."""

import json

from mapledger import schemas
from mapledger.plans import workflows
from tests.helpers import NOW, datasets


def test_diagnostics_reach_the_sheet(spark):
    campaigns = spark.createDataFrame([("c", "P", "A", "I", "/m", None, None)], schemas.CAMPAIGNS)
    attempts = spark.createDataFrame([], schemas.ATTEMPTS)
    row = {"diagnostic_id": "x1", "diagnostic_run_id": "r", "dataset_id": "d#1", "campaign": "c", "outcome": "DIAGNOSED", "started_at": NOW,
           "exit_code": 1, "summary": "said \"no\""}
    known = {**row, "diagnostic_id": "x0"}
    diagnostics = spark.createDataFrame([tuple(r.get(n) for n in schemas.DIAGNOSTICS.names) for r in (row, known)], schemas.DIAGNOSTICS)

    def snapshot(*key):
        return spark.createDataFrame([], "record_no long, record_id long, " + ", ".join(f"{k} string" for k in key))

    sheet = {"Campaigns": snapshot("campaign"), "Datasets": snapshot("dataset_id"), "Failures": snapshot("dataset_id", "run_id"),
             "Diagnostics": spark.createDataFrame([(1, 70, "x0")], "record_no long, record_id long, diagnostic_id string")}
    out = workflows.sync_batches(datasets(spark, {"dataset_id": "d#1"}), campaigns, attempts, sheet, diagnostics=diagnostics).collect()
    found = {(r.table_name, r.kind): json.loads(r.body)["records"] for r in out}
    assert set(found) == {("Campaigns", "create"), ("Datasets", "create"), ("Diagnostics", "create"), ("Diagnostics", "update")}
    new, old = found["Diagnostics", "create"][0], found["Diagnostics", "update"][0]
    assert new["fields"]["summary"] == 'said "no"' and new["fields"]["started_at"] == NOW.isoformat() and old["id"] == 70
    without = workflows.sync_batches(datasets(spark, {"dataset_id": "d#1"}), campaigns, attempts, sheet).collect()
    assert {r.table_name for r in without} == {"Campaigns", "Datasets"}
