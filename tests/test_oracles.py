"""A cross-section of the registered queries against DuckDB at the smallest scale."""

import os

import pytest

import __spark_entry__ as registered
from tools.compare import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
CHOSEN = (
    "status_latest_attempt", "campaign_records", "failures", "mapfile_scan", "register_upsert", "retire", "validation_report",
    "claim_limited", "batch_outcomes", "server_diagnostic", "item_verdict", "stac_outcome", "archive_path", "import_archive_results",
    "sync_failures", "payload_batches", "restore_coverage", "lease_stream", "log_stream", "attempt_rates",
)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_statement(spark, name):
    columns, rows = spark_rows(registered.queries()[name](spark, SF))
    duck_columns, expected, _ = duck_rows(connect(SF), registered.oracle_sql()[name])
    assert columns == duck_columns and rows == expected


def test_every_query_of_the_catalog_has_a_statement():
    assert set(registered._collect("Q")) == set(registered._collect("SQL"))
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
