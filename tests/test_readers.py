"""Recorded responses with their bytes, and listings of file trees."""

import hashlib
import os

import pytest

from mapledger.operators import reconcile, validation
from mapledger.session import fresh_folder
from mapledger.sources import files, listing, responses
from tests.helpers import NOW, by, datasets, ts

KIND = "collection_id string, item_id string, attempt_no int, http_status int, body binary, error string"
GOOD = b'{"type":"Feature","id":"i","collection":"c"}'


def _stored(spark, *rows):
    return responses.write_responses(spark.createDataFrame(list(rows), KIND), fresh_folder(spark, "responses"), buckets=4)


def test_bytes_overload_transport_error_and_third_attempt(spark):
    odd = b"\xff" + GOOD
    path = _stored(
        spark, ("c", "i", 0, 429, b"busy", None), ("c", "i", 1, None, None, "ConnectionError: reset"), ("c", "i", 2, 200, GOOD, None),
        ("c", "j", 0, 200, odd, None), ("c", "k", 0, 404, b"\xfe\x00", None))
    kept = {(r.item_id, r.attempt_no): r for r in responses.read_responses(spark, path).collect()}
    assert bytes(kept["j", 0].body) == odd and kept["i", 1].body is None and len(kept) == 5
    out = by(reconcile.judged_responses(responses.read_responses(spark, path)), "item_id")
    assert (out["i"].outcome, out["i"].response_hash) == ("PRESENT", hashlib.sha256(GOOD).hexdigest())
    assert (out["j"].outcome, out["j"].error_message) == ("ERROR", "JSONDecodeError: response body is not valid JSON")
    assert (out["k"].outcome, out["k"].response_hash) == ("ABSENT", hashlib.sha256(b"\xfe\x00").hexdigest())
    two = by(reconcile.judged_responses(responses.read_responses(spark, path), retries=1), "item_id")
    assert two["i"].outcome == "ERROR" and two["i"].error_message == "ConnectionError: reset"


def test_some_items_are_found_in_their_folders(spark):
    path = _stored(spark, *[(c, f"i{n}", 0, 200, b"x", None) for c in "ab" for n in range(40)])
    wanted = spark.createDataFrame([("a", "i7"), ("a", "none"), (None, "i8"), ("a", None)], "collection_id string, item_id string")
    found = responses.read_responses(spark, path, wanted, buckets=4)
    assert [(r.collection_id, r.item_id) for r in found.collect()] == [("a", "i7")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collection_id" in plan[plan.index("PartitionFilters"):][:200] and "item_bucket" in plan[plan.index("PartitionFilters"):][:300]
    assert responses.read_responses(spark, path, wanted.where("false"), buckets=4).count() == 0


def test_bodies_outside_the_scope_are_not_read(spark):
    published = ts("2024-01-31 23:59:00")
    d = datasets(spark, {"dataset_id": "i", "project": "c", "publication_status": "SUCCESS"}, {"dataset_id": "new", "project": "c", "publication_status": "SUCCESS"})
    attempts = spark.createDataFrame([("new", "SUCCESS", published)], "dataset_id string, status string, finished_at timestamp_ntz")
    rows = spark.createDataFrame([("c", "i", 0, 200, GOOD, None), ("c", "other", 0, 200, GOOD, None), ("c", "new", 0, 404, None, None)], KIND)
    out = by(reconcile.compare(d.select("dataset_id", "campaign", "project", "publication_status"), attempts, rows, "https://h", NOW), "dataset_id")
    assert {k: r.outcome for k, r in out.items()} == {"i": "PRESENT", "new": "WAITING"}
    assert out["new"].http_status is None


@pytest.fixture
def tree(spark):
    root = fresh_folder(spark, "tree").removeprefix("file:")
    os.makedirs(f"{root}/a/b/.hidden")
    os.makedirs(f"{root}/empty")
    for name, text in (("a/x.map", "line\n"), ("a/b/zero.map", ""), ("a/b/.hidden/h.map", "hid"), (".dot.map", "d"), ("a/b/_under.map", "uu")):
        with open(f"{root}/{name}", "w") as held:
            held.write(text)
    os.symlink(f"{root}/a/x.map", f"{root}/link.map")
    os.symlink(f"{root}/a", f"{root}/loop")
    return root


def test_listing_finds_hidden_and_empty_files(spark, tree):
    found = {r.path.removeprefix(f"{tree}/"): r.length for r in listing.list_tree(spark, f"file://{tree}/").collect()}
    assert found == {"a/x.map": 5, "a/b/zero.map": 0, "a/b/.hidden/h.map": 3, ".dot.map": 1, "a/b/_under.map": 2, "link.map": 5}
    assert listing.list_tree(spark, f"{tree}/empty", f"{tree}/none").collect() == []


def test_listing_feeds_the_checks_of_files(spark, tree):
    inventory = listing.list_tree(spark, tree)
    passed_over = {r.path.removeprefix(f"{tree}/") for r in files.unread_paths(inventory, tree).collect()}
    assert passed_over == {"a/b/zero.map", "a/b/.hidden/h.map", ".dot.map", "a/b/_under.map"}
    lines = spark.createDataFrame(
        [("m", 1, f"d | {tree}/a/x.map | 1"), ("m", 2, f"d | {tree}/gone.nc | 1")], "mapfile string, line_no bigint, line string")
    problems = validation.line_problems(lines, inventory).collect()
    assert [r.problem for r in problems] == [f"Line 2: missing file {tree}/gone.nc"]
