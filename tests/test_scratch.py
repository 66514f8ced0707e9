"""What registered queries leave on the disk: tables, shuffles and item files of their own rows."""

import datetime as dt
import gzip
import hashlib
import os

import pytest
from pyspark.errors import AnalysisException

from mapledger import session
from mapledger.fixtures.projection import Catalog
from registry import items as item_queries
from mapledger.sources import files
from registry import items as item_queries
from registry import reporting

DAY = dt.datetime(2024, 1, 2)
ROWS = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "A", 0), (1, "B", 0)]),
    "customer": ("c_custkey bigint, c_nationkey int", [(k, k % 2) for k in range(4)]),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz", [(k, k % 4, "FOP"[k % 3], DAY) for k in range(40)]),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz",
                 [(k, k * 7, n, 2.0, DAY) for k in range(40) for n in (1, 2)]),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
               [(k, DAY, k % 5, ("view", "click", "purchase", "error")[k % 4], "p") for k in range(160)]),
}


class Own(Catalog):
    def base(self, name):
        kind, rows = ROWS[name]
        return self.spark.createDataFrame(rows, kind)


def held(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """The folder that holds what queries write meanwhile."""
    fresh = lambda _, purpose: f"file://{tmp_path}/{purpose}"
    monkeypatch.setattr(reporting, "fresh_folder", fresh)
    return tmp_path


def test_tables_go_when_they_are_counted(spark, folder):
    rows = {r.table_name: r.n_rows for r in reporting.Q["catalog_tables"](Own(spark, "none")).collect()}
    assert rows["datasets"] == 40 and rows["files"] == 80 and rows["campaigns"] == 2 and len(rows) == 7
    assert held(folder) == 0


def test_shuffles_go_with_the_write(spark, tmp_path):
    def kept():
        status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
        return status.shuffleStatuses().size()

    with session.shuffles_freed(spark):
        before = kept()
        spark.range(1000).repartition(7, "id").write.parquet(f"{tmp_path}/a")
        assert kept() <= before
    assert spark.conf.get(session._FREED) == "false"


@pytest.mark.parametrize("lot", [1 << 19, 7])
def test_item_files_are_written_read_and_removed_by_lots(spark, folder, monkeypatch, lot):
    monkeypatch.setattr(item_queries, "FILES", lot, raising=False)
    monkeypatch.setattr(item_queries, "fresh_folder", lambda _, purpose: f"file://{folder}/{purpose}")
    found = {r.file_name: r for r in item_queries.Q["stac_item_files"](Own(spark, "none")).collect()}
    expected = {r.file_name: r.doc for r in Own(spark, "none").stac_items.collect()}
    assert set(found) == set(expected) and len(found) == 40
    assert all(found[k].doc_hash == hashlib.md5(v.encode()).hexdigest() and found[k].readable == (v != "{bad") for k, v in expected.items())
    assert not list(folder.rglob("CMIP6*.json"))


def test_items_are_listed_by_tasks(spark, tmp_path):
    for name, text in (("CMIP6.a+b %41.json", "{}"), ("CMIP6.x.json", "é"), ("CMIP6.empty.json", ""), ("_CMIP6.json", "h"), (".CMIP6.json", "h"), ("o.json", "[]")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "CMIP6.z.json.gz").write_bytes(gzip.compress(b"{1}"))
    (tmp_path / "CMIP6.f").mkdir()
    (tmp_path / "CMIP6.f" / "in.json").write_text("{}")
    every = files.read_items(spark, str(tmp_path))
    assert every.inputFiles() == []
    assert {r.file_name: r.doc for r in every.collect()} == {
        "CMIP6.a+b %41.json": "{}", "CMIP6.x.json": "é", "o.json": "[]", "CMIP6.z.json.gz": "{1}"}
    some = files.read_item_folder(spark, f"file://{tmp_path}/", "CMIP6.[!a]{,.json}")
    assert {r.file_name: (r.item_id, r.doc) for r in some.collect()} == {"CMIP6.x.json": ("CMIP6.x", "é"), "in.json": ("in", "{}")}
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_item_folder(spark, str(tmp_path), "none*")
    assert files.read_items(spark, f"{tmp_path}/o.json").first()["doc"] == "[]"
