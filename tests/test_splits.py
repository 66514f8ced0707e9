"""Files with line breaks in fields, read by several tasks."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from mapledger.session import fresh_folder
from mapledger.sources import files, splits

REQUIRED = files.TASK_COLUMNS


@pytest.fixture
def small_splits(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def _place(spark, name):
    folder = fresh_folder(spark, "splits").removeprefix("file:")
    import os

    os.makedirs(folder)
    return f"{folder}/{name}"


def _texts(draw, n):
    parts = ["a", "b c", "\n", '"', ",", "é", "\r\n", "line\nbreak", '""', "x" * 90, "{", "}", "[", "]", "\\", ":", "'"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_equals_a_plain_reader(spark, small_splits, end):
    draw = random.Random(7)
    path = _place(spark, "tasks.csv")
    texts = [t.replace("\\", "/") for t in _texts(draw, 120)]
    with open(path, "w", newline="") as held:
        out = csv.writer(held, lineterminator=end)
        out.writerow([*REQUIRED, "note"])
        for i, t in enumerate(texts):
            out.writerow([f"t{i}", f"d{i}", "/m", "s", "/a", t])
    with open(path, newline="") as held:
        plain = [tuple(r) for r in csv.reader(held)][1:]
    assert splits.pieces(spark, path, "\n").select("block").distinct().count() > 5
    found = files.read_csv(spark, path, REQUIRED).orderBy("row_no").drop("row_no").collect()
    assert [tuple(x or "" for x in r) for r in found] == plain and len(plain) == 120


def test_csv_of_header_or_nothing(spark, small_splits):
    for text in (",".join(REQUIRED) + "\n", ",".join(REQUIRED), ",".join(REQUIRED) + "\n\n\n"):
        path = _place(spark, "x.csv")
        with open(path, "w") as held:
            held.write(text)
        assert files.read_csv(spark, path, REQUIRED).collect() == []


def test_several_csv_files_keep_their_headers_out(spark, small_splits):
    folder = _place(spark, "many")
    import os

    os.makedirs(folder)
    for k in range(3):
        with open(f"{folder}/{k}.csv", "w", newline="") as held:
            out = csv.writer(held)
            out.writerow(REQUIRED)
            out.writerows([f"{k}-{i}", "d\n\nq", "m", "s", "a"] for i in range(40))
    rows = files.read_csv(spark, folder, REQUIRED)
    assert rows.count() == 120 and rows.where("task_id = 'task_id'").count() == 0
    assert {r.dataset_id for r in rows.collect()} == {"d\n\nq"}


def _records(n):
    draw = random.Random(3)
    return [{"id": i, "fields": {"dataset_id": f"d{i}", "note": t, "deep": {"x": [{"y": t[:3]}, []]}} if i % 7 else {}}
            for i, t in enumerate(_texts(draw, n))]


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_documents_equal_the_read_as_a_whole(spark, small_splits, style):
    path = _place(spark, "sheet.json")
    with open(path, "w") as held:
        held.write(json.dumps({"records": _records(150)}, **style))
    whole = files.read_sheet(spark, path).orderBy("record_no").collect()
    found = files.read_sheet_split(spark, path).orderBy("record_no").collect()
    assert splits.pieces(spark, path, "}").select("block").distinct().count() > 5
    assert [(r.record_id, json.loads(r.fields)) for r in found] == [(r.record_id, json.loads(r.fields)) for r in whole]
    assert len(found) == 150


def test_documents_without_records(spark, small_splits):
    path = _place(spark, "empty.json")
    with open(path, "w") as held:
        held.write('{"records": []}\n')
    assert files.read_sheet_split(spark, path).collect() == []
    path = _place(spark, "bad.json")
    with open(path, "w") as held:
        held.write('{"error": "denied", "code": {"x": 1}}')
    with pytest.raises(Exception, match="missing records list"):
        files.read_sheet_split(spark, path).collect()


def test_large_file_takes_more_than_one_task(spark):
    path = _place(spark, "large.csv")
    row = ["d", "m" * 300, "s", 'two\nlines "quoted"']
    with open(path, "w", newline="") as held:
        out = csv.writer(held)
        out.writerow(REQUIRED)
        out.writerows([i, *row] for i in range(60_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        rows = files.read_csv(spark, path, REQUIRED)
        assert splits.pieces(spark, path, "\n").rdd.getNumPartitions() > 3
        stats = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("task_id").alias("ids"), F.min("archive_path").alias("low"), F.max("archive_path").alias("high")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert (stats.n, stats.ids) == (60_000, 60_000) and stats.low == stats.high == row[-1]
