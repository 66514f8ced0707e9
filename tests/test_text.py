import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger.functions import text
from mapledger.functions.ids import item_url, publisher_id

SAMPLES = [
    "", "plain", 'quo"te', "back\\slash", "tab\tnew\nline\r", "é", "日本", "😀 mixed é", "\x00\x1f\x7f", "\b\f", "a/b",
    "\u2028", "\ud7ff",
]


def test_json_string_equals_ascii_dumps(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = {r.s: r.j for r in df.select("s", text.json_string(F.col("s")).alias("j")).collect()}
    assert got == {s: json.dumps(s) for s in SAMPLES}


def test_json_object_nested(spark):
    schema = T.StructType([
        T.StructField("a", T.StringType()), T.StructField("n", T.LongType()), T.StructField("b", T.BooleanType()),
        T.StructField("t", T.TimestampNTZType()), T.StructField("l", T.ArrayType(T.StringType())),
        T.StructField("m", T.MapType(T.StringType(), T.LongType())),
    ])
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 600)
    df = spark.createDataFrame([("x", 5, True, moment, ["p", None], {"k": 1}), (None,) * 6], schema)
    out = [r.j for r in df.select(text.json_object({f.name: (F.col(f.name), f.dataType) for f in schema.fields}).alias("j")).collect()]
    assert json.loads(out[1]) == {k: None for k in schema.names}
    first = json.loads(out[0])
    assert first["t"] == moment.isoformat() and first["m"] == {"k": 1} and first["n"] == 5 and first["b"] is True


def test_strip_all_whitespace(spark):
    for s in ("\u2003x \t", "\x1cx\x85", "x", "", " \n"):
        got = spark.createDataFrame([(s,)], "s string").select(text.strip(F.col("s")).alias("v")).first()["v"]
        assert got == s.strip()


def test_iso_timestamp(spark):
    moments = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 5, 6, 7, 80), dt.datetime(1999, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(m,) for m in moments], T.StructType([T.StructField("t", T.TimestampNTZType())]))
    assert [r.i for r in df.select(text.iso_timestamp(F.col("t")).alias("i")).collect()] == [m.isoformat() for m in moments]


def test_publisher_id_forms(spark):
    cases = {"a.b#20240101": "a.b.v20240101", "a.b#v2024": "a.b.v2024", "a#b#3": "a#b.v3", "a.b.v1": "a.b.v1", "a#": "a.v"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r.s: r.p for r in df.select("s", publisher_id(F.col("s")).alias("p")).collect()} == cases


def test_item_url_quotes_everything_reserved(spark):
    from urllib.parse import quote

    raw = ["a b", "x/y#z", "é~*+", "CMIP6.a-b_c"]
    df = spark.createDataFrame([(s,) for s in raw], "s string")
    got = [r.u for r in df.select(item_url("https://h/", F.col("s"), F.col("s")).alias("u")).collect()]
    assert got == [f"https://h/collections/{quote(s, safe='')}/items/{quote(s, safe='')}" for s in raw]
