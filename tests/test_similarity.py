"""Suggestions over distinct pairs."""

import random
from difflib import SequenceMatcher, get_close_matches

from pyspark.sql import functions as F

from mapledger.functions import logs, similarity

WORDS = ["air_temperature", "air_temperatur", "wind", "wnid", "published", "publshed", "", "aa", "aaa", "é\U0001f600x", "é\U0001f600", "x" * 250]


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "value string, choices array<string>")


def test_suggestions_equal_the_plain_judgement(spark):
    draw = random.Random(5)
    rows = [(draw.choice(WORDS), draw.sample(WORDS, draw.randint(0, 5))) for _ in range(150)]
    rows += [(None, ["wind"]), ("wind", None), ("wind", ["wind", None]), ("wind", ["wind", "wind"])]
    found = {(r.value, tuple(r.choices)): r.suggested for r in similarity.suggestions(_pairs(spark, rows)).collect()}
    for value, choices in rows:
        if value is not None and choices is not None:
            best = get_close_matches(value, [c for c in choices if c is not None], n=1, cutoff=0.75)
            assert found.get((value, tuple(choices))) == (best[0] if best else None), (value, choices)


def test_only_distinct_pairs_below_the_bound_are_judged(spark):
    rows = [("publshed", ["published", "wind"])] * 500 + [("wnid", ["wind", "published"])] * 300
    judged = similarity.judged_pairs(_pairs(spark, rows)).collect()
    assert sorted(map(tuple, judged)) == [("publshed", "published"), ("wnid", "wind")]


def test_the_bound_is_the_quick_one(spark):
    pairs = [(a, b) for a in WORDS for b in WORDS]
    table = spark.createDataFrame(pairs, "a string, b string")
    for r in table.select("a", "b", similarity.ratio_bound(F.col("a"), F.col("b")).alias("x")).collect():
        assert abs(r.x - SequenceMatcher(None, r.a, r.b).quick_ratio()) < 1e-12


def test_rows_without_values_stay_and_spread(spark):
    rows = [(i, None if i % 3 else "wnid", None if i % 2 else ["wind"]) for i in range(60)]
    table = spark.createDataFrame(rows, "n long, value string, choices array<string>")
    found = similarity.with_suggestions(table, F.col("value"), F.col("choices"), F.col("n"))
    assert {r.n: r._suggested for r in found.collect()} == {i: "wind" if i % 6 == 0 else None for i in range(60)}
    assert found.columns == ["n", "value", "choices", "_suggested"]


def test_joined_verdicts_equal_those_by_row(spark):
    rows = [("'air_temperatur'", "['air_temperature', 'wind']"), ("5", "['5']"), ("'x'", "[1, 'x']"), ("'x'", "[]"), (None, "['a']"), (None, None)]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, v string, c string")
    joined = logs.with_enum_verdict(table, "v", "c", F.col("n")).select("n", "_enum")
    plain = table.select("n", logs.enum_verdict(F.col("v"), F.col("c")).alias("_enum"))
    assert sorted(joined.collect()) == sorted(plain.collect())
