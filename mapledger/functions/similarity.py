"""The closest accepted choice of rejected values, judged once for each distinct pair of texts."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how similar a suggestion has to be.
CUTOFF = 0.75


def ratio_bound(a: Column, b: Column) -> Column:
    """What the similarity of two texts cannot exceed: twice the characters they have in common, whatever their order,
    over the characters of both."""
    letters = F.array_distinct(F.regexp_extract_all(a, F.lit("(?s)."), F.lit(0)))

    def times(text: Column, letter: Column) -> Column:
        return F.char_length(text) - F.char_length(F.replace(text, letter, F.lit("")))

    shared = F.aggregate(letters, F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x)))
    total = F.char_length(a) + F.char_length(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * shared / total)


@F.pandas_udf(T.DoubleType())
def ratio(value: pd.Series, choice: pd.Series) -> pd.Series:
    """The similarity of a value and a choice."""
    return pd.Series([SequenceMatcher(None, c, v).ratio() for v, c in zip(value, choice)], dtype="float64")


def judged_pairs(pairs: DataFrame) -> DataFrame:
    """(value, choice): the distinct pairs whose bound lets them pass; only these meet Python."""
    each = pairs.where("value IS NOT NULL").select("value", F.explode("choices").alias("choice")).where("choice IS NOT NULL").distinct()
    # The shorter bound first: lengths alone rule most pairs out.
    lengths = F.lit(2.0) * F.least(F.char_length("value"), F.char_length("choice")) >= F.lit(CUTOFF) * (
        F.char_length("value") + F.char_length("choice"))
    return each.where(lengths & (ratio_bound(F.col("value"), F.col("choice")) >= CUTOFF))


def suggestions(pairs: DataFrame) -> DataFrame:
    """(value, choices, suggested) of every distinct value and list of choices that has a similar enough choice; of
    equally similar ones the greatest."""
    lists = pairs.where("value IS NOT NULL AND choices IS NOT NULL").select("value", "choices").distinct()
    judged = judged_pairs(lists).withColumn("ratio", ratio("value", "choice")).where(F.col("ratio") >= CUTOFF)
    each = lists.select("value", "choices", F.explode("choices").alias("choice"))
    return each.join(judged, ["value", "choice"]).groupBy("value", "choices").agg(
        F.max(F.struct("ratio", "choice"))["choice"].alias("suggested"))


def with_suggestions(df: DataFrame, value: Column, choices: Column, salt: Column) -> DataFrame:
    """Rows with `_suggested`, the closest of their choices. Rows without a value or choices take no part; `salt`, any
    column of theirs, spreads them over tasks."""
    # A null character begins no value, so these keys meet nothing.
    key = F.when(value.isNotNull() & choices.isNotNull(), value).otherwise(F.concat(F.lit("\0"), F.xxhash64(salt).cast("string")))
    keyed = df.withColumn("_choices_key", F.coalesce(choices, F.array().cast("array<string>"))).withColumn("_value_key", key)
    found = suggestions(keyed.where(value.isNotNull() & choices.isNotNull()).select(
        F.col("_value_key").alias("value"), F.col("_choices_key").alias("choices")))
    named = found.select(
        F.col("value").alias("_found_value"), F.col("choices").alias("_found_choices"), F.col("suggested").alias("_suggested"))
    same = (F.col("_value_key") == F.col("_found_value")) & (F.col("_choices_key") == F.col("_found_choices"))
    return keyed.join(named, same, "left").drop("_value_key", "_choices_key", "_found_value", "_found_choices")
