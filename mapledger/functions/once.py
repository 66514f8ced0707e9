"""Evaluate costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are evaluated exactly once per row.

    A plain projection is folded into whatever uses it, so a filter and ten members
    of a parsed document would parse the text eleven times. Generating the values
    from a one-element array keeps them in a row of their own; nothing is shuffled.
    """
    values = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", values)
