"""Identifier specifications by project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.functions import ids
from mapledger.functions.once import with_once

#: Component names of every identifier, or a table (project, names) with one row per project.
Spec = ids.Names | DataFrame


def with_components(df: DataFrame, spec: Spec, project: str) -> tuple[DataFrame, ids.Names, Column]:
    """Rows with `_parts`, the components of their `dataset_id` split once; the names to read them by; and the reason
    where a project has no specification. A table of specifications is joined by project, one small row each."""
    if not isinstance(spec, DataFrame):
        return with_once(df, _parts=ids.components(F.col("dataset_id"), spec)), spec, F.lit(None).cast("string")
    named = spec.select(F.col("project").alias("_spec_project"), F.col("names").alias("_names"))
    joined = df.join(named, F.col(project) == F.col("_spec_project"), "left").drop("_spec_project")
    names = F.col("_names")
    # Fixed text of our own.
    missing = F.when(names.isNull(), F.concat(F.lit("No identifier specification for project: "), F.coalesce(F.col(project), F.lit("None"))))
    return with_once(joined, _parts=ids.components(F.col("dataset_id"), names)), names, missing
