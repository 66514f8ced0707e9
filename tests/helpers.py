"""Small frames for tests."""

import datetime as dt

from pyspark.sql import functions as F

from mapledger import schemas

NOW = dt.datetime(2024, 2, 1)


def ts(text):
    return dt.datetime.fromisoformat(text)


def datasets(spark, *rows):
    """Dataset rows from partial dicts over sensible defaults."""
    base = {
        "campaign": "c", "project": "P", "activity": "A", "institution": "I", "mapfile": "/m/x.map",
        "registration_status": "ACTIVE", "publication_status": "PENDING", "archive_status": "PENDING",
        "stac_status": "UNCHECKED",
    }
    full = [tuple({**base, **r}.get(n) for n in schemas.DATASETS.names) for r in rows]
    return spark.createDataFrame(full, schemas.DATASETS)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def by(df, key):
    return {r[key]: r for r in df.collect()}


def value(spark, column, **inputs):
    """The value of an expression over a single row of text inputs."""
    names = list(inputs) or ["x"]
    schema = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([tuple(inputs.get(n) for n in names)], schema)
    return df.select(column.alias("v")).first()["v"]


def col(name):
    return F.col(name)
