"""Catalog tables as buckets of keys with deltas: small changes write small files, and several writers may try.

A state is a folder of Parquet folders and of numbered commits. A commit names, per table, either whole buckets (`base`)
or changed rows (`delta`), and the job that made it. Readers follow the commits: buckets that no later delta touches are
read as they are, in the others the newest row of a key wins. `compact` rewrites touched buckets only.

Commits are optimistic. A writer plans on one version and creates the next version's file, which fails if another writer
was first; it then reads again, plans again and tries the version after that. All tables of a commit become visible at
once, and a job that has a commit already is not applied again, so a replayed micro-batch changes nothing. What a losing
writer wrote stays unread. Creating a file under a name that must be new is atomic on HDFS; on a store whose rename is
not, one writer at a time has to commit.

The driver sees commits (one short row each) and bucket numbers, never rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger import schemas

_COMMIT = (
    "version bigint, job string, committed_at string, "
    "parts array<struct<table: string, kind: string, folder: string, buckets: array<int>>>"
)
DELETED = "_deleted"
_BUCKET, _VERSION = "_bucket", "_version"

#: Gives a table's rows, or those whose key is in a second frame.
Reader = Callable[..., DataFrame]
Change = Callable[[Reader], dict[str, DataFrame]]


class Contended(RuntimeError):
    """Other writers were first as often as this one was willing to try."""


@dataclass(frozen=True)
class Table:
    key: tuple[str, ...]
    schema: T.StructType


#: The catalog's own tables.
CATALOG = {name: Table(schemas.PRIMARY_KEYS[name], schema) for name, schema in schemas.TABLES.items()}


@dataclass(frozen=True)
class _Layout:
    """Where one table's rows stand at one version."""

    bases: dict[str, list[int]]
    deltas: list[tuple[int, str, list[int]]]

    @property
    def touched(self) -> list[int]:
        return sorted({b for _, _, buckets in self.deltas for b in buckets})


class KeyedState:
    def __init__(
        self, spark: SparkSession, root: str, tables: dict[str, Table] | None = None, buckets: int = 64, spread: int = 1,
    ):
        """``buckets`` belongs to the state for good; ``spread`` is the number of files a bucket is written to."""
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables or CATALOG
        self.buckets, self.spread = buckets, spread

    # ---- commits ----

    def commits(self) -> list:
        """Commit rows in order of version."""
        folder = f"{self.root}/commits"
        if not self._exists(folder):
            return []
        return sorted(self.spark.read.schema(_COMMIT).json(folder).collect(), key=lambda c: c["version"])

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return max((c["version"] for c in self.commits()), default=0)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._files(path).exists(self._path(path))

    def _commit(self, version: int, job: str | None, now: dt.datetime, parts: list[dict]) -> bool:
        """Create the version's file; false if another writer has it."""
        row = {"version": version, "job": job, "committed_at": now.isoformat(), "parts": parts}
        draft, final = f"{self.root}/drafts/{uuid.uuid4().hex}.json", f"{self.root}/commits/{version:020d}.json"
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        files = self._files(self.root)
        files.mkdirs(self._path(f"{self.root}/commits"))
        out = files.create(self._path(draft), False)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()
        target = files.makeQualified(self._path(final))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(self._path(draft)), target, never)
        except Py4JJavaError as problem:
            if "FileAlreadyExistsException" not in problem.java_exception.getClass().getName():
                raise
            return False
        return True

    # ---- writing ----

    def _bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(*self.tables[table].key), F.lit(self.buckets)).cast("int")

    def _written(self, table: str, rows: DataFrame, kind: str, buckets: Iterable[int] | None = None) -> dict | None:
        """Write rows by bucket and describe them for a commit; nothing to describe where there are no rows."""
        fields = [f.name for f in self.tables[table].schema.fields]
        marks = [DELETED] if DELETED in rows.columns else []
        folder = f"{self.root}/data/{table}-{kind}-{uuid.uuid4().hex}"
        placed = rows.select(*fields, *marks).withColumn(_BUCKET, self._bucket(table))
        salt = F.pmod(F.xxhash64(F.lit(7), *self.tables[table].key), F.lit(self.spread))
        placed.repartition(_BUCKET, salt).write.mode("errorifexists").partitionBy(_BUCKET).parquet(folder)
        if buckets is None:
            # At most as many numbers as there are buckets, read from folder names.
            held = self._read(table, folder).select(_BUCKET).distinct().collect()
            buckets = sorted(r[0] for r in held)
            if not buckets:
                return None
        return {"table": table, "kind": kind, "folder": folder, "buckets": list(buckets)}

    def create(self, frames: dict[str, DataFrame], now: dt.datetime, job: str | None = None) -> int:
        """The first version, from whole tables."""
        if self.version():
            raise ValueError(f"A state is there already: {self.root}")
        parts = [self._written(t, df, "base", range(self.buckets)) for t, df in frames.items()]
        if not self._commit(1, job, now, parts):
            raise Contended(f"Another writer created the state: {self.root}")
        return 1

    def update(self, change: Change, now: dt.datetime, job: str | None = None, tries: int = 20) -> int:
        """Apply a change and return the version that holds it.

        ``change`` gets a reader of the tables as they are and returns, per table, the whole rows to put in place of
        those with their key (a true ``_deleted`` takes the key away), each key once. It is asked again whenever another
        writer was first. A job that was committed before is left as it is.
        """
        for _ in range(tries):
            commits = self.commits()
            done = [c["version"] for c in commits if job is not None and c["job"] == job]
            if done:
                return done[0]
            at = max((c["version"] for c in commits), default=0)
            changed = change(lambda table, keys=None, at=at: (
                self.read(table, at) if keys is None else self.read_keys(table, keys, at)))
            parts = [p for p in (self._written(t, df, "delta") for t, df in changed.items()) if p]
            if self._commit(at + 1, job, now, parts):
                return at + 1
        raise Contended(f"{tries} tries lost: {self.root}")

    def compact(self, now: dt.datetime, tables: Sequence[str] | None = None, tries: int = 20) -> int:
        """Rewrite the buckets that deltas touch, so that reading them needs no merge."""
        for _ in range(tries):
            commits = self.commits()
            at = max((c["version"] for c in commits), default=0)
            touched = {t: self._layout(t, at).touched for t in tables or self.tables}
            parts = [
                self._written(t, self._merged(t, at, buckets), "base", buckets) for t, buckets in touched.items() if buckets]
            if not parts:
                return at
            if self._commit(at + 1, None, now, parts):
                return at + 1
        raise Contended(f"{tries} tries lost: {self.root}")

    # ---- reading ----

    def _layout(self, table: str, version: int) -> _Layout:
        home: dict[int, tuple[int, str]] = {}
        deltas: list[tuple[int, str, list[int]]] = []
        for commit in self.commits():
            if commit["version"] > version:
                break
            for part in commit["parts"]:
                if part["table"] == table and part["kind"] == "base":
                    home.update((b, (commit["version"], part["folder"])) for b in part["buckets"])
                elif part["table"] == table:
                    deltas.append((commit["version"], part["folder"], part["buckets"]))
        bases: dict[str, list[int]] = {}
        for bucket, (_, folder) in sorted(home.items()):
            bases.setdefault(folder, []).append(bucket)
        newer = [(v, f, [b for b in buckets if v > home.get(b, (0, ""))[0]]) for v, f, buckets in deltas]
        return _Layout(bases, [d for d in newer if d[2]])

    def _read(self, table: str, folder: str) -> DataFrame:
        kind = T.StructType([*self.tables[table].schema.fields, T.StructField(DELETED, T.BooleanType()),
                             T.StructField(_BUCKET, T.IntegerType())])
        return self.spark.read.schema(kind).parquet(folder)

    def _merged(self, table: str, version: int, only: Sequence[int] | None = None) -> DataFrame:
        layout, own = self._layout(table, version), self.tables[table]
        names = [f.name for f in own.schema.fields]

        def some(buckets: Iterable[int]) -> list[int]:
            return sorted(set(buckets) if only is None else set(buckets) & set(only))

        def part(folder: str, buckets: list[int]) -> DataFrame:
            rows = self._read(table, folder)
            return rows if len(buckets) == self.buckets else rows.where(F.col(_BUCKET).isin(buckets))

        touched = some(layout.touched)
        calm, stirred, newer = [], [], []
        for folder, buckets in layout.bases.items():
            for group, held in ((calm, set(some(buckets)) - set(touched)), (stirred, set(some(buckets)) & set(touched))):
                if held:
                    group.append(part(folder, sorted(held)).select(*names))
        for at, folder, buckets in layout.deltas:
            if some(buckets):
                newer.append(part(folder, some(buckets)).select(*names, DELETED, F.lit(at).alias(_VERSION)))
        if newer:
            rest = [n for n in names if n not in own.key]
            last = _union(newer).groupBy(*own.key).agg(F.max_by(F.struct(*rest, DELETED), _VERSION).alias("_last"))
            if stirred:
                calm.append(_union(stirred).join(last.select(*own.key), list(own.key), "left_anti").select(*names))
            calm.append(last.where(f"NOT coalesce(_last.{DELETED}, false)").select(*own.key, "_last.*").select(*names))
        return _union(calm) if calm else self.spark.createDataFrame([], own.schema)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as it is, or was at a version."""
        return self._merged(table, self.version() if version is None else version)

    def read_keys(self, table: str, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows whose key is among ``keys``; other buckets' files are not opened."""
        own = self.tables[table]
        kinds = {f.name: f.dataType for f in own.schema.fields}
        wanted = keys.select(*[F.col(k).cast(kinds[k]).alias(k) for k in own.key]).distinct()
        held = wanted.select(self._bucket(table).alias(_BUCKET)).distinct().collect()
        rows = self._merged(table, self.version() if version is None else version, [r[0] for r in held])
        return rows.join(wanted, list(own.key), "left_semi")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def changed_rows(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``after`` that ``before`` does not hold as they are, each key once on either side."""
    names = after.columns
    held = before.select(*key, F.struct(*names).alias("_before"))
    return after.join(held, list(key), "left").where(~F.col("_before").eqNullSafe(F.struct(*names))).select(*names)
