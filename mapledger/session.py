"""Session helpers: a local session for tests, and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "mapledger") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; one of our own only where it is unset."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="mapledger-checkpoint-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Freeze a result in reliable storage, so later steps all see the same rows
    and a lost executor never recomputes them differently."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind; else they stay until the driver collects its garbage.

    Only for plans that run once: a second run of the same frame would make them anew."""
    held = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, held)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of our own with all it holds, in whatever store it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python workers there can import it."""
    context = spark.sparkContext
    if getattr(context, "_mapledger_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="mapledger-ship-")) / "mapledger.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._mapledger_shipped = True
