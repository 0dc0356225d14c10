"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Folders that :func:`stable_table` made since the innermost :func:`scratch` began; none outside of one.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def build_session(app: str = "verbascope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; cluster sizing stays with the submitter."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names; a temp folder only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="verbascope-")
    context.setCheckpointDir(named)


def stable_copy(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, so that a lost executor cannot change it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stable_table(df: DataFrame, *by: str) -> DataFrame:
    """The same for wide tables that are read several times by few columns, or by the values of ``by``: written as parquet."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``, on whichever file system it names?"""
    files, place = _file_system(spark, path)
    return files.exists(place)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Is ``path`` a folder? False for files, for patterns and for what is not there."""
    files, place = _file_system(spark, path)
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all it holds; nothing happens if there is none."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end, also after a failure, the tables that :func:`stable_table` made meanwhile.

    For jobs that write their result: a frame that still reads such a table cannot be used afterwards.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            remove_folder(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers; needed only for jobs that run a model.

    The archive is made beside the driver and handed out by Spark.
    """
    if not getattr(spark.sparkContext, "_verbascope_shipped", False):
        package = Path(__file__).parent
        archive = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="verbascope-")) / package.name), "zip", package.parent, package.name
        )
        spark.sparkContext.addPyFile(archive)
        spark.sparkContext._verbascope_shipped = True
