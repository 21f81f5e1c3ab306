"""Spark session and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The folder of the innermost scope.
_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def build_session(app: str, **settings: str) -> SparkSession:
    """Session with the settings the jobs rely on; the cluster's own settings come from submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store it is; nothing happens if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)  # Spark's own functions remove nothing
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.conf.get("spark.master").startswith("local"):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch folders made inside are removed at the end, when what was computed has been written.

    A DataFrame that was planned inside but is run after the end finds its files gone.
    """
    folder = f"{_base(spark)}/topicloom-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        remove(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder, in the scope if there is one.

    Without that setting a local session takes a folder below its warehouse; a cluster needs the setting.
    """
    scope = _SCOPE.get()
    folder = f"{scope}/{uuid.uuid4().hex}" if scope else f"{_base(spark)}/topicloom-{uuid.uuid4().hex}"
    return f"{folder}/{name}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared scratch folder and read back, see ``saved_at``."""
    return saved_at(df, scratch_path(df.sparkSession, name))


def saved_at(df: DataFrame, path: str) -> DataFrame:
    """The rows written once to ``path`` and read back.

    What follows reads files, so it neither runs the plan again nor depends on any executor, and the write's
    own shuffle files are removed when it ends. Zstandard makes sums and counts about half as large as
    Spark's default does.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
