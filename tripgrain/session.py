"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "tripgrain", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings these jobs are tested with; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, which has no other machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tripgrain-")
        context.setCheckpointDir(folder)
    return folder


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside, for jobs that have stored their results by the end."""
    token = _made.set([])
    try:
        yield
    finally:
        for path in _made.get() or []:
            remove(spark, path)
        _made.reset(token)


def freeze(df: DataFrame) -> DataFrame:
    """Store ``df`` below the shared folder and read it back: lineage is cut and the size is known."""
    path = scratch_path(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
