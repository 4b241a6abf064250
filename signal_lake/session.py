"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_fallback_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


def build_session(app: str = "signal_lake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on: UTC and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Without a recorded call site per column expression, plans of many expressions build in half the time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a new folder of its own.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _fallback_dirs.setdefault(context.applicationId, tempfile.mkdtemp(prefix="signal_lake-"))


@contextmanager
def staged_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete what is staged inside once the block ends; its results must be written by then.

    Outside any scope staged tables stay, since a returned DataFrame may still read them.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    The table cuts the lineage at a durable, columnar point: a lost executor costs a re-read, and
    each later step reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

