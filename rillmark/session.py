"""Session settings, table loading and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCHEMAS: dict[tuple[str, int], object] = {}
_LOCAL_SCRATCH: dict[str, str] = {}


def session(app: str = "rillmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here relies on: UTC, ANSI errors and AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; the schema is read from the file footer again when the table has changed."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = (path, changed_at(spark, path))
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name for intermediate tables and checkpoints, visible to all executors.

    The base is the cluster's ``spark.checkpoint.dir``.  Only a session on a ``local`` master may
    fall back to a temporary folder, because there the driver and the tasks share one machine.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        if context.applicationId not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="rillmark-")
        base = _LOCAL_SCRATCH[context.applicationId]
    return os.path.join(base, "rillmark", f"{purpose}-{uuid.uuid4().hex}")


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder (not a file) of that name exists on its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).isDirectory(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file or folder last changed, in milliseconds."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getModificationTime()


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame, the same figure the automatic broadcast check uses."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


_MULTIPLYING = re.compile(r"(?m)^[\s:+|-]*(?:\w+ )?(Generate|Join|Expand|MapIn\w+|FlatMap\w+|\w*UDTF)\b")


def multiplies_rows(df: DataFrame) -> bool:
    """Whether a plan has a step (join, explode, user code) after which its size estimate says nothing."""
    return bool(_MULTIPLYING.search(df._jdf.queryExecution().optimizedPlan().toString()))
