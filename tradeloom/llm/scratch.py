"""Intermediate tables in the folder that all executors share.

A table that several steps read, or that a loop builds on, is written as Parquet under the session's
`spark.checkpoint.dir` and read back: it is computed once, its lineage ends there, and a lost executor
loses nothing of it. Steps drop the tables that nobody will read again.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="tradeloom-llm-")
        atexit.register(shutil.rmtree, _own[context.applicationId], ignore_errors=True)
    return _own[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete tables written by `save`, on whatever file system they lie."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def save(df: DataFrame, label: str, by: str | None = None) -> tuple[DataFrame, str]:
    """`df` written to a fresh folder, in one of its own per value of `by`, and read back; and the folder."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path), path
