"""Small intermediate tables that several later steps read.

Written out, such a table is computed once, survives the loss of executors, and has a size on disk
that Spark can hold against its broadcast threshold. The folder is the one the session names in
`spark.checkpoint.dir`, which all executors share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tradeloom.sources.files import replace_dataset

_SETTING = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not folder:
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return folder.rstrip("/")


def settle(df: DataFrame, label: str) -> DataFrame:
    """`df` written to a fresh folder and read back."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{label}-{uuid.uuid4().hex}"
    replace_dataset(df, path)
    return spark.read.schema(df.schema).parquet(path)
