"""Keys of a long history, laid out so that a load can be matched with them without shuffling them.

Each load stores the keys it adds in files by hash bucket, as Spark's bucketed tables do. Matching new rows
shuffles these alone, into the same buckets, and reads each bucket of the history in the task that needs
it (`matching.new_rows` with the tables of `read_keys`); that holds whatever the size of either side, for a
history of several such folders as well.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 200


def stage_keys(df: DataFrame, base: str, table: str, keys: Sequence[str], buckets: int = BUCKETS) -> str:
    """Write the `keys` of `df` by bucket to a folder of their own; its name below `base`."""
    folder = f"{table}/batch={uuid.uuid4().hex}x{buckets}"
    path = f"{base}/{folder}"
    rows = df.select(*keys).repartition(buckets, *keys)
    name = _table_name(path)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return folder


def _table_name(path: str) -> str:
    """The catalog only has to know how a folder is divided; its entry can be lost and made again."""
    return f"key_index_{hashlib.md5(path.encode()).hexdigest()}"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def read_keys(spark: SparkSession, base: str, folders: Sequence[str], columns: str, keys: Sequence[str]) -> list[DataFrame]:
    """The tables of some folders written by `stage_keys`; `columns` is the keys' schema as text."""
    found = []
    for folder in folders:
        path, buckets = f"{base}/{folder}", int(folder.rsplit("x", 1)[1])
        name, by = _table_name(path), ", ".join(keys)
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION {_quoted(path)}"
            )
        found.append(spark.table(name))
    return found


def forget_keys(spark: SparkSession, base: str, folders: Sequence[str]) -> None:
    """Take folders out of the session's catalog; their files stay."""
    for folder in folders:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{base}/{folder}')}")
