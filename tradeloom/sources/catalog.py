"""Views and tables of the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tradeloom.sources.files import remove_dataset


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def create_tables(spark: SparkSession, database: str, schemas: Mapping[str, StructType]) -> None:
    """Create the database and its tables where they do not exist; existing ones stay as they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def swap_table(df: DataFrame, name: str) -> None:
    """Put `df` in place of table `name`, which `df` may read.

    The rows are written to a folder of their own first. If the columns are those of the table, the catalog
    entry is then pointed at that folder in one step: a reader sees all old rows or all new ones, and a
    failure before leaves the table as it was. The folder before the last stays for readers that have
    opened it; the one before that is removed.

    Other columns need another entry: the old table is set aside under `<name>__before`, and put back if the
    new one cannot take its name.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").saveAsTable(name)
        return
    if [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in spark.table(name).schema]:
        here = _location(spark, name)
        first, _, version = here.partition(_VERSION)
        number = int(version or 0) + 1
        df.write.mode("overwrite").parquet(f"{first}{_VERSION}{number}")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{first}{_VERSION}{number}'")
        spark.catalog.refreshTable(name)
        if number > 1:
            remove_dataset(spark, f"{first}{_VERSION}{number - 2}" if number > 2 else first)
        return
    written, before = f"{name}__next", f"{name}__before"
    for left in (written, before):
        spark.sql(f"DROP TABLE IF EXISTS {left}")
    df.write.format("parquet").saveAsTable(written)
    spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    try:
        spark.sql(f"ALTER TABLE {written} RENAME TO {name}")
    except BaseException:
        spark.sql(f"ALTER TABLE {before} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {before}")


_VERSION = "__version_"


def _location(spark: SparkSession, name: str) -> str:
    """Where the table's files lie."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]
