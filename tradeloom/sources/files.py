"""Readers and writers. A missing input file is Spark's own PATH_NOT_FOUND error, never an empty table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradeloom.functions import blank_to_null
from tradeloom.functions.text import is_present

_RECORD = "__record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    delimiter: str = ",",
    date_format: str = "yyyy-MM-dd",
    na_text_is_null: bool = False,
    position: str | None = None,
    multi_line: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """CSV with a header line: columns by name, types from `schema`, a cell that does not fit is NULL.

    The header is read first (one line); columns beyond the schema are skipped by the parser.

    `multi_line` reads quoted line breaks as part of their cell, quotes in it doubled. It makes every file
    a single task, so it is off by default; a quoted line break then gives malformed records.

    `malformed` names a boolean column to add: the record has more or fewer cells than the header, or a
    cell that is neither missing (blank; with `na_text_is_null` any spelling of it) nor fits its type.

    `position` names a column to add that sorts rows as they stand in their file: the byte offset of
    the block a task read, then the order of reading within it.
    """
    reader = spark.read.option("header", True).option("sep", delimiter)
    wanted = {f.name.lower(): f for f in schema.fields}
    header = reader.csv(path).columns
    missing = wanted.keys() - {name.lower() for name in header}
    if missing:
        raise ValueError(f"{path} lacks the columns {sorted(missing)}")
    in_file = [wanted.get(name.lower(), StructField(name, StringType())) for name in header]
    if multi_line:
        reader = reader.option("multiLine", True).option("escape", '"')
    record = [StructField(_RECORD, StringType())] if malformed else []
    df = (
        reader.schema(StructType([*in_file, *record]))
        .option("dateFormat", date_format)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RECORD)
        .option("enforceSchema", False)
        .csv(path)
    )
    if malformed:
        df = df.withColumn(malformed, _is_malformed(in_file, delimiter, multi_line, na_text_is_null))
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")
    )
    added = [*([place.alias(position)] if position else []), *([malformed] if malformed else [])]
    df = df.select(*schema.names, *added)
    return blank_to_null(df) if na_text_is_null else df


def _is_malformed(fields: list[StructField], delimiter: str, multi_line: bool, na_text_is_null: bool) -> Column:
    """Does a record that the parser found fault with have a fault other than a missing cell?

    Such a record is parsed again into texts; Spark reports no fault for most records, so this is rare.
    """
    cells = ", ".join(f"c{i} STRING" for i in range(len(fields)))
    options = {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD}
    if multi_line:
        options |= {"multiLine": "true", "escape": '"'}
    texts = F.from_csv(F.col(_RECORD), f"{cells}, {_RECORD} STRING", options)
    fault = texts[_RECORD].isNotNull()
    for i, field in enumerate(fields):
        text = texts[f"c{i}"]
        present = is_present(text) if na_text_is_null else text != ""
        fault |= F.coalesce(present, F.lit(False)) & F.col(field.name).isNull()
    return F.col(_RECORD).isNotNull() & F.coalesce(fault, F.lit(True))


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A document collection, one JSON document per line; fields a document lacks are NULL."""
    return spark.read.schema(schema).json(path)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows. Known to be empty when a plan is optimised, so joins with it vanish."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet dataset, or no rows if nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def replace_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def remove_dataset(spark: SparkSession, path: str) -> None:
    """Remove a dataset that a job itself has written, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_report(df: DataFrame, path: str) -> None:
    """A report as a directory of CSV parts with a header; the row order of `df` is kept."""
    df.write.mode("overwrite").option("header", True).csv(path)
