"""The batch jobs: the warehouse load and the daily reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tradeloom import schemas
from tradeloom.operators.checks import duplicate_keys, missing_parents, null_counts, report_status
from tradeloom.operators.dimensions import (
    Locations,
    distinct_places,
    missing_unknown_members,
    new_locations,
    new_members,
)
from tradeloom.plans import reports, warehouse
from tradeloom.sources import key_index
from tradeloom.sources.catalog import register_views
from tradeloom.sources.files import empty, read_csv, remove_dataset, replace_dataset, write_report
from tradeloom.sources.snapshots import (
    Snapshot,
    Staged,
    compact,
    discard,
    latest_snapshot,
    publish_on_latest,
    read_folders,
    stage_rows,
)

FILE_POSITION, MALFORMED = "file_position", "malformed"

DIMENSION_TABLES = {
    "countries": schemas.COUNTRIES,
    "states": schemas.STATES,
    "postcodes": schemas.POSTCODES,
    "members": schemas.MEMBERS,
}
FACT_TABLES = {
    "products": schemas.DIM_PRODUCTS,
    "customers": schemas.DIM_CUSTOMERS,
    "transactions": schemas.TRANSACTIONS,
}
_STORED_TRANSACTIONS = StructType([*schemas.TRANSACTIONS.fields, StructField("month", DateType())])
#: What no two rows of a table share. Loads at the same time must not add equal ones.
KEYS = {
    "countries": (("id",), ("country_name",)),
    "states": (("id",), ("state_name", "country_id")),
    "postcodes": (("postcode",),),
    "members": (("dimension", "id"), ("dimension", "name")),
    "products": (("product_id",),),
    "customers": (("customer_id",),),
    "transactions": (("transaction_id",),),
}
#: Transactions lie in folders by the month of their date, so that reports over some months read no others.
MONTH = "month"
#: Beside each fact table lie its keys by bucket, which later loads are matched with.
INDEXES = {table: f"{table}_keys" for table in FACT_TABLES}


class LoadRejected(Exception):
    """New rows break an integrity rule; nothing of the batch was published."""


class InputRejected(Exception):
    """Input files have malformed records; no table was changed."""


class ReportsRejected(Exception):
    """At least one report is empty or cannot be read."""


@dataclass(frozen=True)
class LoadResult:
    batch: int
    dropped_orphans: int


# --- warehouse load -------------------------------------------------------------------------------


def open_warehouse(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All tables of the latest snapshot by name; the simple dimensions as tables of their own."""
    return _warehouse_tables(spark, latest_snapshot(spark, base))


def _warehouse_tables(spark: SparkSession, snapshot: Snapshot) -> dict[str, DataFrame]:
    tables = {n: snapshot.read(spark, n, s) for n, s in (DIMENSION_TABLES | FACT_TABLES).items()}
    return tables | {name: warehouse.dimension(tables["members"], name) for name in warehouse.NAME_COLUMNS}


def transactions_by_month(spark: SparkSession, base: str) -> DataFrame:
    """The transactions with the first day of their month in column `month`. A filter on it, or a join with
    a filtered table of months, reads the folders of these months alone."""
    return latest_snapshot(spark, base).read(spark, "transactions", _STORED_TRANSACTIONS)


def wide_report(spark: SparkSession, base: str, first: date, last: date) -> DataFrame:
    """The re-denormalised transactions from `first` to `last`, reading no other months."""
    snapshot = latest_snapshot(spark, base)
    tables = _warehouse_tables(spark, snapshot)
    stored = snapshot.read(spark, "transactions", _STORED_TRANSACTIONS)
    months = F.col(MONTH).between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)))
    rows = stored.filter(months & F.col("transaction_date").between(F.lit(first), F.lit(last))).drop(MONTH)
    return warehouse.wide_transactions(rows, tables["products"], tables["members"])


def _stage_by_month(df: DataFrame, base: str) -> str:
    """Write transactions the way they are laid out."""
    return stage_rows(df.withColumn(MONTH, F.trunc("transaction_date", "month")), base, "transactions", [MONTH])


def load_warehouse(
    spark: SparkSession,
    customer_csv: str,
    transaction_csv: str,
    base: str,
    multi_line: bool = False,
    key_buckets: int = key_index.BUCKETS,
) -> LoadResult:
    """Add what is new in the two files. Running it again on the same files adds nothing.

    A file with malformed records is refused before anything is published; see `read_csv` for these and
    for `multi_line`.

    `base` must be storage all executors share. Dimensions are published first; the three fact tables
    follow together or not at all. Loads may run at the same time: one that comes second is computed anew
    if the first has added any of its keys (see `snapshots`).
    """
    landing = _landing(base)
    files = {
        "customers": read_csv(
            spark, customer_csv, schemas.RAW_CUSTOMER, na_text_is_null=True, multi_line=multi_line, malformed=MALFORMED
        ),
        "transactions": read_csv(
            spark, transaction_csv, schemas.RAW_TRANSACTION, na_text_is_null=True, position=FILE_POSITION,
            multi_line=multi_line, malformed=MALFORMED,
        ),
    }
    try:
        raw = _landed(files, landing)
        load_dimensions(spark, raw["customers"], raw["transactions"], base)
        return load_facts(spark, raw["customers"], raw["transactions"], base, key_buckets)
    finally:
        remove_dataset(spark, landing)


def _landing(base: str) -> str:
    """A folder for the files of one load."""
    return f"{base}/_landing/{uuid.uuid4().hex}"


def _landed(files: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The parsed files in columns. Text is parsed once; later steps read only the columns they need.

    Malformed records are counted in the pass that writes. Any of them rejects the whole input.
    """
    landed, broken = {}, []
    for name, df in files.items():
        seen = Observation(name)
        counted = df.observe(seen, F.count_if(MALFORMED).alias("n")).drop(MALFORMED)
        replace_dataset(counted, f"{folder}/{name}")
        if seen.get["n"]:
            broken.append(f"{name}: {seen.get['n']} malformed records")
        landed[name] = df.sparkSession.read.schema(counted.schema).parquet(f"{folder}/{name}")
    if broken:
        raise InputRejected("; ".join(broken))
    return landed


def load_dimensions(
    spark: SparkSession, raw_customers: DataFrame, raw_transactions: DataFrame, base: str
) -> Snapshot:
    places = _landing(base)

    def stage(old: Snapshot) -> Staged:
        tables = {n: old.read(spark, n, s) for n, s in DIMENSION_TABLES.items()}
        added: dict[str, list[str]] = {}

        def settle(df: DataFrame, table: str) -> DataFrame:
            return _staged(df, base, table, added)

        existing = Locations(tables["countries"], tables["states"], tables["postcodes"])
        new_locations(spark.read.parquet(places), existing, settle)
        found = warehouse.found_members(raw_customers, raw_transactions)
        fresh = new_members(found, tables["members"])
        unknown = missing_unknown_members(tables["members"], warehouse.PRODUCT_DIMENSIONS)
        settle(fresh.unionByName(unknown), "members")
        return Staged(added, load="dimensions")

    try:
        replace_dataset(distinct_places(raw_customers), places)
        return publish_on_latest(spark, base, stage, _adds_other_keys(spark))[0]
    finally:
        remove_dataset(spark, places)


def _staged(df: DataFrame, base: str, table: str, added: dict[str, list[str]]) -> DataFrame:
    """`df` written to a folder that `added` then names, and read back; without rows, nothing stays."""
    spark = df.sparkSession
    folder = stage_rows(df, base, table)
    rows = read_folders(spark, base, [folder], df.schema)
    if rows.isEmpty():
        remove_dataset(spark, f"{base}/{folder}")
        return empty(spark, df.schema)
    if table == "transactions":
        # A pass of its own: a shuffle behind the rows that are counted could drop the count with the rows.
        laid_out = _stage_by_month(rows, base)
        remove_dataset(spark, f"{base}/{folder}")
        folder, rows = laid_out, read_folders(spark, base, [laid_out], df.schema)
    added[table] = [*added.get(table, []), folder]
    return rows


def _adds_other_keys(spark: SparkSession) -> Callable[[Staged, Snapshot, Snapshot], bool]:
    """Are the keys of staged rows none of those that other loads have added meanwhile?"""

    def holds(staged: Staged, older: Snapshot, newer: Snapshot) -> bool:
        for table, folders in staged.added.items():
            if table in INDEXES.values():
                continue
            schema = (DIMENSION_TABLES | FACT_TABLES)[table]
            theirs = newer.since(older, table)
            if theirs is None:
                return False
            if not theirs:
                continue
            mine, others = (read_folders(spark, older.base, f, schema) for f in (folders, theirs))
            if not all(mine.join(others.select(*key), list(key), "left_semi").isEmpty() for key in KEYS[table]):
                return False
        return True

    return holds


def fact_keys(spark: SparkSession, snapshot: Snapshot, table: str) -> list[DataFrame]:
    """The keys of a fact table as they lie, a table for each load or compaction."""
    (key,) = KEYS[table]
    columns = ", ".join(f"{c} {FACT_TABLES[table][c].dataType.simpleString()}" for c in key)
    return key_index.read_keys(spark, snapshot.base, snapshot.folders.get(INDEXES[table], ()), columns, key)


def load_facts(
    spark: SparkSession,
    raw_customers: DataFrame,
    raw_transactions: DataFrame,
    base: str,
    key_buckets: int = key_index.BUCKETS,
) -> LoadResult:
    """New rows are told by the tables' key indexes: whatever the length of the history, it is not shuffled."""
    known, dropped = raw_customers.select("customer_id"), 0

    def stage(old: Snapshot) -> Staged:
        nonlocal dropped
        tables = _warehouse_tables(spark, old)
        members = tables["members"]
        there = {table: fact_keys(spark, old, table) for table in FACT_TABLES}
        orphans = Observation("transactions")
        new = {
            "products": warehouse.products(raw_transactions, members, there["products"], FILE_POSITION),
            "customers": warehouse.customers(raw_customers, members, there["customers"]),
            "transactions": warehouse.transactions(raw_transactions, known, members, there["transactions"], orphans),
        }
        added: dict[str, list[str]] = {}
        try:
            staged = {table: _staged(df, base, table, added) for table, df in new.items()}
            broken = [f"{rule}: {n}" for rule, n in fact_violations(staged, tables).items() if n]
            if broken:
                raise LoadRejected("; ".join(broken))
            for table in [t for t in FACT_TABLES if t in added]:
                name = INDEXES[table]
                added[name] = [key_index.stage_keys(staged[table], base, name, KEYS[table][0], key_buckets)]
        except BaseException:
            discard(spark, base, Staged(added))
            raise
        dropped = orphans.get["dropped"]
        return Staged(added, load="facts")

    snapshot, _ = publish_on_latest(spark, base, stage, _adds_other_keys(spark))
    return LoadResult(snapshot.loads["facts"], dropped)


def compact_warehouse(spark: SparkSession, base: str, key_buckets: int = key_index.BUCKETS) -> Snapshot:
    """Rewrite the folders of many loads as one per table, key indexes included; the rows stay the same."""

    def rewritten(table: str) -> Callable[[Snapshot], str]:
        (key,) = KEYS[table]

        def run(old: Snapshot) -> str:
            parts = fact_keys(spark, old, table)
            rows = parts[0]
            for more in parts[1:]:
                rows = rows.unionAll(more)
            return key_index.stage_keys(rows, base, INDEXES[table], key, key_buckets)

        return run

    def by_month(old: Snapshot) -> str:
        return _stage_by_month(old.read(spark, "transactions", schemas.TRANSACTIONS), base)

    own = {name: rewritten(table) for table, name in INDEXES.items()}
    return compact(spark, base, DIMENSION_TABLES | FACT_TABLES, {**own, "transactions": by_month})


def fact_violations(staged: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Number of violating keys or cells per rule, for the new rows only."""
    all_rows = {t: tables[t].unionByName(staged[t]) for t in staged}
    parents = {t: (all_rows[t], f"{t[:-1]}_id") for t in ("products", "customers")}
    parents |= {n: (tables[n], "id") for n in warehouse.NAME_COLUMNS}
    parents["postcodes"] = (tables["postcodes"], "postcode")

    unique = {"products": "product_id", "customers": "customer_id", "transactions": "transaction_id"}
    required = {
        "products": ["product_id", *(i for _, i in warehouse.PRODUCT_LINKS.values())],
        "customers": ["customer_id", "first_name", "wealth_segment_id", "deceased_indicator", "owns_car"],
        "transactions": [
            "transaction_id", "product_id", "customer_id", "transaction_date", "order_status_id"
        ],
    }
    references = [
        *(("products", id_column, name) for name, id_column in warehouse.PRODUCT_LINKS.values()),
        ("customers", "job_industry_category_id", "job_industries"),
        ("customers", "wealth_segment_id", "wealth_segments"),
        ("customers", "postcode", "postcodes"),
        ("transactions", "product_id", "products"),
        ("transactions", "customer_id", "customers"),
        ("transactions", "order_status_id", "order_statuses"),
    ]

    counts = [
        duplicate_keys(staged[t], [key]).agg(F.count("*").alias("n")).select(F.lit(f"{t}.{key} unique").alias("rule"), "n")
        for t, key in unique.items()
    ]
    counts += [
        null_counts(staged[t], columns).select(
            F.concat(F.lit(f"{t}."), "column_name", F.lit(" not null")).alias("rule"), F.col("n_nulls").alias("n")
        )
        for t, columns in required.items()
    ]
    counts += [
        missing_parents(staged[t], column, *parents[parent])
        .agg(F.count("*").alias("n"))
        .select(F.lit(f"{t}.{column} in {parent}").alias("rule"), "n")
        for t, column, parent in references
    ]
    # One small row per rule and column; this is all that reaches the driver.
    combined = counts[0]
    for more in counts[1:]:
        combined = combined.unionByName(more)
    return {row["rule"]: row["n"] for row in combined.collect()}


# --- daily reports --------------------------------------------------------------------------------

SHOP_FILES = {
    "customer": (schemas.CUSTOMER, ";"),
    "product": (schemas.PRODUCT, ","),
    "orders": (schemas.ORDERS, ","),
    "order_items": (schemas.ORDER_ITEMS, ","),
}


def open_shop(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The four shop tables as of one refresh."""
    return _shop_tables(spark, latest_snapshot(spark, base))


def _shop_tables(spark: SparkSession, snapshot: Snapshot) -> dict[str, DataFrame]:
    return {name: snapshot.read(spark, name, schema) for name, (schema, _) in SHOP_FILES.items()}


def refresh_shop(
    spark: SparkSession, source: str, base: str, multi_line: bool = False
) -> dict[str, DataFrame]:
    """Replace the four shop tables by the files in `source`; nothing of their old content stays.

    All four change at once, after all files are read and found free of malformed records; a refresh that
    fails anywhere changes nothing. Readers keep the tables they have opened: the folders of an earlier
    refresh stay until `snapshots.remove_old_snapshots`. Of several refreshes at once the last one stays.
    """
    files = {
        name: read_csv(
            spark, f"{source}/{name}.csv", schema, delimiter, na_text_is_null=True, multi_line=multi_line,
            malformed=MALFORMED,
        )
        for name, (schema, delimiter) in SHOP_FILES.items()
    }
    added: dict[str, list[str]] = {}
    try:
        broken = []
        for name, df in files.items():
            seen = Observation(name)
            counted = df.observe(seen, F.count_if(MALFORMED).alias("n")).drop(MALFORMED)
            added[name] = [stage_rows(counted, base, name)]
            if seen.get["n"]:
                broken.append(f"{name}: {seen.get['n']} malformed records")
        if broken:
            raise InputRejected("; ".join(broken))
        staged = Staged(added, frozenset(added), load="refresh")
        snapshot, _ = publish_on_latest(spark, base, lambda _: staged, lambda *_: True)
    except BaseException:
        discard(spark, base, Staged(added))
        raise
    return _shop_tables(spark, snapshot)


def write_reports(tables: Mapping[str, DataFrame], target: str) -> dict[str, str]:
    shop = (tables["customer"], tables["orders"], tables["order_items"])
    paths = {name: f"{target}/{name}" for name in ("report_min_max", "report_wealth")}
    write_report(reports.min_max_customers(*shop), paths["report_min_max"])
    write_report(reports.top_by_wealth(*shop), paths["report_wealth"])
    return paths


def check_reports(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, int]:
    """Rows per report. Names every empty or unreadable report before it fails.

    Lines are read as they are, header included, so that one report's damage is met in its own count.
    """
    rows, problems = {}, []
    for name, path in paths.items():
        try:
            report = spark.read.option("header", True).schema("line string").csv(path, enforceSchema=True)
            status = report_status({name: report}).first()
        except (PySparkException, Py4JJavaError) as error:
            condition = error.getCondition() if isinstance(error, PySparkException) else None
            problems.append(f"{name} ({condition or 'unreadable'})")
            continue
        rows[name] = status["n_rows"]
        if not status["ok"]:
            problems.append(f"{name} (empty)")
    if problems:
        raise ReportsRejected(", ".join(sorted(problems)))
    return rows


def run_daily(spark: SparkSession, source: str, base: str, target: str) -> dict[str, int]:
    """Refresh the tables, write both reports, check them. Stops at the first step that fails."""
    tables = refresh_shop(spark, source, base)
    register_views(tables)
    return check_reports(spark, write_reports(tables, target))
