"""From the wide customer and transaction files to normalised tables, and back to a wide report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tradeloom.constants import GENDER_CODES, GENDER_DEFAULT, UNKNOWN_ID, YES_NO_LETTER, YES_NO_WORD
from tradeloom.functions import decimal_from_text, map_values, strict_us_date, tolerant_date
from tradeloom.operators.checks import with_defaults
from tradeloom.operators.dimensions import distinct_members
from tradeloom.operators.matching import join_few, new_rows, reject_orphans, resolve_id
from tradeloom.operators.ranking import keep_first

# Dimension tables and the source columns they come from.
CUSTOMER_DIMENSIONS = {"job_industries": "job_industry_category", "wealth_segments": "wealth_segment"}
PRODUCT_DIMENSIONS = {
    "brands": "brand",
    "product_lines": "product_line",
    "product_classes": "product_class",
    "product_sizes": "product_size",
}
TRANSACTION_DIMENSIONS = {"order_statuses": "order_status", **PRODUCT_DIMENSIONS}
# Name column of each dimension when it is read as a table of its own.
NAME_COLUMNS = {
    "job_industries": "category_name",
    "wealth_segments": "segment_name",
    "order_statuses": "status_name",
    "brands": "brand_name",
    "product_lines": "line_name",
    "product_classes": "class_name",
    "product_sizes": "size_name",
}
# Product attribute -> (dimension, id column).
PRODUCT_LINKS = {
    "brand": ("brands", "brand_id"),
    "product_line": ("product_lines", "product_line_id"),
    "product_class": ("product_classes", "product_class_id"),
    "product_size": ("product_sizes", "product_size_id"),
}


def found_members(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """(dimension, name) of all seven simple dimensions, one scan of each file."""
    of_customers = distinct_members(customers, CUSTOMER_DIMENSIONS, without_na_text=["job_industries"])
    return of_customers.unionByName(distinct_members(transactions, TRANSACTION_DIMENSIONS))


def dimension(members: DataFrame, name: str) -> DataFrame:
    """One dimension as its own table (id, name column)."""
    return members.filter(F.col("dimension") == name).select("id", F.col("name").alias(NAME_COLUMNS[name]))


def _with_ids(df: DataFrame, members: DataFrame, links: Mapping[str, tuple[str, str]], default: int | None):
    for column, (name, id_column) in links.items():
        df = resolve_id(df, column, dimension(members, name), NAME_COLUMNS[name], id_column, default)
    return df


def products(
    transactions: DataFrame,
    members: DataFrame,
    existing: DataFrame | Sequence[DataFrame],
    sequence: str = "transaction_id",
) -> DataFrame:
    """New products: the first row per product in file order, told by `sequence`.

    A price that is no number is NULL, such a cost 0; attributes without a member get id 0.
    """
    columns = ["product_id", *PRODUCT_LINKS, "list_price", "standard_cost"]
    first = keep_first(transactions.select(sequence, *columns), ["product_id"], sequence).select(*columns)
    fresh = new_rows(first, existing, ["product_id"], transactions).withColumns(
        {
            "list_price": decimal_from_text(F.col("list_price")),
            "standard_cost": decimal_from_text(F.col("standard_cost")),
        }
    )
    resolved = _with_ids(fresh, members, PRODUCT_LINKS, UNKNOWN_ID)
    return with_defaults(resolved, {"standard_cost": 0}).select(
        "product_id", *(id_column for _, id_column in PRODUCT_LINKS.values()), "list_price", "standard_cost"
    )


def customers(raw: DataFrame, members: DataFrame, existing: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """New customers with codes normalised; an unmatched industry or segment leaves the id NULL."""
    cleaned = new_rows(raw, existing, ["customer_id"], raw).select(
        "customer_id",
        "first_name",
        "last_name",
        map_values(F.col("gender"), GENDER_CODES, GENDER_DEFAULT).alias("gender"),
        tolerant_date(F.col("DOB")).alias("dob"),
        "job_title",
        "job_industry_category",
        "wealth_segment",
        map_values(F.col("deceased_indicator"), YES_NO_LETTER, False).alias("deceased_indicator"),
        map_values(F.col("owns_car"), YES_NO_WORD, False).alias("owns_car"),
        "address",
        "postcode",
        "property_valuation",
    )
    links = {
        "job_industry_category": ("job_industries", "job_industry_category_id"),
        "wealth_segment": ("wealth_segments", "wealth_segment_id"),
    }
    return _with_ids(cleaned, members, links, None).select(
        "customer_id", "first_name", "last_name", "gender", "dob", "job_title",
        "job_industry_category_id", "wealth_segment_id", "deceased_indicator", "owns_car",
        "address", "postcode", "property_valuation",
    )


def transactions(
    raw: DataFrame,
    known_customers: DataFrame,
    members: DataFrame,
    existing: DataFrame | Sequence[DataFrame],
    seen: Observation | None = None,
) -> DataFrame:
    """New transactions of known customers; a date that cannot be read fails the load."""
    fresh = new_rows(raw, existing, ["transaction_id"], raw)
    cleaned = reject_orphans(fresh, known_customers, "customer_id", seen).select(
        "transaction_id",
        "product_id",
        "customer_id",
        strict_us_date(F.col("transaction_date")).alias("transaction_date"),
        F.col("online_order").try_cast("boolean").alias("online_order"),
        "order_status",
    )
    statuses = dimension(members, "order_statuses").select(
        F.col("id").alias("order_status_id"), F.col("status_name").alias("order_status")
    )
    return join_few(cleaned, statuses, "order_status", "transaction_id").select(
        "transaction_id", "product_id", "customer_id", "transaction_date", "online_order", "order_status_id"
    )


def wide_transactions(fact: DataFrame, product: DataFrame, members: DataFrame) -> DataFrame:
    """Transactions with status and product attributes by name; no transaction is ever lost.

    The attribute names are joined onto the products first, so the transactions meet two lookups
    instead of six.
    """
    named = product
    for attribute, (name, id_column) in PRODUCT_LINKS.items():
        lookup = dimension(members, name).select(
            F.col("id").alias(id_column), F.col(NAME_COLUMNS[name]).alias(attribute)
        )
        named = named.join(lookup, id_column, "left")
    named = named.select("product_id", *PRODUCT_LINKS, "list_price", "standard_cost")
    statuses = dimension(members, "order_statuses").select(
        F.col("id").alias("order_status_id"), F.col("status_name").alias("order_status")
    )
    return (
        join_few(fact, statuses, "order_status_id", "transaction_id")
        .join(named, "product_id", "left")
        .select(
            "transaction_id", "product_id", "customer_id", "transaction_date", "online_order", "order_status",
            *PRODUCT_LINKS, "list_price", "standard_cost",
        )
        .orderBy("transaction_id")
    )
