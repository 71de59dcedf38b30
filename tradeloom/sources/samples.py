"""The order, part and customer sample tables seen as shop, booking and document tables.

Columns that the sample tables lack are derived from those they have; NULLs, bad dates, text prices
and three-valued flags are put in on purpose, on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Looking up the schema of a file is a Spark job of its own; once per file is enough.
_schemas: dict[str, StructType] = {}


def sample(spark: SparkSession, folder: str, table: str) -> DataFrame:
    path = f"{folder}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _customers_with_place(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = sample(spark, folder, "nation"), sample(spark, folder, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = sample(spark, folder, "customer")
    return customer.join(place, customer.c_nationkey == place.n_nationkey)


def shop_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _customers_with_place(spark, folder).selectExpr(
        "c_custkey AS customer_id",
        "c_name AS first_name",
        "n_name AS last_name",
        "CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'F' WHEN 3 THEN 'M' ELSE 'U' END AS gender",
        "CASE WHEN c_custkey % 17 <> 0 "
        "THEN date_add(DATE '1950-01-01', CAST((c_custkey * 37) % 18000 AS INT)) END AS dob",
        "CASE c_custkey % 4 WHEN 0 THEN 'Senior Analyst' WHEN 1 THEN 'Lead Engineer' "
        "WHEN 2 THEN 'Junior Analyst' END AS job_title",
        "CASE c_mktsegment WHEN 'MACHINERY' THEN 'IT' WHEN 'BUILDING' THEN 'Financial Services' "
        "WHEN 'HOUSEHOLD' THEN 'Health' WHEN 'FURNITURE' THEN 'n/a' END AS job_industry_category",
        "CASE c_custkey % 3 WHEN 0 THEN 'Mass Customer' WHEN 1 THEN 'High Net Worth' "
        "ELSE 'Affluent Customer' END AS wealth_segment",
        "CASE WHEN c_custkey % 11 = 0 THEN 'Y' ELSE 'N' END AS deceased_indicator",
        "CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS owns_car",
        "concat(c_nationkey, ' Market Street') AS address",
        "CAST(4000 + c_nationkey * 10 + c_custkey % 10 AS STRING) AS postcode",
        "n_name AS state",
        "r_name AS country",
        "CAST(floor(c_acctbal / 1000) AS INT) + 2 AS property_valuation",
    )


def shop_product(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_partkey % 101 <> 0 THEN p_brand END AS brand",
        "CASE p_type WHEN 'PROMO' THEN 'Road' WHEN 'STANDARD' THEN 'Standard' WHEN 'MEDIUM' THEN 'Mountain' "
        "ELSE 'Touring' END AS product_line",
        "CASE WHEN p_size <= 15 THEN 'low' WHEN p_size <= 35 THEN 'medium' ELSE 'high' END AS product_class",
        "CAST(p_size AS STRING) AS product_size",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS list_price",
        "CAST(p_retailprice * 0.8D AS DECIMAL(10,2)) AS standard_cost",
    )


def shop_orders(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN TRUE "
        "WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN FALSE END AS online_order",
        "CASE WHEN o_orderstatus = 'F' THEN 'Approved' ELSE 'Cancelled' END AS order_status",
    )


def shop_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS order_item_id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS item_list_price_at_sale",
        "CAST(l_extendedprice * 0.75D AS DECIMAL(10,2)) AS item_standard_cost_at_sale",
    )


def bookings(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS ID",
        "CAST(o_orderkey % 3 + 1 AS INT) AS n_adults",
        "CAST(o_orderkey % 2 AS INT) AS n_children",
        "CAST(o_orderkey % 3 AS INT) AS weekend_nights",
        "CAST(o_orderkey % 5 AS INT) AS week_nights",
        "concat('Meal Plan ', o_orderkey % 4) AS meal_plan",
        "CAST(o_orderkey % 9 = 0 AS INT) AS car_parking_space",
        "concat('Room_Type ', o_orderkey % 7 + 1) AS room_type",
        "CAST(o_orderkey % 300 AS INT) AS lead_time",
        "year(o_orderdate) AS year",
        "month(o_orderdate) AS month",
        "CASE WHEN o_orderkey % 97 = 0 THEN 31 ELSE day(o_orderdate) END AS date",
        "o_orderpriority AS market_segment",
        "CAST(o_custkey % 10 = 0 AS INT) AS repeated_guest",
        "CAST(o_orderkey % 13 DIV 12 AS INT) AS previous_cancellations",
        "CAST(o_orderkey % 6 AS INT) AS previous_bookings_not_canceled",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS avg_room_price",
        "CAST(o_orderkey % 4 AS INT) AS special_requests",
        "CASE WHEN o_orderstatus = 'P' THEN 'Canceled' ELSE 'Not_Canceled' END AS status",
    )


def theaters(spark: SparkSession, folder: str) -> DataFrame:
    """Nested documents: one per customer, the address two levels down."""
    return _customers_with_place(spark, folder).selectExpr(
        "CAST(c_custkey AS STRING) AS _id",
        "c_custkey AS theater_id",
        "named_struct('address', named_struct('street', concat(c_custkey, ' Main Street'), 'city', n_name, "
        "'state', r_name, 'zipcode', CAST(10000 + c_nationkey AS STRING))) AS location",
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with an array; every 13th lacks the title, every 7th size the year, some the genres."""
    return sample(spark, folder, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS _id",
        "CASE WHEN p_partkey % 13 <> 0 THEN p_name END AS title",
        "CASE WHEN p_size % 7 <> 0 THEN p_size + 1900 END AS year",
        "CASE WHEN p_partkey % 19 = 0 THEN CAST(array() AS ARRAY<STRING>) WHEN p_partkey % 23 <> 0 THEN "
        "transform(split(p_name, ' '), (word, i) -> CASE WHEN i > 0 THEN word WHEN word = 'red' THEN 'Horror' "
        "WHEN word = 'blue' THEN 'Film-Noir' WHEN word = 'hot' THEN 'Drama' ELSE word END) END AS genres",
    )


def movie_comments(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS _id",
        "CAST(l_partkey AS STRING) AS movie_id",
        "concat('Customer ', l_orderkey % 100) AS name",
        "CAST(l_shipdate AS DATE) AS date",
    )


def text_comments(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "documents").selectExpr("doc_id AS _id", "source AS name", "text")


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The customer file as it arrives: text dates, several spellings, missing values as text.

    Two spellings of one state, one state name in two countries, postcodes shared by two states.
    """
    return shop_customer(spark, folder).selectExpr(
        "customer_id",
        "first_name",
        "last_name",
        "CASE customer_id % 6 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'F' WHEN 3 THEN 'U' "
        "WHEN 4 THEN 'M' ELSE 'Femal' END AS gender",
        "CASE WHEN customer_id % 19 = 0 THEN 'unknown' ELSE date_format(dob, 'yyyy-MM-dd') END AS DOB",
        "job_title",
        "CASE WHEN job_industry_category IS NULL AND customer_id % 2 = 0 THEN 'N/A' "
        "ELSE job_industry_category END AS job_industry_category",
        "wealth_segment",
        "CASE WHEN customer_id % 29 <> 0 THEN deceased_indicator END AS deceased_indicator",
        "CASE WHEN customer_id % 31 <> 0 THEN owns_car END AS owns_car",
        "address",
        "CAST(4000 + CAST(split_part(last_name, '_', 2) AS INT) DIV 2 * 10 + customer_id % 10 AS STRING) "
        "AS postcode",
        "CASE state WHEN 'NATION_1' THEN 'VIC' WHEN 'NATION_6' THEN 'Victoria' "
        "WHEN 'NATION_2' THEN 'New South Wales' WHEN 'NATION_7' THEN 'NSW' "
        "WHEN 'NATION_3' THEN 'Border' WHEN 'NATION_4' THEN 'Border' ELSE state END AS state",
        "country",
        "CAST(property_valuation AS SMALLINT) AS property_valuation",
    )


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The transaction file as it arrives: one row per order line, product attributes repeated."""
    # An id of its own for every line: order, line number and the whole numbers that tell lines apart.
    lines = sample(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "l_extendedprice AS price",
        "CAST(conv(substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15), 16, 10) AS BIGINT) "
        "AS transaction_id",
    )
    # Texts of orders and products are made before the joins, once for all their lines.
    orders = shop_orders(spark, folder).selectExpr(
        "order_id",
        "customer_id",
        "date_format(order_date, 'M/d/yyyy') AS transaction_date",
        "initcap(CAST(online_order AS STRING)) AS online_order",
        "order_status",
    )
    product = shop_product(spark, folder).selectExpr(
        "product_id",
        "brand",
        "product_line",
        "product_class",
        "product_size",
        "CASE WHEN brand IS NOT NULL THEN replace(CAST(standard_cost AS STRING), '.', ',') END AS standard_cost",
    )
    joined = lines.join(orders, "order_id").join(product, "product_id")
    return joined.selectExpr(
        "transaction_id",
        "product_id",
        "customer_id",
        "transaction_date",
        "online_order",
        "order_status",
        "brand",
        "product_line",
        "product_class",
        "product_size",
        "CASE WHEN transaction_id % 53 = 0 THEN 'abc' "
        "ELSE replace(CAST(CAST(price AS DECIMAL(10,2)) AS STRING), '.', ',') END AS list_price",
        "standard_cost",
    )
