"""Grouping and window questions about customers, products and orders.

NULL sorts as the largest value here: last in ascending order, first in descending order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import rounded_mean
from tradeloom.functions.numbers import mean_of_sums
from tradeloom.operators.ranking import nth_per_group, top_k, top_k_per_group
from tradeloom.plans.revenue import approved, named_customer_revenue, order_amounts, order_values

STATS = ("total_revenue", "max_order_value", "min_order_value", "orders_count", "avg_order_value")


def industry_distribution(customer: DataFrame) -> DataFrame:
    return (
        customer.filter(F.col("job_industry_category").isNotNull())
        .groupBy("job_industry_category")
        .agg(F.count("customer_id").alias("customer_cnt"))
        .orderBy(F.col("customer_cnt").desc(), F.col("job_industry_category").asc())
    )


def monthly_revenue(customer: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Approved revenue per year, month and industry; customers without an industry form a group.

    Summed per customer and month before the customer table is joined, so the join sees each customer
    at most once per month.
    """
    per_customer = (
        approved(orders)
        .select("order_id", "customer_id", "order_date")
        .join(order_amounts(items), "order_id")
        .groupBy(
            "customer_id",
            F.year("order_date").alias("report_year"),
            F.month("order_date").alias("report_month"),
        )
        .agg(F.sum("amount").alias("amount"))
    )
    keys = ["report_year", "report_month", "job_industry_category"]
    return (
        customer.select("customer_id", "job_industry_category")
        .join(per_customer, "customer_id")
        .groupBy(*keys)
        .agg(F.sum("amount").alias("total_revenue"))
        .orderBy(*(F.col(k).asc_nulls_last() for k in keys))
    )


def online_orders_by_product_group(
    customer: DataFrame,
    product: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    industry: str = "IT",
    attributes: tuple[str, ...] = ("brand",),
) -> DataFrame:
    """Distinct approved online orders of one industry's customers per brand, 0 for the other brands.

    The qualifying orders are narrowed down before the items are touched; the full list of brands
    comes from the product table alone.
    """
    buyers = customer.filter(F.col("job_industry_category") == industry).select("customer_id")
    qualifying = approved(orders).filter("online_order").join(buyers, "customer_id", "left_semi")
    products = product.filter(F.col("brand").isNotNull()).select("product_id", *attributes)
    counted = (
        items.select("order_id", "product_id")
        .join(qualifying.select("order_id"), "order_id", "left_semi")
        .join(products, "product_id")
        .groupBy(*attributes)
        .agg(F.count_distinct("order_id").alias("n"))
    )
    groups = products.select(*attributes).distinct()
    same_group = [groups[a].eqNullSafe(counted[a]) for a in attributes]
    return (
        groups.join(counted, same_group, "left")
        .select(*(groups[a] for a in attributes), F.coalesce("n", F.lit(0)).alias("it_online_order_cnt"))
        .orderBy(F.col("it_online_order_cnt").desc(), *(F.col(a).asc() for a in attributes))
    )


def order_stats_grouped(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Sum, maximum, minimum, number and mean of the approved order values of each customer."""
    values = order_values(approved(orders), items)
    stats = values.groupBy("customer_id").agg(
        F.sum("order_value").alias("total_revenue"),
        F.max("order_value").alias("max_order_value"),
        F.min("order_value").alias("min_order_value"),
        F.count("order_id").alias("orders_count"),
        rounded_mean(values, "order_value").alias("avg_order_value"),
    )
    return _by_revenue(stats)


def order_stats_windowed(orders: DataFrame, items: DataFrame, shares: int = 64) -> DataFrame:
    """The same statistics by whole-partition window functions.

    A window partition is one task's work, and one customer may own a third of all orders. Each
    customer's orders are therefore cut into up to `shares` shares and summed per share first; the
    window then combines at most `shares` rows per customer.
    """
    values = order_values(approved(orders), items)
    share = F.pmod(F.xxhash64("order_id"), F.lit(shares)).alias("share")
    shared = values.groupBy("customer_id", share).agg(
        F.sum("order_value").alias("total"),
        F.max("order_value").alias("largest"),
        F.min("order_value").alias("smallest"),
        F.count("order_id").alias("n"),
        F.count("order_value").alias("n_valued"),
    )
    whole = Window.partitionBy("customer_id")
    total = F.sum("total").over(whole)
    mean = mean_of_sums(total, F.sum("n_valued").over(whole), values.schema["order_value"].dataType)
    stats = shared.select(
        "customer_id",
        total.alias("total_revenue"),
        F.max("largest").over(whole).alias("max_order_value"),
        F.min("smallest").over(whole).alias("min_order_value"),
        F.sum("n").over(whole).alias("orders_count"),
        mean.alias("avg_order_value"),
    ).distinct()
    return _by_revenue(stats)


def _by_revenue(stats: DataFrame) -> DataFrame:
    return stats.select("customer_id", *STATS).orderBy(
        F.col("total_revenue").desc_nulls_first(), F.col("orders_count").desc(), F.col("customer_id").asc()
    )


def customer_totals(customer: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Approved revenue of every customer, 0 for those without any."""
    totals = named_customer_revenue(customer, approved(orders), items, how="left")
    return totals.withColumn("revenue", F.coalesce("revenue", F.lit(0).cast("decimal(10,2)")))


def top_and_bottom_customers(customer: DataFrame, orders: DataFrame, items: DataFrame, k: int = 3) -> DataFrame:
    """The `k` largest customer totals, then the `k` smallest."""
    totals = customer_totals(customer, orders, items)

    def block(label: str, order):
        picked = top_k(totals, [order, F.col("customer_id").asc()], k)
        return picked.select(
            F.lit(label).alias("type"), "first_name", "last_name", F.col("revenue").alias("total_amount")
        )

    return block("MAX", F.col("revenue").desc()).unionByName(block("MIN", F.col("revenue").asc()))


def second_orders(orders: DataFrame) -> DataFrame:
    """Every customer's second order by date, whatever its status."""
    by_date = [F.col("order_date").asc_nulls_last(), F.col("order_id").asc_nulls_last()]
    columns = ["order_id", "customer_id", "order_date", "order_status"]
    return nth_per_group(orders.select(*columns), ["customer_id"], by_date, 2)


def longest_order_gaps(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Longest pause in days between consecutive approved orders, for customers with two or more.

    Orders of one day are counted together first. A customer then has at most one row per calendar
    day in the window, however many orders, and two orders on one day are a pause of 0 days. Undated
    orders come last: they make a customer count as having a successor but add no length.
    """
    days = approved(orders).groupBy("customer_id", "order_date").agg(F.count("*").alias("n"))
    in_order = Window.partitionBy("customer_id").orderBy(F.col("order_date").asc_nulls_last())
    paused = days.withColumn("previous", F.lag("order_date").over(in_order))
    dated = F.col("order_date").isNotNull()
    pauses = (
        paused.groupBy("customer_id")
        .agg(
            F.max(F.datediff("order_date", "previous")).alias("between_days"),
            F.sum("n").alias("n_orders"),
            F.max(F.when(dated & (F.col("n") > 1), F.lit(0))).alias("within_day"),
            F.count("order_date").alias("n_days"),
        )
        .filter((F.col("n_orders") > 1) & (F.col("n_days") > 0))
        .select(
            "customer_id", F.coalesce("between_days", "within_day").alias("max_days_between_orders")
        )
    )
    named = ["customer_id", "first_name", "last_name", "job_title"]
    gap = "max_days_between_orders"
    return (
        customer.select(*named)
        .join(pauses, "customer_id")
        .groupBy(*named)
        .agg(F.max(gap).alias(gap))
        .orderBy(F.col(gap).desc_nulls_first(), F.col("customer_id").asc())
        .select("first_name", "last_name", "job_title", gap)
    )


def top_customers_per_segment(
    customer: DataFrame, orders: DataFrame, items: DataFrame, k: int = 5
) -> DataFrame:
    """The `k` customers with most approved revenue in each wealth segment."""
    revenue = named_customer_revenue(customer, approved(orders), items, "wealth_segment")
    best = top_k_per_group(
        revenue, ["wealth_segment"], [F.col("revenue").desc_nulls_first(), F.col("customer_id").asc()], k
    )
    return best.select(
        "first_name", "last_name", "wealth_segment", F.col("revenue").alias("total_revenue")
    ).orderBy(F.col("wealth_segment").asc_nulls_last(), F.col("total_revenue").desc_nulls_first())
