"""Revenue, summed up the key hierarchy: items to orders to customers.

Every level is aggregated before the next join. The joins then see one row per key on the side that
was aggregated, and an order or customer that owns a large part of all items has been reduced to one
partial row per map task before anything is shuffled. Customer attributes are joined last, onto one
row per customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.constants import APPROVED
from tradeloom.functions import summed_product

CUSTOMER_NAMES = ("customer_id", "first_name", "last_name")


def approved(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == APPROVED)


def order_amounts(items: DataFrame) -> DataFrame:
    """(order_id, amount): what the items of an order add up to."""
    amount = summed_product(items, "quantity", "item_list_price_at_sale")
    return items.groupBy("order_id").agg(amount.alias("amount"))


def order_values(orders: DataFrame, items: DataFrame) -> DataFrame:
    """(customer_id, order_id, order_value) of the orders that have items.

    Both sides arrive partitioned by order id, so the grouping after the join needs no shuffle.
    """
    return (
        orders.select("order_id", "customer_id")
        .join(order_amounts(items), "order_id")
        .groupBy("customer_id", "order_id")
        .agg(F.sum("amount").alias("order_value"))
    )


def customer_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """(customer_id, revenue) of the customers with items in `orders`."""
    return (
        orders.select("order_id", "customer_id")
        .join(order_amounts(items), "order_id")
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("revenue"))
    )


def named_customer_revenue(
    customer: DataFrame, orders: DataFrame, items: DataFrame, *attributes: str, how: str = "inner"
) -> DataFrame:
    """Revenue with customer attributes; `how="left"` keeps customers without any.

    Grouping again after the join makes a customer listed twice count as one; it reuses the join's
    partitioning.
    """
    columns = [*CUSTOMER_NAMES, *attributes]
    return (
        customer.select(*columns)
        .join(customer_revenue(orders, items), "customer_id", how)
        .groupBy(*columns)
        .agg(F.sum("revenue").alias("revenue"))
    )
