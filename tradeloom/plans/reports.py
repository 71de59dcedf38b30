"""The two reports of the daily job. They differ from the shop questions in layout and NULL ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.ranking import top_k, top_k_per_group
from tradeloom.plans.revenue import approved, named_customer_revenue
from tradeloom.plans.shop_windows import customer_totals


def min_max_customers(customer: DataFrame, orders: DataFrame, items: DataFrame, k: int = 3) -> DataFrame:
    """The `k` smallest customer totals, then the `k` largest."""
    totals = customer_totals(customer, orders, items)

    def block(label: str, order):
        picked = top_k(totals, [order, F.col("customer_id").asc()], k)
        return picked.select("first_name", "last_name", F.col("revenue").alias("amount"), F.lit(label).alias("type"))

    return block(f"Min_{k}", F.col("revenue").asc()).unionByName(block(f"Max_{k}", F.col("revenue").desc()))


def top_by_wealth(customer: DataFrame, orders: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """The `k` best customers of each segment; unknown revenue ranks first and is shown as 0."""
    revenue = named_customer_revenue(customer, approved(orders), items, "wealth_segment")
    order = [F.col("revenue").desc_nulls_first(), F.col("customer_id").asc()]
    best = top_k_per_group(revenue, ["wealth_segment"], order, k)
    return best.select(
        "first_name", "last_name", "wealth_segment",
        F.coalesce("revenue", F.lit(0).cast("decimal(10,2)")).alias("revenue"),
    )
