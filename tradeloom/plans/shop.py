"""Relational questions about customers, products and orders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.constants import MASS_CUSTOMER
from tradeloom.functions import months_before, whole_years
from tradeloom.operators.distinct_counts import counts_of_bitmaps, id_bitmaps
from tradeloom.operators.matching import join_side_keys
from tradeloom.operators.ranking import top_k
from tradeloom.plans.revenue import CUSTOMER_NAMES, approved, order_amounts


def _ordered_in(first: date, last: date) -> Column:
    return F.col("order_date").between(F.lit(first), F.lit(last))


def high_cost_brands(product: DataFrame, items: DataFrame, min_cost, min_units: int) -> DataFrame:
    """Brands whose products costing more than `min_cost` sold at least `min_units` units.

    Units are summed per product before the join: a best-selling product joins as one row.
    """
    units = items.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return (
        product.filter(F.col("standard_cost") > min_cost)
        .join(units, "product_id")
        .groupBy("brand")
        .agg(F.sum("units").alias("units"))
        .filter(F.col("units") >= min_units)
        .select("brand")
    )


def daily_online_orders(orders: DataFrame, first: date, last: date) -> DataFrame:
    """Approved online orders and their distinct customers, per day that has any."""
    return (
        approved(orders)
        .filter(_ordered_in(first, last) & F.col("online_order"))
        .groupBy("order_date")
        .agg(
            F.count_distinct("order_id").alias("cnt_order"),
            F.count_distinct("customer_id").alias("cnt_customers"),
        )
        .orderBy("order_date")
    )


_ONLINE_IDS = {"order_id": "cnt_order", "customer_id": "cnt_customers"}


def daily_online_ids(orders: DataFrame, first: date, last: date) -> DataFrame:
    """The sets behind `daily_online_orders`, to be stored: per day the approved online orders and their
    customers as bitmaps. Days that are loaded later are appended."""
    online = approved(orders).filter(_ordered_in(first, last) & F.col("online_order"))
    return id_bitmaps(online, ["order_date"], list(_ONLINE_IDS))


def distinct_by_period(days: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Distinct orders and customers per period ('day', 'week', 'month', 'quarter', 'year') that has any,
    added up from the sets of days: (period, first_day, cnt_order, cnt_customers)."""
    spans = F.explode(
        F.array(*[
            F.struct(F.lit(p).alias("period"), F.date_trunc(p, "order_date").cast("date").alias("first_day")) for p in periods
        ])
    )
    spread = days.withColumn("__span", spans)
    by = [F.col("__span.period"), F.col("__span.first_day")]
    counted = counts_of_bitmaps(spread, by, list(_ONLINE_IDS))
    named = [F.col(c).alias(name) for c, name in _ONLINE_IDS.items()]
    return counted.select(F.col("__by0").alias("period"), F.col("__by1").alias("first_day"), *named)


def senior_titles(customer: DataFrame, as_of: date, older_than: int = 35) -> DataFrame:
    """Titles of senior IT and lead finance staff above an age, one row per customer.

    The two groups exclude each other, so one pass with OR equals the bag union of two.
    """
    industry, title = F.col("job_industry_category"), F.col("job_title")
    senior_it = (industry == "IT") & title.like("Senior%")
    lead_finance = (industry == "Financial Services") & title.like("Lead%")
    of_age = whole_years(F.col("dob"), as_of) > older_than
    return customer.filter(of_age & (senior_it | lead_finance)).select("job_title")


def bought_by_one_industry_only(
    customer: DataFrame,
    product: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    buyers: str,
    non_buyers: str,
    attributes: Sequence[str] = ("brand",),
) -> DataFrame:
    """Product attributes that customers of `buyers` bought and customers of `non_buyers` did not.

    A set difference in one pass: each attribute value remembers which of the two industries occurred.
    Grouping treats NULL as a value, as EXCEPT does.
    """
    industry = F.col("job_industry_category")
    relevant = customer.filter(industry.isin(buyers, non_buyers)).select("customer_id", industry.alias("industry"))
    order_industry = orders.select("order_id", "customer_id").join(relevant, "customer_id")
    sold = (
        items.select("order_id", "product_id")
        .join(order_industry.select("order_id", "industry"), "order_id")
        .groupBy("product_id")
        .agg(_any_equal("industry", buyers), _any_equal("industry", non_buyers, "barred"))
    )
    return (
        product.select("product_id", *(F.col(a).alias(f"__{a}") for a in attributes))
        .join(sold, "product_id")
        .groupBy(*(F.col(f"__{a}").alias(a) for a in attributes))
        .agg(F.bool_or("wanted").alias("wanted"), F.bool_or("barred").alias("barred"))
        .filter(F.col("wanted") & ~F.col("barred"))
        .select(*attributes)
    )


def _any_equal(column: str, value: str, name: str = "wanted") -> Column:
    return F.bool_or(F.col(column) == value).alias(name)


def above_state_average(customer: DataFrame) -> DataFrame:
    """Customers whose property valuation exceeds the mean of all customers of their state."""
    mean = (
        customer.groupBy(*join_side_keys("state"))
        .agg(F.avg("property_valuation").alias("__state_mean"))
        .select("state", "__state_mean")
    )
    above = F.col("property_valuation") > F.col("__state_mean")
    return customer.join(mean, "state").filter(above).drop("__state_mean")


def top_online_buyers(
    customer: DataFrame,
    product: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    brands: Sequence[str],
    k: int = 10,
) -> DataFrame:
    """The `k` living customers, valued above their state's mean, with most online items of `brands`."""
    wanted = product.filter(F.col("brand").isin(*brands)).select("product_id")
    per_order = items.join(wanted, "product_id").groupBy("order_id").agg(F.count("order_item_id").alias("n"))
    per_customer = (
        orders.filter("online_order")
        .select("order_id", "customer_id")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(F.sum("n").alias("n"))
    )
    counted = (
        above_state_average(customer)
        .filter(F.col("deceased_indicator") == "N")
        .join(per_customer, "customer_id")
        .groupBy(*CUSTOMER_NAMES)
        .agg(F.sum("n").alias("cnt_orders_online"))
    )
    return top_k(counted, [F.col("cnt_orders_online").desc(), F.col("customer_id").asc()], k)


def inactive_car_owners(customer: DataFrame, orders: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    """Car owners above the mass segment without an approved online order in the last `months`."""
    active = (
        approved(orders)
        .filter(F.col("online_order") & (F.col("order_date") >= months_before(as_of, months)))
        .select("customer_id")
        .distinct()
    )
    return (
        customer.filter((F.col("owns_car") == "Yes") & (F.col("wealth_segment") != MASS_CUSTOMER))
        .join(active, "customer_id", "left_anti")
        .select(*CUSTOMER_NAMES)
    )


def buyers_of_top_products(
    customer: DataFrame,
    product: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    line: str = "Road",
    top: int = 5,
    exactly: int = 2,
    industry: str = "IT",
) -> DataFrame:
    """Customers of `industry` who bought exactly `exactly` of the `top` dearest products of `line`.

    A missing list price counts as dearest; equal prices go by product id.
    """
    dearest = top_k(
        product.filter(F.col("product_line") == line),
        [F.col("list_price").desc_nulls_first(), F.col("product_id").asc()],
        top,
    ).select("product_id")
    bought = (
        items.select("order_id", "product_id")
        .join(dearest, "product_id", "left_semi")
        .join(approved(orders).select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.count_distinct("product_id").alias("n_products"))
        .filter(F.col("n_products") == exactly)
    )
    return (
        customer.filter(F.col("job_industry_category") == industry)
        .select(*CUSTOMER_NAMES)
        .join(bought.select("customer_id"), "customer_id", "left_semi")
        .distinct()
    )


def loyal_high_revenue(
    customer: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    first: date,
    last: date,
    industries: Sequence[str] = ("IT", "Health"),
    min_orders: int = 3,
    revenue_above: int = 10_000,
) -> DataFrame:
    """Customers of `industries` with enough approved orders and revenue in a date range.

    One pass over all industries; `distinct` gives the set semantics of a union of one branch each.
    """
    per_customer = (
        approved(orders)
        .filter(_ordered_in(first, last))
        .select("order_id", "customer_id")
        .join(order_amounts(items), "order_id")
        .groupBy("customer_id", "order_id")
        .agg(F.sum("amount").alias("amount"))
        .groupBy("customer_id")
        .agg(F.count("*").alias("n_orders"), F.sum("amount").alias("revenue"))
        .filter((F.col("n_orders") >= min_orders) & (F.col("revenue") > revenue_above))
    )
    return (
        customer.filter(F.col("job_industry_category").isin(*industries))
        .select(*CUSTOMER_NAMES, "job_industry_category")
        .join(per_customer, "customer_id", "left_semi")
        .distinct()
    )
