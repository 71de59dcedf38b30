"""

Every query reads whole tables of the sample folder. Dates, limits and thresholds are parameters of
the library functions; the values chosen here suit the sample tables. Decimals are handed over as
doubles so that both engines deliver the same types.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The driver may load this file by path, from any folder.
sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries
from tradeloom import schemas
from tradeloom.operators import checks, dimensions, lookup, matching, ranking
from tradeloom.plans import bookings, documents, reports, shop, shop_windows, warehouse
from tradeloom.sources import samples
from tradeloom.sources.calendar import calendar_spanning
from tradeloom.sources.catalog import register_views
from tradeloom.sources.files import empty

# The training-data operators are a part of their own that an installation may lack.
try:
    import corpus_pipeline
    from tradeloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tradeloom.llm"):
        raise
    _EXTRA, _EXTRA_SQL = {}, {}
else:
    _EXTRA = {**llm_queries.queries(), "pipeline": corpus_pipeline.run}
    _EXTRA_SQL = llm_queries.oracle_sql()

FLAGSHIP = "shop_top5_by_segment"
FLAGSHIP_FOLDER = "/root/testdata/sf0.001"

AGE_ON = date(1999, 1, 1)
ACTIVE_AS_OF = date(2001, 8, 1)
LOADED_BEFORE = date(1995, 1, 3)
STORED_BEFORE = date(2001, 1, 1)
SEGMENTS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def entry(spark: SparkSession) -> DataFrame:
    """Best customers of each wealth segment on the smallest sample."""
    return queries()[FLAGSHIP](spark, FLAGSHIP_FOLDER)


def oracle_sql() -> dict[str, str]:
    return {**oracle_queries.statements(), **_EXTRA_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**own_queries(), **_EXTRA}


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries that this file itself builds, all with an SQL counterpart."""
    return {name: _plain(build) for name, build in _BUILDERS.items()}


_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]):
    _BUILDERS[build.__name__] = build
    return build


def _plain(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = build(spark, folder)
        decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
        return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in decimals}) if decimals else df

    return run


def _shop(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        samples.shop_customer(spark, folder),
        samples.shop_orders(spark, folder),
        samples.shop_order_items(spark, folder),
    )


def _shop_with_products(spark: SparkSession, folder: str):
    customer, orders, items = _shop(spark, folder)
    return customer, samples.shop_product(spark, folder), orders, items


# --- shop: relational questions -------------------------------------------------------------------


@_query
def shop_high_cost_brands(spark, folder):
    product, items = samples.shop_product(spark, folder), samples.shop_order_items(spark, folder)
    return shop.high_cost_brands(product, items, min_cost=775, min_units=1000)


@_query
def shop_daily_online_orders(spark, folder):
    orders = samples.shop_orders(spark, folder)
    return shop.daily_online_orders(orders, date(1997, 1, 1), date(1998, 12, 31))


@_query
def shop_distinct_by_period(spark, folder):
    """Distinct approved online orders and their customers per day, week and month, from one table of days."""
    orders = samples.shop_orders(spark, folder)
    days = shop.daily_online_ids(orders, date(1997, 1, 1), date(1998, 12, 31))
    return shop.distinct_by_period(days, ("day", "week", "month"))


@_query
def shop_senior_titles(spark, folder):
    return shop.senior_titles(samples.shop_customer(spark, folder), AGE_ON, older_than=35)


@_query
def shop_brand_except(spark, folder):
    return shop.bought_by_one_industry_only(
        *_shop_with_products(spark, folder), "Financial Services", "IT", attributes=("brand", "product_id")
    )


@_query
def shop_brand_except_by_brand(spark, folder):
    """The same by brand alone. Every brand of the sample is bought by both industries: no rows."""
    return shop.bought_by_one_industry_only(*_shop_with_products(spark, folder), "Financial Services", "IT")


@_query
def shop_top_customers_above_avg(spark, folder):
    tables = _shop_with_products(spark, folder)
    return shop.top_online_buyers(*tables, brands=("Brand#1", "Brand#2", "Brand#3"), k=10)


@_query
def shop_inactive_car_owners(spark, folder):
    customer, orders = samples.shop_customer(spark, folder), samples.shop_orders(spark, folder)
    return shop.inactive_car_owners(customer, orders, ACTIVE_AS_OF)


@_query
def shop_two_of_top_road(spark, folder):
    return shop.buyers_of_top_products(*_shop_with_products(spark, folder), line="Road", top=50, exactly=2)


@_query
def shop_loyal_high_revenue(spark, folder):
    return shop.loyal_high_revenue(*_shop(spark, folder), date(1997, 1, 1), date(1997, 12, 31))


# --- shop: grouping and windows -------------------------------------------------------------------


@_query
def shop_industry_distribution(spark, folder):
    return shop_windows.industry_distribution(samples.shop_customer(spark, folder))


@_query
def shop_monthly_revenue(spark, folder):
    return shop_windows.monthly_revenue(*_shop(spark, folder))


@_query
def shop_brand_it_orders_with_zero(spark, folder):
    return shop_windows.online_orders_by_product_group(
        *_shop_with_products(spark, folder), attributes=("brand", "product_size")
    )


@_query
def shop_brand_it_orders(spark, folder):
    return shop_windows.online_orders_by_product_group(*_shop_with_products(spark, folder))


@_query
def shop_customer_order_stats_groupby(spark, folder):
    return shop_windows.order_stats_grouped(*_shop(spark, folder)[1:])


@_query
def shop_customer_order_stats_window(spark, folder):
    return shop_windows.order_stats_windowed(*_shop(spark, folder)[1:])


@_query
def shop_top_bottom_customers(spark, folder):
    return shop_windows.top_and_bottom_customers(*_shop(spark, folder), k=3)


@_query
def shop_second_order(spark, folder):
    return shop_windows.second_orders(samples.shop_orders(spark, folder))


@_query
def shop_max_order_gap(spark, folder):
    customer, orders = samples.shop_customer(spark, folder), samples.shop_orders(spark, folder)
    return shop_windows.longest_order_gaps(customer, orders)


@_query
def shop_top5_by_segment(spark, folder):
    return shop_windows.top_customers_per_segment(*_shop(spark, folder), k=5)


# --- documents ------------------------------------------------------------------------------------


@_query
def doc_nested_filter(spark, folder):
    found = documents.find(
        samples.theaters(spark, folder),
        {"location.address.city": "NATION_3", "location.address.state": "EUROPE"},
    )
    address = F.col("location.address")
    return found.select(
        "_id", "theater_id", *(address[part].alias(part) for part in ("street", "city", "state", "zipcode"))
    )


@_query
def doc_find_one(spark, folder):
    return documents.find_one(samples.text_comments(spark, folder), {"name": "src7"}).select("text")


@_query
def doc_array_first_count(spark, folder):
    return documents.count_first_genre(samples.movies(spark, folder), "Horror")


@_query
def doc_or_range_filter(spark, folder):
    found = documents.released_with_first_genre(
        samples.movies(spark, folder), ("Film-Noir", "Horror"), 1940, 1949
    )
    return found.withColumn("genres", F.concat_ws("|", "genres"))


@_query
def doc_projection(spark, folder):
    return documents.released_title_and_year(
        samples.movies(spark, folder), ("Film-Noir", "Horror"), 1940, 1949
    )


@_query
def doc_comment_counts(spark, folder):
    return documents.comment_counts(samples.movie_comments(spark, folder), samples.movies(spark, folder))


@_query
def doc_movies_with_comments(spark, folder):
    """Every movie with its comments nested, written as text so that both engines can be compared."""
    nested = documents.movies_with_comments(samples.movie_comments(spark, folder), samples.movies(spark, folder))
    line = F.transform("comments", lambda c: F.concat_ws(" ", c["date"].cast("string"), c["comment_id"], c["name"]))
    return nested.select(
        "_id", "title", "part", F.size("comments").alias("n_comments"), F.concat_ws("|", line).alias("comments")
    )


@_query
def doc_unwound_comments(spark, folder):
    """The same taken apart again: a row per comment, one of NULL fields for movies without any."""
    nested = documents.movies_with_comments(samples.movie_comments(spark, folder), samples.movies(spark, folder), 50)
    return lookup.unwind(nested.drop("part"), "comments", keep_empty=True)


@_query
def doc_top20_commented(spark, folder):
    return documents.most_commented(samples.movie_comments(spark, folder), samples.movies(spark, folder), 20)


# --- bookings -------------------------------------------------------------------------------------


def _calendar(spark, folder):
    return calendar_spanning(samples.shop_orders(spark, folder), "order_date")


@_query
def calendar_days(spark, folder):
    return _calendar(spark, folder)


@_query
def booking_enriched(spark, folder):
    register_views({"booking_enriched": bookings.enriched(samples.bookings(spark, folder))})
    return spark.table("booking_enriched")


@_query
def booking_avg_nights(spark, folder):
    return bookings.mean_nights(samples.bookings(spark, folder))


@_query
def booking_cancel_rate_top3(spark, folder):
    return bookings.worst_cancellation_months(samples.bookings(spark, folder), 1998, k=3)


@_query
def booking_avg_lead_time(spark, folder):
    return bookings.mean_lead_time(samples.bookings(spark, folder))


@_query
def booking_revenue_pivot(spark, folder):
    return bookings.revenue_by_segment(samples.bookings(spark, folder), SEGMENTS)


@_query
def booking_top5_repeat_share(spark, folder):
    return bookings.top_repeat_guests(samples.bookings(spark, folder), k=5)


@_query
def booking_daily_occupancy(spark, folder):
    return bookings.daily_occupancy(samples.bookings(spark, folder), _calendar(spark, folder), capacity=400)


@_query
def booking_stays_in_house(spark, folder):
    return bookings.stays_in_house(samples.bookings(spark, folder), _calendar(spark, folder))


# --- warehouse load -------------------------------------------------------------------------------


def _members(spark, found):
    """A first load of simple dimensions."""
    return dimensions.new_members(found, empty(spark, schemas.MEMBERS))


def _product_members(spark, found):
    """The same with the unknown members the products may refer to."""
    nothing = empty(spark, schemas.MEMBERS)
    unknown = dimensions.missing_unknown_members(nothing, warehouse.PRODUCT_DIMENSIONS)
    return dimensions.new_members(found, nothing).unionByName(unknown)


def _living_customers(spark, folder):
    return samples.shop_customer(spark, folder).filter(F.col("deceased_indicator") == "N")


@_query
def dedup_keep_first(spark, folder):
    raw = samples.raw_transactions(spark, folder)
    return ranking.keep_first(raw, ["product_id"], "transaction_id").select(
        "product_id", "transaction_id", "brand", "list_price", "standard_cost"
    )


@_query
def dedup_keep_best(spark, folder):
    offers = samples.shop_order_items(spark, folder).select(
        "product_id", F.col("item_list_price_at_sale").alias("list_price"), "order_id"
    )
    return ranking.keep_best(offers, ["product_id"], "list_price", tie_break=["order_id"])


@_query
def incremental_append(spark, folder):
    """Orders to append when those up to the last load are already stored."""
    orders = samples.shop_orders(spark, folder)
    stored = orders.filter(F.col("order_date") < F.lit(STORED_BEFORE))
    return matching.new_rows(orders, stored, ["order_id"], orders)


@_query
def dim_load_simple(spark, folder):
    """All simple dimensions when the transactions of the first days are loaded already."""
    raw_customers = samples.raw_customers(spark, folder)
    raw_transactions = samples.raw_transactions(spark, folder)
    early = raw_transactions.filter(F.to_date("transaction_date", "M/d/yyyy") < F.lit(LOADED_BEFORE))
    loaded = _members(spark, dimensions.distinct_members(early, warehouse.TRANSACTION_DIMENSIONS))
    added = dimensions.new_members(warehouse.found_members(raw_customers, raw_transactions), loaded)
    return loaded.withColumn("added", F.lit(False)).unionByName(added.withColumn("added", F.lit(True)))


@_query
def dim_load_location(spark, folder):
    """All three location levels of a first load, stacked."""
    places = dimensions.distinct_places(samples.raw_customers(spark, folder))
    nothing = dimensions.Locations(
        empty(spark, schemas.COUNTRIES), empty(spark, schemas.STATES), empty(spark, schemas.POSTCODES)
    )
    loaded = dimensions.new_locations(places, nothing, lambda level, _: level)
    no_id = F.lit(None).cast("bigint")

    def level(df, name, id_column, label, parent):
        return df.select(
            F.lit(name).alias("level"), id_column.alias("id"), F.col(label).alias("name"), parent.alias("parent_id")
        )

    return (
        level(loaded.countries, "country", F.col("id"), "country_name", no_id)
        .unionByName(level(loaded.states, "state", F.col("id"), "state_name", F.col("country_id")))
        .unionByName(level(loaded.postcodes, "postcode", no_id, "postcode", F.col("state_id")))
    )


@_query
def dim_surrogate_key(spark, folder):
    """Brands and product names, each numbered on its own."""
    part = samples.sample(spark, folder, "part")
    names = dimensions.distinct_members(part, {"brands": "p_brand", "product_names": "p_name"})
    return dimensions.new_members(names, empty(spark, schemas.MEMBERS))


@_query
def dim_unknown_member(spark, folder):
    """Asked for twice, added once."""
    product = samples.shop_product(spark, folder)
    once = _product_members(spark, dimensions.distinct_members(product, warehouse.PRODUCT_DIMENSIONS))
    return dimensions.with_unknown_members(once, warehouse.PRODUCT_DIMENSIONS)


@_query
def fact_products(spark, folder):
    raw = samples.raw_transactions(spark, folder)
    members = _product_members(spark, dimensions.distinct_members(raw, warehouse.PRODUCT_DIMENSIONS))
    return warehouse.products(raw, members, empty(spark, schemas.DIM_PRODUCTS))


@_query
def fact_customers(spark, folder):
    raw = samples.raw_customers(spark, folder)
    members = _members(
        spark, dimensions.distinct_members(raw, warehouse.CUSTOMER_DIMENSIONS, ["job_industries"])
    )
    return warehouse.customers(raw, members, empty(spark, schemas.DIM_CUSTOMERS)).withColumn(
        "property_valuation", F.col("property_valuation").cast("int")
    )


@_query
def fact_transactions(spark, folder):
    raw = samples.raw_transactions(spark, folder)
    members = _members(spark, dimensions.distinct_members(raw, {"order_statuses": "order_status"}))
    known = _living_customers(spark, folder)
    return warehouse.transactions(raw, known, members, empty(spark, schemas.TRANSACTIONS))


@_query
def report_transactions_wide(spark, folder):
    raw = samples.raw_transactions(spark, folder)
    found = dimensions.distinct_members(raw, warehouse.TRANSACTION_DIMENSIONS)
    members = _product_members(spark, found)
    product = warehouse.products(raw, members, empty(spark, schemas.DIM_PRODUCTS))
    known = _living_customers(spark, folder)
    fact = warehouse.transactions(raw, known, members, empty(spark, schemas.TRANSACTIONS))
    return warehouse.wide_transactions(fact, product, members)


@_query
def orphan_reject(spark, folder):
    """Every order with the verdict: kept because its customer is known, or not."""
    orders = samples.shop_orders(spark, folder)
    flagged = matching.flag_parent(orders, _living_customers(spark, folder), "customer_id", "kept")
    return flagged.select("order_id", "customer_id", "kept")


@_query
def check_unique(spark, folder):
    return checks.duplicate_keys(samples.sample(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def check_foreign_key(spark, folder):
    orders = samples.shop_orders(spark, folder)
    return checks.missing_parents(orders, "customer_id", _living_customers(spark, folder))


@_query
def check_not_null(spark, folder):
    customer = samples.shop_customer(spark, folder)
    return checks.null_counts(customer, customer.columns)


# --- reports of the daily job ---------------------------------------------------------------------


@_query
def report_min_max_customers(spark, folder):
    return reports.min_max_customers(*_shop(spark, folder), k=3)


@_query
def report_wealth_top5(spark, folder):
    return reports.top_by_wealth(*_shop(spark, folder), k=5)


@_query
def report_quality_gate(spark, folder):
    """Both reports have rows; a list of orders without a customer has none and is flagged."""
    customer, orders, items = _shop(spark, folder)
    return checks.report_status(
        {
            "report_min_max": reports.min_max_customers(customer, orders, items),
            "report_wealth": reports.top_by_wealth(customer, orders, items),
            "report_orphans": checks.missing_parents(orders, "customer_id", customer),
        }
    )
