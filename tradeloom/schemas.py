"""Explicit schemas; nothing in this package infers types from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

INT, LONG, SHORT, DOUBLE = IntegerType(), LongType(), ShortType(), DoubleType()
TEXT, DATE, FLAG = StringType(), DateType(), BooleanType()
MONEY = DecimalType(10, 2)
TEXTS = ArrayType(StringType())


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


CUSTOMER = _table(
    customer_id=LONG, first_name=TEXT, last_name=TEXT, gender=TEXT, dob=DATE, job_title=TEXT,
    job_industry_category=TEXT, wealth_segment=TEXT, deceased_indicator=TEXT, owns_car=TEXT,
    address=TEXT, postcode=INT, state=TEXT, country=TEXT, property_valuation=INT,
)
PRODUCT = _table(
    product_id=LONG, brand=TEXT, product_line=TEXT, product_class=TEXT, product_size=TEXT,
    list_price=MONEY, standard_cost=MONEY,
)
ORDERS = _table(
    order_id=LONG, customer_id=LONG, order_date=DATE, online_order=FLAG, order_status=TEXT,
)
ORDER_ITEMS = _table(
    order_item_id=LONG, order_id=LONG, product_id=LONG, quantity=INT, item_list_price_at_sale=MONEY,
    item_standard_cost_at_sale=MONEY,
)

# Raw files of the warehouse load: everything that needs cleaning arrives as text.
RAW_CUSTOMER = _table(
    customer_id=LONG, first_name=TEXT, last_name=TEXT, gender=TEXT, DOB=TEXT, job_title=TEXT,
    job_industry_category=TEXT, wealth_segment=TEXT, deceased_indicator=TEXT, owns_car=TEXT,
    address=TEXT, postcode=TEXT, state=TEXT, country=TEXT, property_valuation=SHORT,
)
RAW_TRANSACTION = _table(
    transaction_id=LONG, product_id=LONG, customer_id=LONG, transaction_date=TEXT, online_order=TEXT,
    order_status=TEXT, brand=TEXT, product_line=TEXT, product_class=TEXT, product_size=TEXT,
    list_price=TEXT, standard_cost=TEXT,
)

# Normalised warehouse tables.
COUNTRIES = _table(id=LONG, country_name=TEXT)
STATES = _table(id=LONG, state_name=TEXT, country_id=LONG)
POSTCODES = _table(postcode=TEXT, state_id=LONG)
MEMBERS = _table(dimension=TEXT, id=LONG, name=TEXT)
DIM_CUSTOMERS = _table(
    customer_id=LONG, first_name=TEXT, last_name=TEXT, gender=TEXT, dob=DATE, job_title=TEXT,
    job_industry_category_id=LONG, wealth_segment_id=LONG, deceased_indicator=FLAG, owns_car=FLAG,
    address=TEXT, postcode=TEXT, property_valuation=SHORT,
)
DIM_PRODUCTS = _table(
    product_id=LONG, brand_id=LONG, product_line_id=LONG, product_class_id=LONG, product_size_id=LONG,
    list_price=MONEY, standard_cost=MONEY,
)
TRANSACTIONS = _table(
    transaction_id=LONG, product_id=LONG, customer_id=LONG, transaction_date=DATE, online_order=FLAG,
    order_status_id=LONG,
)

# Documents.
THEATER = _table(
    _id=TEXT,
    theater_id=LONG,
    location=_table(address=_table(street=TEXT, city=TEXT, state=TEXT, zipcode=TEXT)),
)
COMMENT = _table(_id=TEXT, name=TEXT, movie_id=TEXT, text=TEXT)
MOVIE = _table(_id=TEXT, title=TEXT, year=INT, genres=TEXTS)

BOOKING = _table(
    ID=TEXT, n_adults=INT, n_children=INT, weekend_nights=INT, week_nights=INT, meal_plan=TEXT,
    car_parking_space=INT, room_type=TEXT, lead_time=INT, year=INT, month=INT, date=INT,
    market_segment=TEXT, repeated_guest=INT, previous_cancellations=INT,
    previous_bookings_not_canceled=INT, avg_room_price=MONEY, special_requests=INT, status=TEXT,
)
