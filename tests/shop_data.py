"""Small random shops with everything awkward in them, and one key that holds a third of all rows."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal
from types import SimpleNamespace

from tradeloom import schemas


def money(value):
    return None if value is None else Decimal(value).quantize(Decimal("0.01"))


def make_shop(seed: int, n_customers=25, n_products=12, n_orders=120, n_items=300) -> SimpleNamespace:
    rng = random.Random(seed)
    pick = rng.choice
    customers = [
        dict(
            customer_id=i, first_name=f"F{i % 7}", last_name=pick([f"L{i}", None]), gender="U",
            dob=pick([None, date(1950 + rng.randrange(50), 1 + rng.randrange(12), 1 + rng.randrange(28)), date(1960, 2, 29)]),
            job_title=pick(["Senior Engineer", "Senior", "Lead Analyst", "Leader", "Clerk", None]),
            job_industry_category=pick(["IT", "Financial Services", "Health", "n/a", None]),
            wealth_segment=pick(["Mass Customer", "High Net Worth", "Affluent Customer", None]),
            deceased_indicator=pick("NNNY"), owns_car=pick(["Yes", "No"]), address=None, postcode=None,
            state=pick(["NSW", "VIC", None]), country="AU", property_valuation=pick([None, 1, 5, 9, 12]),
        )
        for i in range(n_customers)
    ]
    products = [
        dict(
            product_id=i, brand=pick(["Solex", "OHM Cycles", "Norco Bicycles", None]),
            product_line=pick(["Road", "Standard", "Road"]), product_class=None, product_size=None,
            list_price=pick([None, money(100), money(200), money(200), money(i)]),
            standard_cost=pick([None, money(10), money(1600)]),
        )
        for i in range(n_products)
    ]
    hot = lambda n: 0 if rng.random() < 0.34 else rng.randrange(n)
    start = date(2017, 1, 1)
    orders = [
        dict(
            order_id=i,
            # the last third of the customers never orders; one id in twenty is an orphan
            customer_id=9999 if rng.random() < 0.05 else hot(n_customers * 2 // 3),
            order_date=pick([None] + [start + timedelta(days=rng.randrange(120))] * 12),
            online_order=pick([True, True, False, None]), order_status=pick(["Approved", "Approved", "Cancelled", None]),
        )
        for i in range(n_orders)
    ]
    items = [
        dict(
            order_item_id=None if rng.random() < 0.03 else i, order_id=hot(n_orders + 5), product_id=hot(n_products + 1),
            quantity=pick([1, 2, 300, None]), item_list_price_at_sale=pick([None, money("0.01"), money("19.99"), money("1000.05")]),
            item_standard_cost_at_sale=None,
        )
        for i in range(n_items)
    ]
    return SimpleNamespace(customer=customers, product=products, orders=orders, items=items)


def frames(spark, shop):
    def frame(data, schema):
        return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in data], schema)

    return SimpleNamespace(
        customer=frame(shop.customer, schemas.CUSTOMER),
        product=frame(shop.product, schemas.PRODUCT),
        orders=frame(shop.orders, schemas.ORDERS),
        items=frame(shop.items, schemas.ORDER_ITEMS),
    )
