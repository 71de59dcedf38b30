"""Shop questions against plain Python loops over random shops."""

from collections import Counter, defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest

from conftest import bag, rows
from shop_data import frames, make_shop, money
from tradeloom.plans import reports, shop, shop_windows

CENT = Decimal("0.01")


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    data = make_shop(request.param)
    return data, frames(spark, data)


def same(df, expected):
    assert bag(df) == sorted(expected, key=repr)


def approved(data):
    return [o for o in data.orders if o["order_status"] == "Approved"]


def amount(item):
    q, p = item["quantity"], item["item_list_price_at_sale"]
    return None if q is None or p is None else q * p


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def items_by_order(data):
    grouped = defaultdict(list)
    for item in data.items:
        grouped[item["order_id"]].append(item)
    return grouped


def sales(data, orders):
    """(order, item) pairs."""
    by_order = items_by_order(data)
    return [(o, i) for o in orders for i in by_order[o["order_id"]]]


def revenue_by_customer(data, orders):
    grouped = defaultdict(list)
    for order, item in sales(data, orders):
        grouped[order["customer_id"]].append(amount(item))
    return {k: total(v) for k, v in grouped.items()}


def first_nulls(value):
    """Sort key for descending order with NULL first."""
    return (0, 0) if value is None else (1, -value)


def test_high_cost_brands(case):
    data, f = case
    units = defaultdict(list)
    for p in data.product:
        if p["standard_cost"] is not None and p["standard_cost"] > 1500:
            units[p["brand"]] += [i["quantity"] for i in data.items if i["product_id"] == p["product_id"]]
    expected = [(b,) for b, q in units.items() if (total(q) or 0) >= 1000]
    same(shop.high_cost_brands(f.product, f.items, 1500, 1000), expected)


def test_daily_online_orders(case):
    data, f = case
    first, last = date(2017, 1, 10), date(2017, 3, 1)
    days = defaultdict(list)
    for o in approved(data):
        if o["online_order"] and o["order_date"] and first <= o["order_date"] <= last:
            days[o["order_date"]].append(o)
    expected = [(d, len({o["order_id"] for o in os}), len({o["customer_id"] for o in os})) for d, os in sorted(days.items())]
    assert rows(shop.daily_online_orders(f.orders, first, last)) == expected


def test_senior_titles(case):
    data, f = case
    as_of = date(2005, 6, 15)

    def age(born):
        return as_of.year - born.year - ((as_of.month, as_of.day) < (born.month, born.day))

    expected = []
    for c in data.customer:
        title, industry = c["job_title"] or "", c["job_industry_category"]
        wanted = (industry == "IT" and title.startswith("Senior")) or (
            industry == "Financial Services" and title.startswith("Lead")
        )
        if wanted and c["dob"] and age(c["dob"]) > 35:
            expected.append((c["job_title"],))
    same(shop.senior_titles(f.customer, as_of), expected)


@pytest.mark.parametrize("attributes", [("brand",), ("brand", "product_id"), ("product_line",)])
def test_bought_by_one_industry_only(case, attributes):
    data, f = case
    industry = {c["customer_id"]: c["job_industry_category"] for c in data.customer}
    product = {p["product_id"]: p for p in data.product}

    def bought(by):
        return {
            tuple(product[i["product_id"]][a] for a in attributes)
            for o, i in sales(data, data.orders)
            if industry.get(o["customer_id"]) == by and i["product_id"] in product
        }

    got = shop.bought_by_one_industry_only(f.customer, f.product, f.orders, f.items, "Health", "IT", attributes)
    same(got, bought("Health") - bought("IT"))


def test_except_agrees_with_set_operator(case, spark):
    data, f = case
    sold = f.items.join(f.orders, "order_id").join(f.customer, "customer_id").join(f.product, "product_id")
    by = lambda name: sold.filter(sold.job_industry_category == name).select("brand", "product_id")
    got = shop.bought_by_one_industry_only(
        f.customer, f.product, f.orders, f.items, "Financial Services", "Health", ("brand", "product_id")
    )
    same(got, bag(by("Financial Services").subtract(by("Health"))))


def test_top_online_buyers(case):
    data, f = case
    by_state = defaultdict(list)
    for c in data.customer:
        by_state[c["state"]].append(c["property_valuation"])
    product = {p["product_id"] for p in data.product if p["brand"] in ("Solex", "OHM Cycles")}
    items = Counter()
    for o, i in sales(data, data.orders):
        if o["online_order"] and i["product_id"] in product:
            items[o["customer_id"]] += i["order_item_id"] is not None
    ranked = []
    for c in data.customer:
        known = [v for v in by_state[c["state"]] if v is not None]
        value = c["property_valuation"]
        if c["state"] is None or value is None or value <= sum(known) / len(known) or c["deceased_indicator"] != "N":
            continue
        if c["customer_id"] in items:
            ranked.append((c["customer_id"], c["first_name"], c["last_name"], items[c["customer_id"]]))
    ranked.sort(key=lambda r: (-r[3], r[0]))
    got = shop.top_online_buyers(f.customer, f.product, f.orders, f.items, ["Solex", "OHM Cycles"], k=3)
    assert rows(got) == ranked[:3]


def test_inactive_car_owners(case):
    data, f = case
    active = {
        o["customer_id"] for o in approved(data)
        if o["online_order"] and o["order_date"] and o["order_date"] >= date(2017, 2, 1)
    }
    expected = [
        (c["customer_id"], c["first_name"], c["last_name"]) for c in data.customer
        if c["owns_car"] == "Yes" and c["wealth_segment"] not in (None, "Mass Customer")
        and c["customer_id"] not in active
    ]
    same(shop.inactive_car_owners(f.customer, f.orders, date(2018, 2, 1)), expected)


@pytest.mark.parametrize("exactly", [1, 2])
def test_buyers_of_top_products(case, exactly):
    data, f = case
    road = sorted(
        (p for p in data.product if p["product_line"] == "Road"),
        key=lambda p: (first_nulls(p["list_price"]), p["product_id"]),
    )
    top = {p["product_id"] for p in road[:3]}
    bought = defaultdict(set)
    for o, i in sales(data, approved(data)):
        if i["product_id"] in top:
            bought[o["customer_id"]].add(i["product_id"])
    expected = [
        (c["customer_id"], c["first_name"], c["last_name"]) for c in data.customer
        if c["job_industry_category"] == "IT" and len(bought[c["customer_id"]]) == exactly
    ]
    same(shop.buyers_of_top_products(f.customer, f.product, f.orders, f.items, top=3, exactly=exactly), expected)


def test_loyal_high_revenue(case):
    data, f = case
    first, last = date(2017, 1, 5), date(2017, 4, 1)
    chosen = [o for o in approved(data) if o["order_date"] and first <= o["order_date"] <= last]
    revenue = revenue_by_customer(data, chosen)
    with_items = defaultdict(set)
    for o, _ in sales(data, chosen):
        with_items[o["customer_id"]].add(o["order_id"])
    expected = [
        (c["customer_id"], c["first_name"], c["last_name"], c["job_industry_category"]) for c in data.customer
        if c["job_industry_category"] in ("IT", "Health")
        and len(with_items[c["customer_id"]]) >= 2 and (revenue.get(c["customer_id"]) or 0) > 500
    ]
    got = shop.loyal_high_revenue(f.customer, f.orders, f.items, first, last, min_orders=2, revenue_above=500)
    same(got, expected)


def test_industry_distribution(case):
    data, f = case
    counts = Counter(c["job_industry_category"] for c in data.customer if c["job_industry_category"])
    assert rows(shop_windows.industry_distribution(f.customer)) == sorted(counts.items(), key=lambda r: (-r[1], r[0]))


def test_monthly_revenue(case):
    data, f = case
    industry = {c["customer_id"]: c["job_industry_category"] for c in data.customer}
    sums = defaultdict(list)
    for o, i in sales(data, approved(data)):
        if o["customer_id"] in industry:
            d = o["order_date"]
            sums[d and d.year, d and d.month, industry[o["customer_id"]]].append(amount(i))
    same(shop_windows.monthly_revenue(f.customer, f.orders, f.items), [(*k, total(v)) for k, v in sums.items()])


def test_online_orders_by_brand_keeps_brands_without_any(case):
    data, f = case
    it = {c["customer_id"] for c in data.customer if c["job_industry_category"] == "IT"}
    seen = {p["brand"]: set() for p in data.product if p["brand"]}
    brand = {p["product_id"]: p["brand"] for p in data.product}
    for o, i in sales(data, approved(data)):
        if o["customer_id"] in it and o["online_order"] and brand.get(i["product_id"]):
            seen[brand[i["product_id"]]].add(o["order_id"])
    got = shop_windows.online_orders_by_product_group(f.customer, f.product, f.orders, f.items)
    same(got, [(b, len(s)) for b, s in seen.items()])


def test_order_stats_both_ways(case):
    data, f = case
    values = defaultdict(list)
    by_order = items_by_order(data)
    for o in approved(data):
        if by_order[o["order_id"]]:
            values[o["customer_id"]].append(total([amount(i) for i in by_order[o["order_id"]]]))
    expected = []
    for customer, orders in values.items():
        known = [v for v in orders if v is not None]
        mean = (sum(known) / len(known)).quantize(CENT, ROUND_HALF_UP) if known else None
        expected.append(
            (customer, total(orders), max(known, default=None), min(known, default=None), len(orders), mean)
        )
    grouped = shop_windows.order_stats_grouped(f.orders, f.items)
    windowed = shop_windows.order_stats_windowed(f.orders, f.items, shares=4)
    same(grouped, expected)
    assert rows(grouped) == rows(windowed)
    assert grouped.exceptAll(windowed).count() == windowed.exceptAll(grouped).count() == 0


def customer_totals(data):
    revenue = revenue_by_customer(data, approved(data))
    return [(c, revenue.get(c["customer_id"]) or money(0)) for c in data.customer]


def test_top_and_bottom_and_its_report_form(case):
    data, f = case
    totals = customer_totals(data)
    high = sorted(totals, key=lambda t: (-t[1], t[0]["customer_id"]))[:3]
    low = sorted(totals, key=lambda t: (t[1], t[0]["customer_id"]))[:3]
    names = lambda c: (c["first_name"], c["last_name"])
    got = rows(shop_windows.top_and_bottom_customers(f.customer, f.orders, f.items))
    assert got == [("MAX", *names(c), v) for c, v in high] + [("MIN", *names(c), v) for c, v in low]
    report = rows(reports.min_max_customers(f.customer, f.orders, f.items))
    assert report == [(*names(c), v, "Min_3") for c, v in low] + [(*names(c), v, "Max_3") for c, v in high]


def last_nulls(value):
    return (value is None, value or date.min)


def test_second_orders(case):
    data, f = case
    grouped = defaultdict(list)
    for o in data.orders:
        grouped[o["customer_id"]].append(o)
    expected = []
    for orders in grouped.values():
        orders.sort(key=lambda o: (last_nulls(o["order_date"]), o["order_id"]))
        if len(orders) > 1:
            o = orders[1]
            expected.append((o["order_id"], o["customer_id"], o["order_date"], o["order_status"]))
    same(shop_windows.second_orders(f.orders), expected)


def test_longest_order_gaps(case):
    data, f = case
    dates = defaultdict(list)
    for o in approved(data):
        dates[o["customer_id"]].append(o["order_date"])
    expected = []
    for c in data.customer:
        ordered = sorted(dates[c["customer_id"]], key=last_nulls)
        pairs = [(a, b) for a, b in zip(ordered, ordered[1:]) if a is not None]
        if pairs:
            gaps = [(b - a).days for a, b in pairs if b is not None]
            expected.append((c["first_name"], c["last_name"], c["job_title"], max(gaps, default=None)))
    same(shop_windows.longest_order_gaps(f.customer, f.orders), expected)


def test_top_per_segment_and_its_report_form(case):
    data, f = case
    revenue = revenue_by_customer(data, approved(data))
    segments = defaultdict(list)
    for c in data.customer:
        if c["customer_id"] in revenue:
            segments[c["wealth_segment"]].append((c, revenue[c["customer_id"]]))
    best = []
    for members in segments.values():
        members.sort(key=lambda m: (first_nulls(m[1]), m[0]["customer_id"]))
        best += members[:2]
    names = lambda c: (c["first_name"], c["last_name"], c["wealth_segment"])
    same(shop_windows.top_customers_per_segment(f.customer, f.orders, f.items, 2), [(*names(c), v) for c, v in best])
    same(
        reports.top_by_wealth(f.customer, f.orders, f.items, 2),
        [(*names(c), v if v is not None else money(0)) for c, v in best],
    )


def test_customer_listed_twice_counts_as_a_join_would(spark):
    data = make_shop(5)
    data.customer.append(dict(data.customer[0]))
    f = frames(spark, data)
    got = shop_windows.customer_totals(f.customer, f.orders, f.items)
    assert got.count() == len(data.customer) - 1
    by_sql = f.customer.join(f.orders.filter("order_status = 'Approved'"), "customer_id").join(f.items, "order_id")
    doubled = by_sql.filter("customer_id = 0").selectExpr("sum(quantity * item_list_price_at_sale)").first()[0]
    assert got.filter("customer_id = 0").first()["revenue"] == doubled
