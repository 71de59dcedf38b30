import csv
import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from conftest import bag, rows
from tradeloom import schemas
from tradeloom.operators.matching import new_rows
from tradeloom.plans import jobs, warehouse

CUSTOMERS = [
    # customer_id, first, last, gender, DOB, title, industry, segment, deceased, car, address, postcode, state, country, value
    (1, "Ann", "A", "Female", "1980-01-31", "Clerk", "IT", "Mass Customer", "N", "Yes", "1 St", 2000, "New South Wales", "Australia", 5),
    (2, "Bob", "", "M", "never", "", "n/a", "High Net Worth", "Y", "No", "2 St", 3000, "VIC", "Australia", ""),
    (3, "Cy", "C", "Femal", "", "Lead", "N/A", "Mass Customer", "", "", "", 3000, "Victoria", "Australia", 9),
]
TRANSACTIONS = [
    # transaction_id, product_id, customer_id, date, online, status, brand, line, class, size, list_price, standard_cost
    (11, 7, 1, "2/25/2017", "True", "Approved", "Solex", "Road", "low", "small", "12,5", "3,33"),
    (10, 7, 2, "12/1/2017", "False", "Cancelled", "Solex", "Road", "low", "small", "99,99", "4"),
    (12, 0, 3, "1/1/2017", "", "Approved", "", "", "", "", "abc", ""),
    (13, 8, 5034, "1/1/2017", "True", "Approved", "OHM Cycles", "Road", "high", "large", "1,00", "1,00"),
]


def write_csv(path, schema, data, delimiter=","):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, delimiter=delimiter)
        writer.writerow(schema.names)
        writer.writerows(data)
    return str(path)


class Load:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.base = spark, folder, str(folder / "warehouse")

    def run(self, customers=CUSTOMERS, transactions=TRANSACTIONS):
        return jobs.load_warehouse(
            self.spark,
            write_csv(self.folder / "customer.csv", schemas.RAW_CUSTOMER, customers),
            write_csv(self.folder / "transaction.csv", schemas.RAW_TRANSACTION, transactions),
            self.base,
            key_buckets=8,
        )

    def tables(self):
        return jobs.open_warehouse(self.spark, self.base)

    def content(self):
        return {name: bag(df) for name, df in self.tables().items()}


@pytest.fixture
def fresh(spark, tmp_path):
    return Load(spark, tmp_path)


@pytest.fixture(scope="module")
def load(spark, tmp_path_factory):
    """A warehouse after its first load. The tests below add to it in the order they stand in."""
    first = Load(spark, tmp_path_factory.mktemp("load"))
    result = first.run()
    assert (result.batch, result.dropped_orphans) == (1, 1)
    return first


def test_first_load_cleans_and_links(load):
    tables = load.tables()
    assert bag(tables["countries"].select("country_name")) == [("Australia",)]
    assert bag(tables["states"].select("state_name")) == [("NSW",), ("Victoria",)]
    assert bag(tables["postcodes"].select("postcode")) == [("2000",), ("3000",)]
    assert bag(tables["job_industries"].select("category_name")) == [("IT",)]
    assert bag(tables["brands"].select("brand_name")) == [("OHM Cycles",), ("Solex",), ("Unknown",)]
    assert tables["brands"].filter("brand_name = 'Unknown'").first()["id"] == 0

    people = {r["customer_id"]: r for r in tables["customers"].collect()}
    assert [people[i]["gender"] for i in (1, 2, 3)] == ["F", "U", "U"]
    assert [people[i]["dob"] for i in (1, 2, 3)] == [date(1980, 1, 31), None, None]
    assert [people[i]["deceased_indicator"] for i in (1, 2, 3)] == [False, True, False]
    assert [people[i]["owns_car"] for i in (1, 2, 3)] == [True, False, False]
    assert [people[i]["job_industry_category_id"] for i in (1, 2, 3)] == [1, None, None]

    products = {r["product_id"]: r for r in tables["products"].collect()}
    # The first row of the file wins, not the smallest transaction id.
    assert (products[7]["list_price"], products[7]["standard_cost"]) == (Decimal("12.50"), Decimal("3.33"))
    assert products[0]["list_price"] is None and products[0]["standard_cost"] == 0
    assert products[0]["brand_id"] == products[0]["product_size_id"] == 0
    assert sorted(products) == [0, 7, 8]

    facts = {r["transaction_id"]: r for r in tables["transactions"].collect()}
    assert sorted(facts) == [10, 11, 12]
    assert facts[11]["transaction_date"] == date(2017, 2, 25) and facts[11]["online_order"] is True
    assert facts[12]["online_order"] is None


def test_wide_report_inverts_the_load(load):
    t = load.tables()
    members = load.spark.read.parquet(f"{load.base}/members").drop("batch")
    wide = {r["transaction_id"]: r for r in warehouse.wide_transactions(t["transactions"], t["products"], members).collect()}
    assert list(wide) == [10, 11, 12]
    row = wide[11]
    assert (row["order_status"], row["brand"], row["product_line"], row["product_class"], row["product_size"]) == (
        "Approved", "Solex", "Road", "low", "small",
    )
    assert wide[10]["order_status"] == "Cancelled" and wide[10]["list_price"] == Decimal("12.50")
    assert wide[12]["brand"] == "Unknown"


def test_second_run_adds_nothing(load):
    before = load.content()
    load.run()
    assert load.content() == before


def test_later_run_adds_only_what_is_new(load):
    before = load.content()
    customer = (4, "Di", "D", "U", "1990-05-05", "", "Health", "Affluent Customer", "N", "No", "", 2000, "NSW", "Australia", 1)
    transaction = (20, 9, 4, "3/3/2018", "True", "Approved", "Norco", "Road", "low", "small", "7", "1")
    load.run([*CUSTOMERS, customer], [*TRANSACTIONS, transaction])
    after = load.content()
    added = {n: [r for r in after[n] if r not in before[n]] for n in after}
    assert all(r in after[n] for n in before for r in before[n])
    assert [r[0] for r in added["transactions"]] == [20] and [r[0] for r in added["products"]] == [9]
    assert [r[0] for r in added["customers"]] == [4]
    assert added["brands"] == [(3, "Norco")] and added["job_industries"] == [(2, "Health")]
    assert added["states"] == [] and added["product_lines"] == []


NEW_CUSTOMER = (5, "Ed", "E", "U", "", "", "IT", "Mass Customer", "N", "No", "", 2000, "NSW", "Australia", 1)
NEW_TRANSACTION = (30, 7, 1, "1/1/2018", "True", "Approved", "Solex", "Road", "low", "small", "1", "1")


@pytest.mark.parametrize(
    "customers, transactions, rule",
    [
        ([(*NEW_CUSTOMER[:7], "", *NEW_CUSTOMER[8:])], [], "wealth_segment_id not null"),
        ([NEW_CUSTOMER, NEW_CUSTOMER], [], "customer_id unique"),
        ([], [NEW_TRANSACTION, (*NEW_TRANSACTION[:5], "", *NEW_TRANSACTION[6:])], "order_status_id not null"),
    ],
)
def test_broken_rule_leaves_facts_unchanged(load, customers, transactions, rule):
    before = load.content()
    with pytest.raises(jobs.LoadRejected, match=rule):
        load.run([*CUSTOMERS, *customers], [*TRANSACTIONS, *transactions, (31, *NEW_TRANSACTION[1:])])
    after = load.content()
    for table in jobs.FACT_TABLES:
        assert after[table] == before[table]


def test_good_load_goes_through_after_a_rejected_one(load):
    before = load.content()
    load.run(CUSTOMERS, [*TRANSACTIONS, NEW_TRANSACTION])
    added = [r for r in load.content()["transactions"] if r not in before["transactions"]]
    assert [r[0] for r in added] == [30]


def test_unreadable_date_stops_the_load(fresh):
    with pytest.raises(PySparkException):
        fresh.run(transactions=[(1, 7, 1, "02/30/2017", *TRANSACTIONS[0][4:])])
    assert fresh.content()["transactions"] == []


def test_missing_file_stops_the_load(fresh):
    with pytest.raises(AnalysisException):
        jobs.load_warehouse(fresh.spark, str(fresh.folder / "no.csv"), str(fresh.folder / "no2.csv"), fresh.base)
    assert all(not content for content in fresh.content().values())


def test_file_position_follows_the_file(spark, tmp_path):
    """Blocks are read in any order, positions still sort as the file does."""
    path = tmp_path / "long.csv"
    lines = [f"{i},{(i * 7919) % 10007}" for i in range(20000)]
    path.write_text("n,v\n" + "\n".join(lines) + "\n")
    from tradeloom.sources.files import read_csv

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_csv(spark, str(path), spark.range(1).selectExpr("1L AS n", "1L AS v").schema, position="p")
        assert df.rdd.getNumPartitions() > 3
        ordered = [r["n"] for r in df.repartition(5, "v").orderBy("p").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ordered == list(range(20000))


# --- daily reports --------------------------------------------------------------------------------


def shop_files(folder, customers=True):
    people = [(i, f"F{i}", f"L{i}", "U", "1980-01-01", "", "IT", "Mass Customer", "N", "No", "", 1, "NSW", "AU", 1) for i in range(5)]
    write_csv(folder / "customer.csv", schemas.CUSTOMER, people if customers else [], ";")
    write_csv(folder / "product.csv", schemas.PRODUCT, [(1, "Solex", "Road", "low", "small", "10.00", "1.00")] * 2)
    write_csv(folder / "orders.csv", schemas.ORDERS, [(i, i % 4, "2017-01-01", "True", "Approved") for i in range(8)])
    write_csv(folder / "order_items.csv", schemas.ORDER_ITEMS, [(i, i, 1, i, "2.50", "1.00") for i in range(8)])
    return str(folder)


def test_daily_job_writes_and_checks_reports(spark, tmp_path):
    source = shop_files(tmp_path)
    base, target = str(tmp_path / "tables"), str(tmp_path / "reports")
    assert jobs.run_daily(spark, source, base, target) == {"report_min_max": 6, "report_wealth": 4}
    report = spark.read.option("header", True).csv(f"{target}/report_min_max")
    assert report.columns == ["first_name", "last_name", "amount", "type"]
    assert bag(report.filter("type = 'Max_3'").select("first_name", "amount")) == [
        ("F1", "15.00"), ("F2", "20.00"), ("F3", "25.00"),
    ]
    assert spark.sql("SELECT count(*) FROM product").first()[0] == 2  # no deduplication here
    # A second run replaces, it does not add.
    jobs.run_daily(spark, source, base, target)
    assert jobs.open_shop(spark, base)["orders"].count() == 8


def test_every_bad_report_is_named(spark, tmp_path):
    source = shop_files(tmp_path, customers=False)
    base, target = str(tmp_path / "tables"), str(tmp_path / "reports")
    with pytest.raises(jobs.ReportsRejected) as error:
        jobs.run_daily(spark, source, base, target)
    assert "report_min_max" in str(error.value) and "report_wealth" in str(error.value)
    with pytest.raises(jobs.ReportsRejected, match="gone .*PATH_NOT_FOUND"):
        jobs.check_reports(spark, {"gone": str(tmp_path / "gone")})


def test_daily_job_stops_at_a_missing_file(spark, tmp_path):
    source = shop_files(tmp_path)
    (tmp_path / "orders.csv").unlink()
    with pytest.raises(AnalysisException):
        jobs.run_daily(spark, source, str(tmp_path / "tables"), str(tmp_path / "reports"))
    assert not (tmp_path / "reports").exists()


def test_refreshed_dates_and_columns(spark, tmp_path):
    tables = jobs.refresh_shop(spark, shop_files(tmp_path), str(tmp_path / "tables"))
    assert tables["customer"].schema == schemas.CUSTOMER
    assert rows(tables["customer"].agg(F.min("dob"))) == [(date(1980, 1, 1),)]


@pytest.mark.parametrize(
    "table, line",
    [
        ("orders", "abc,1,2017-01-01,True,Approved"),
        ("orders", "9,1,01/02/2017,True,Approved"),
        ("orders", '9,1,2017-01-01,True,"Appr\noved"'),
        ("order_items", "9,9,1"),
    ],
)
def test_malformed_input_leaves_the_shop_unchanged(spark, tmp_path, table, line):
    source, base = shop_files(tmp_path), str(tmp_path / "tables")
    before = {n: bag(df) for n, df in jobs.refresh_shop(spark, source, base).items()}
    with open(tmp_path / f"{table}.csv", "a", encoding="utf-8") as out:
        out.write(line + "\n")
    with pytest.raises(jobs.InputRejected, match=f"{table}: . malformed"):
        jobs.refresh_shop(spark, source, base)
    after = {n: bag(df) for n, df in jobs.open_shop(spark, base).items()}
    assert after == before
    assert not (tmp_path / "tables" / "_landing").exists()


def test_malformed_input_stops_the_warehouse_load(fresh):
    with pytest.raises(jobs.InputRejected, match="customers: 1 malformed"):
        fresh.run(customers=[*CUSTOMERS, ("x7", *CUSTOMERS[0][1:])])
    assert all(not content for content in fresh.content().values())


def test_history_is_filtered_where_it_is_read(spark, tmp_path):
    """A small file against a long history: the history is not shuffled."""
    spark.range(100_000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "history"))
    spark.range(99_990, 100_010).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "file"))
    history, file = (spark.read.parquet(str(tmp_path / n)) for n in ("history", "file"))
    fresh_rows = new_rows(file, history, ["k"], file)
    assert bag(fresh_rows) == [(k,) for k in range(100_000, 100_010)]
    plan = fresh_rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("LeftSemi")
    physical = fresh_rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [k" in physical and "LeftSemi" in physical
    assert not re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*(Project|Filter)?[^\n]*\n?[^\n]*Scan parquet[^\n]*history", physical)
