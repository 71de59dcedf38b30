"""Registered queries read whole tables, plan lazily, and agree with each other."""

import gzip
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tradeloom.plans import jobs, shop_windows
from tradeloom.sources import samples
from tradeloom.sources.settled import checkpoint_folder


def test_every_order_line_becomes_a_raw_transaction(spark, folder):
    raw = samples.raw_transactions(spark, folder)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    assert raw.count() == lines == raw.select("transaction_id").distinct().count()
    kept = contract.queries()["fact_transactions"](spark, folder).count()
    living = samples.shop_customer(spark, folder).filter("deceased_indicator = 'N'")
    orphans = raw.join(living, "customer_id", "left_anti").count()
    assert kept + orphans == lines


def test_building_a_query_writes_nothing(spark, folder):
    shared = Path(checkpoint_folder(spark).removeprefix("file:"))
    before = set(shared.rglob("*"))
    for build in contract.own_queries().values():
        build(spark, folder)
    assert set(shared.rglob("*")) == before


def test_gate_names_every_unreadable_report(spark, tmp_path):
    good = tmp_path / "good"
    good.mkdir()
    (good / "part.csv").write_text("a,b\n1,2\n")
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "part.csv").write_text("a,b\n")
    corrupt = tmp_path / "corrupt"
    corrupt.mkdir()
    (corrupt / "part.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n" * 100)[:20] + b"damage")
    paths = {"good": str(good), "empty": str(empty), "corrupt": str(corrupt), "missing": str(tmp_path / "none")}
    with pytest.raises(jobs.ReportsRejected) as rejected:
        jobs.check_reports(spark, paths)
    assert all(name in str(rejected.value) for name in ("empty", "corrupt", "missing"))
    assert "good" not in str(rejected.value)
    assert jobs.check_reports(spark, {"good": str(good)}) == {"good": 1}


@pytest.mark.parametrize("kind", ["decimal(10,2)", "decimal(12,4)", "double"])
def test_windowed_statistics_equal_grouped_ones(spark, kind):
    orders = spark.createDataFrame([(k, k % 3, "Approved") for k in range(30)], "order_id int, customer_id int, order_status string")
    rows = [(k, k % 30, 1 + k % 2, Decimal(k % 7) / 200 + Decimal("0.01")) for k in range(90)]
    items = spark.createDataFrame(rows, "order_item_id int, order_id int, quantity int, item_list_price_at_sale decimal(12,4)")
    items = items.withColumn("item_list_price_at_sale", items.item_list_price_at_sale.cast(kind))
    grouped = shop_windows.order_stats_grouped(orders, items)
    windowed = shop_windows.order_stats_windowed(orders, items)
    assert [t for _, t in grouped.dtypes] == [t for _, t in windowed.dtypes]
    rows = sorted(grouped.collect()), sorted(windowed.collect())
    for a, b in zip(*rows, strict=True):
        # Sums of doubles depend on their order, which may tip a mean that lies half-way between cents.
        assert tuple(a) == (pytest.approx(tuple(b), abs=0.011) if kind == "double" else tuple(b))
