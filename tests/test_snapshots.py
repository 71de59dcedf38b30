"""Tables that change together: failing writers, several writers, readers in between, compaction."""

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest

from conftest import bag
from test_jobs import CUSTOMERS, TRANSACTIONS, Load, shop_files, write_csv
from tradeloom import schemas
from tradeloom.plans import jobs
from tradeloom.sources import snapshots
from tradeloom.sources.snapshots import Conflict, Snapshot, Staged

SCHEMA = "k bigint, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


class Store:
    def __init__(self, spark, base):
        self.spark, self.base, self.schema = spark, str(base), frame(spark).schema

    def stage(self, table, *rows):
        return snapshots.stage_rows(frame(self.spark, *rows), self.base, table)

    def add(self, table, *rows):
        staged = Staged({table: [self.stage(table, *rows)]}, load="add")
        return snapshots.publish(self.spark, self.latest(), staged)

    def latest(self):
        return snapshots.latest_snapshot(self.spark, self.base)

    def rows(self, table, snapshot=None):
        return bag((snapshot or self.latest()).read(self.spark, table, self.schema))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path / "base")


def test_file_is_created_once_and_whole(spark, tmp_path):
    path = str(tmp_path / "new" / "file.json")
    assert snapshots.create_file(spark, path, "first ä")
    assert not snapshots.create_file(spark, path, "second")
    assert (tmp_path / "new" / "file.json").read_text(encoding="utf-8") == "first ä"
    assert not list((tmp_path / "new").glob("*.tmp"))


def test_only_one_of_many_writers_creates_a_file(spark, tmp_path):
    path = str(tmp_path / "file.json")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: snapshots.create_file(spark, path, f"{i}" * 1000), range(24)))
    assert made.count(True) == 1
    assert (tmp_path / "file.json").read_text() == f"{made.index(True)}" * 1000


def test_staged_rows_are_seen_once_published(store):
    assert store.latest() == Snapshot(store.base) and store.rows("t") == []
    folder = store.stage("t", (1, "a"))
    assert store.rows("t") == []
    store.add("t", (2, "b"))
    assert store.rows("t") == [(2, "b")]
    snapshots.publish(store.spark, store.latest(), Staged({"t": [folder]}))
    assert store.rows("t") == [(1, "a"), (2, "b")]
    assert store.latest().loads == {"add": 1} and store.latest().number == 2


def test_readers_keep_what_they_opened(store):
    store.add("t", (1, "a"))
    opened = store.latest()
    frame_opened = opened.read(store.spark, "t", store.schema)
    new = store.stage("t", (9, "z"))
    snapshots.publish(store.spark, opened, Staged({"t": [new]}, frozenset({"t"})))
    assert store.rows("t") == [(9, "z")]
    assert bag(frame_opened) == store.rows("t", opened) == [(1, "a")]


def test_second_writer_of_a_number_is_told(store):
    first = store.latest()
    store.add("t", (1, "a"))
    with pytest.raises(Conflict):
        snapshots.publish(store.spark, first, Staged({"t": [store.stage("t", (2, "b"))]}))
    assert store.rows("t") == [(1, "a")]


@pytest.mark.parametrize("holds", [True, False])
def test_second_writer_keeps_or_repeats_its_work(store, holds):
    """Writer A has staged when writer B publishes."""
    seen = []

    def stage(old):
        seen.append(old.number)
        staged = Staged({"t": [store.stage("t", (100 + len(seen), "a"))]})
        if len(seen) == 1:
            store.add("t", (1, "b"))
        return staged

    snapshot, staged = snapshots.publish_on_latest(store.spark, store.base, stage, lambda *_: holds)
    assert seen == ([0] if holds else [0, 1]) and snapshot.number == 2
    assert store.rows("t") == [(1, "b"), (101 if holds else 102, "a")]
    # The work that was thrown away left nothing.
    assert len(list((store.spark._jvm.java.io.File(f"{store.base}/t")).list())) == 2


def test_writer_gives_up_after_so_many_attempts(store):
    with pytest.raises(Conflict, match="2 attempts"):
        snapshots.publish_on_latest(
            store.spark, store.base, lambda _: (store.add("t", (1, "b")), Staged({"u": []}))[1], lambda *_: False, attempts=2
        )


# --- compaction -----------------------------------------------------------------------------------


def test_compaction_changes_files_not_rows(store):
    for k in range(50):
        store.add("t", (k, "x"))
    before, opened = store.rows("t"), store.latest()
    after = snapshots.compact(store.spark, store.base, {"t": store.schema, "none": store.schema})
    assert len(opened.folders["t"]) == 50 and len(after.folders["t"]) == 1
    assert store.rows("t") == before == store.rows("t", opened)
    files = after.read(store.spark, "t", store.schema).inputFiles()
    assert len(files) < len(opened.read(store.spark, "t", store.schema).inputFiles()) / 5
    assert snapshots.compact(store.spark, store.base, {"t": store.schema}) == after
    removed = snapshots.remove_old_snapshots(store.spark, store.base, keep=1, older_than_hours=0)
    assert len(removed) == 50 and store.rows("t") == before
    assert snapshots.snapshot_numbers(store.spark, store.base) == [after.number]


@pytest.mark.parametrize("replaced", [False, True])
def test_compaction_beside_another_writer(store, monkeypatch, replaced):
    store.add("t", (1, "a"))
    store.add("t", (2, "b"))
    write, calls = snapshots.stage_rows, []

    def slow(df, base, table, by=()):
        name = write(df, base, table, by)
        calls.append(table)
        if len(calls) == 1:
            folders = [write(frame(store.spark, (k, "c")), store.base, "t") for k in (3, 4)]
            snapshots.publish(store.spark, store.latest(), Staged({"t": folders}, frozenset({"t"} if replaced else ())))
        return name

    monkeypatch.setattr(snapshots, "stage_rows", slow)
    snapshots.compact(store.spark, store.base, {"t": store.schema})
    assert store.rows("t") == ([] if replaced else [(1, "a"), (2, "b")]) + [(3, "c"), (4, "c")]


def test_unpublished_folders_are_removed_once_they_are_old(store):
    store.add("t", (1, "a"))
    left = store.stage("t", (9, "z"))
    assert snapshots.remove_old_snapshots(store.spark, store.base) == []
    assert snapshots.remove_old_snapshots(store.spark, store.base, older_than_hours=0) == [left]
    assert store.rows("t") == [(1, "a")]


# --- the batch jobs -------------------------------------------------------------------------------


@pytest.mark.parametrize("failing", [1, 2, 3, 4])
def test_failing_refresh_leaves_all_four_old_tables(spark, tmp_path, monkeypatch, failing):
    source, base = shop_files(tmp_path), str(tmp_path / "tables")
    opened = jobs.refresh_shop(spark, source, base)
    before = {n: bag(df) for n, df in opened.items()}
    for name, (schema, delimiter) in jobs.SHOP_FILES.items():
        write_csv(tmp_path / f"{name}.csv", schema, [], delimiter)
    write, calls = jobs.stage_rows, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == failing:
            raise OSError("disk full")
        return write(*args)

    monkeypatch.setattr(jobs, "stage_rows", breaks)
    with pytest.raises(OSError, match="disk full"):
        jobs.refresh_shop(spark, source, base)
    assert {n: bag(df) for n, df in jobs.open_shop(spark, base).items()} == before
    assert {n: bag(df) for n, df in opened.items()} == before
    monkeypatch.undo()
    assert all(df.isEmpty() for df in jobs.refresh_shop(spark, source, base).values())
    assert {n: bag(df) for n, df in opened.items()} == before  # still open from the first refresh


NORCO = (20, 9, 1, "3/3/2018", "True", "Approved", "Norco", "Road", "low", "small", "7", "1")
GIANT = (21, 10, 2, "4/3/2018", "True", "Pending", "Giant", "Touring", "low", "small", "8", "2")
SAME = (22, 9, 2, "5/3/2018", "True", "Approved", "Norco", "Road", "low", "small", "9", "3")
PERSON = (6, "Fay", "F", "F", "1991-05-05", "", "Health", "Affluent Customer", "N", "No", "", 4000, "QLD", "Australia", 1)


def interleaved(monkeypatch, outer, inner):
    """Run `inner` once `outer` has staged rows and is about to publish them."""
    from tradeloom.sources import snapshots as module

    publish, done = module.publish, []

    def late(spark, old, staged):
        if staged.load == "facts" and not done:
            done.append(True)
            inner()
        return publish(spark, old, staged)

    monkeypatch.setattr(module, "publish", late)
    outer()
    monkeypatch.undo()
    assert done


def check_integrity(tables):
    for name, keys in jobs.KEYS.items():
        for key in keys:
            assert tables[name].groupBy(*key).count().filter("count > 1").isEmpty(), (name, key)
    assert not any(jobs.fact_violations({t: tables[t] for t in jobs.FACT_TABLES}, {
        **tables, **{t: tables[t].limit(0) for t in jobs.FACT_TABLES}
    }).values())


def named(tables):
    """Products and transactions with names for ids, which depend on the order of loads."""
    brands = tables["brands"].selectExpr("id AS brand_id", "brand_name")
    statuses = tables["order_statuses"].selectExpr("id AS order_status_id", "status_name")
    products = tables["products"].join(brands, "brand_id").select("product_id", "brand_name", "list_price")
    facts = tables["transactions"].join(statuses, "order_status_id", "left")
    return bag(products), bag(facts.select("transaction_id", "customer_id", "status_name"))


@pytest.mark.parametrize("theirs", [[GIANT], [GIANT, SAME, NORCO]])
def test_interleaved_loads_equal_a_serial_order(spark, tmp_path, monkeypatch, theirs):
    def start(name):
        folder = tmp_path / name
        for part in ("one", "two"):
            (folder / part).mkdir(parents=True)
        one, two = Load(spark, folder / "one"), Load(spark, folder / "two")
        one.base = two.base = str(folder / "warehouse")
        one.run()
        return one, two

    def mine(load):
        load.run([*CUSTOMERS, PERSON], [*TRANSACTIONS, NORCO])

    def others(load):
        load.run(CUSTOMERS, [*TRANSACTIONS, *theirs])

    one, two = start("interleaved")
    interleaved(monkeypatch, lambda: mine(one), lambda: others(two))
    one_serial, two_serial = start("serial")
    others(two_serial)
    mine(one_serial)
    check_integrity(one.tables())
    assert named(one.tables()) == named(one_serial.tables())
    assert bag(one.tables()["customers"].select("customer_id")) == [(1,), (2,), (3,), (6,)]


def test_loads_in_threads_lose_and_repeat_nothing(spark, tmp_path):
    loads, base = [], str(tmp_path / "warehouse")
    for k in range(3):
        (tmp_path / f"{k}").mkdir()
        loads.append(Load(spark, tmp_path / f"{k}"))
        loads[k].base = base

    def run(k):
        own = [(100 + 10 * k + i, 50 + i + k, 1, "1/1/2018", "True", "Approved", f"B{i + k}", "Road", "low", "small", "1", "1") for i in range(3)]
        loads[k].run(CUSTOMERS, [*TRANSACTIONS, *own])

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(run, range(3)))
    tables = loads[0].tables()
    check_integrity(tables)
    expected = [10, 11, 12, *(100 + 10 * k + i for k in range(3) for i in range(3))]
    assert sorted(r[0] for r in tables["transactions"].select("transaction_id").collect()) == expected
    assert bag(tables["brands"].select("brand_name"))[:5] == [(f"B{i}",) for i in range(5)]


def test_reports_over_some_months_read_these_alone(spark, tmp_path):
    load = Load(spark, tmp_path)
    more = [(100 + k, 7, 1, f"{k % 12 + 1}/5/2016", *TRANSACTIONS[0][4:]) for k in range(24)]
    load.run(CUSTOMERS, more[:12])
    load.run(CUSTOMERS, more)
    first, last = date(2016, 3, 5), date(2016, 5, 4)

    def check():
        report = jobs.wide_report(spark, load.base, first, last)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[isnotnull\(month#\d+\), \(month#\d+ >= 2016-03-01\), \(month#\d+ <= 2016-05-01\)\]", plan)
        assert [r[0] for r in bag(report.select("transaction_id"))] == [102, 103, 114, 115]
        months = spark.createDataFrame([(date(2016, 4, 1), "x"), (date(2016, 7, 1), "y")], "month date, season string")
        months.write.mode("overwrite").parquet(str(tmp_path / "months"))
        chosen = spark.read.parquet(str(tmp_path / "months")).filter("season = 'x'")
        joined = jobs.transactions_by_month(spark, load.base).join(chosen, "month")
        assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
        assert [r[0] for r in bag(joined.select("transaction_id"))] == [103, 115]

    check()
    before = load.content()
    jobs.compact_warehouse(spark, load.base, key_buckets=8)
    assert load.content() == before and load.tables()["transactions"].schema == schemas.TRANSACTIONS
    check()


def test_wide_tables_have_stated_keys():
    assert set(jobs.KEYS) == set(jobs.DIMENSION_TABLES) | set(jobs.FACT_TABLES)
    for name, keys in jobs.KEYS.items():
        assert {c for key in keys for c in key} <= set((jobs.DIMENSION_TABLES | jobs.FACT_TABLES)[name].names)
    assert isinstance(schemas.MEMBERS.names, list)
