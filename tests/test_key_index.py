import random
import re

import pytest

from conftest import bag
from test_jobs import CUSTOMERS, TRANSACTIONS, Load
from tradeloom.operators.matching import new_rows
from tradeloom.plans import jobs
from tradeloom.sources import key_index
from tradeloom.sources.snapshots import latest_snapshot, remove_old_snapshots


@pytest.fixture
def shuffled(spark):
    """No side is small enough to be broadcast, and there are more shuffle partitions than buckets."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_over(text, relation):
    """Shuffles between the scans of a relation and the joins above them."""
    lines = text.splitlines()
    depth = lambda line: re.search(r"[+:]- ", line).start() if re.search(r"[+:]- ", line) else -1
    found = 0
    for i, line in enumerate(lines):
        if relation in line and "Scan" in line:
            at = depth(line)
            for above in reversed(lines[:i]):
                if depth(above) < at:
                    at = depth(above)
                    found += "Exchange" in above
                    if "Join" in above:
                        break
    return found


def test_new_rows_without_shuffling_the_history(spark, tmp_path, shuffled):
    draw = random.Random(1)
    parts = [[(draw.randint(0, 400), draw.choice("ab")) for _ in range(150)] for _ in range(3)]
    parts[1] += [(7, "a")] * 200 + [(None, "a")]
    incoming = [(draw.randint(0, 500), draw.choice("ab"), i) for i in range(300)] + [(None, "a", -1), (7, "a", -2)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    base, keys, columns = str(tmp_path), ["k", "v"], "k bigint, v string"
    folders = [key_index.stage_keys(frame(p, columns), base, "t_keys", keys, 8) for p in parts]
    history = key_index.read_keys(spark, base, folders, columns, keys)
    fresh = new_rows(frame(incoming, columns + ", i int"), history, keys)
    text = plan(fresh)
    assert text.count("Exchange hashpartitioning") == 1 and exchanges_over(text, "key_index_") == 0
    assert len(re.findall("SortMergeJoin .*LeftAnti", text)) == 3
    known = {x for p in parts for x in p if x[0] is not None}
    assert bag(fresh) == sorted((r for r in incoming if r[:2] not in known), key=repr)


def test_index_is_read_by_a_session_that_did_not_write_it(spark, tmp_path, shuffled):
    base = str(tmp_path / "it's here")
    folder = key_index.stage_keys(spark.range(100).toDF("k"), base, "t_keys", ["k"], 4)
    key_index.forget_keys(spark, base, [folder])
    (history,) = key_index.read_keys(spark, base, [folder], "k bigint", ["k"])
    fresh = new_rows(spark.range(95, 105).toDF("k"), [history], ["k"])
    assert bag(fresh) == [(k,) for k in range(100, 105)] and exchanges_over(plan(fresh), "key_index_") == 0


def test_empty_history_and_empty_batches(spark, tmp_path):
    incoming = spark.range(3).toDF("k")
    assert bag(new_rows(incoming, [], ["k"])) == [(0,), (1,), (2,)]
    folder = key_index.stage_keys(incoming.limit(0), str(tmp_path), "t_keys", ["k"], 4)
    history = key_index.read_keys(spark, str(tmp_path), [folder], "k bigint", ["k"])
    assert bag(new_rows(incoming, history, ["k"])) == [(0,), (1,), (2,)]


def test_loads_read_the_index_and_compaction_keeps_it(spark, tmp_path, shuffled):
    load = Load(spark, tmp_path)
    load.run()
    for k in range(3):
        load.run(CUSTOMERS, [*TRANSACTIONS, (50 + k, 90 + k, 1, *TRANSACTIONS[0][3:])])
    before, opened = load.content(), latest_snapshot(spark, load.base)
    for table in jobs.FACT_TABLES:
        parts = jobs.fact_keys(spark, opened, table)
        keys = parts[0]
        for more in parts[1:]:
            keys = keys.unionAll(more)
        assert len(parts) == (1 if table == "customers" else 4)
        assert bag(keys) == bag(load.tables()[table].select(*jobs.KEYS[table][0]))
        fresh = new_rows(spark.range(1000).toDF(*jobs.KEYS[table][0]), parts, jobs.KEYS[table][0])
        assert exchanges_over(plan(fresh), "key_index_") == 0

    after = jobs.compact_warehouse(spark, load.base, key_buckets=8)
    assert all(len(names) == 1 for names in after.folders.values())
    assert load.content() == before
    remove_old_snapshots(spark, load.base, keep=1, older_than_hours=0)
    load.run(CUSTOMERS, [*TRANSACTIONS, (50, 90, 1, *TRANSACTIONS[0][3:]), (60, 90, 1, *TRANSACTIONS[0][3:])])
    assert {r[0] for r in set(load.content()["transactions"]) - set(before["transactions"])} == {60}
