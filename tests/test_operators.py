from decimal import Decimal

from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import bag, rows
from tradeloom import schemas
from tradeloom.operators import checks, dimensions, matching, numbering, ranking
from tradeloom.sources.files import empty
from tradeloom.sources.settled import settle


def table(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


# --- ranking --------------------------------------------------------------------------------------


def test_keep_first_takes_input_order_not_best(spark):
    df = table(spark, "k int, seq int, price int", (1, 5, 100), (1, 2, 10), (2, 9, 7), (None, 1, 3), (None, 4, 8))
    assert bag(ranking.keep_first(df, ["k"], "seq")) == bag(table(spark, "k int, seq int, price int", (1, 2, 10), (2, 9, 7), (None, 1, 3)))


def test_keep_best_prefers_missing_price_then_tie_break(spark):
    df = table(
        spark, "k int, price decimal(10,2), id int",
        (1, Decimal(5), 9), (1, Decimal(5), 3), (2, None, 4), (2, Decimal(9), 5), (3, Decimal(1), 6),
    )
    assert bag(ranking.keep_best(df, ["k"], "price", ["id"]).select("k", "id")) == [(1, 3), (2, 4), (3, 6)]


def test_nth_and_top_k_per_group(spark):
    df = table(spark, "k string, v int", ("a", 3), ("a", 1), ("a", 2), ("b", 1))
    assert rows(ranking.nth_per_group(df, ["k"], [F.col("v").asc()], 2)) == [("a", 2)]
    assert bag(ranking.top_k_per_group(df, ["k"], [F.col("v").desc()], 2)) == [("a", 2), ("a", 3), ("b", 1)]


def test_top_k_settles_ties_by_last_key(spark):
    df = table(spark, "id int, v int", (3, 1), (1, 1), (2, 1))
    assert rows(ranking.top_k(df, [F.col("v").desc(), F.col("id").asc()], 2)) == [(1, 1), (2, 1)]


# --- matching -------------------------------------------------------------------------------------


def test_resolve_id_with_and_without_default(spark):
    df = table(spark, "brand string", ("a",), ("zzz",), (None,))
    lookup = table(spark, "id bigint, name string", (7, "a"))
    assert bag(matching.resolve_id(df, "brand", lookup, "name", "brand_id", 0)) == bag(
        table(spark, "b string, i bigint", ("a", 7), ("zzz", 0), (None, 0))
    )
    assert bag(matching.resolve_id(df, "brand", lookup, "name", "brand_id")) == bag(
        table(spark, "b string, i bigint", ("a", 7), ("zzz", None), (None, None))
    )


def test_new_rows_on_one_and_two_keys(spark):
    incoming = table(spark, "a int, b string", (1, "x"), (1, "y"), (2, "x"))
    existing = table(spark, "a int, b string", (1, "x"))
    assert bag(matching.new_rows(incoming, existing, ["a"])) == [(2, "x")]
    assert bag(matching.new_rows(incoming, existing, ["a", "b"])) == [(1, "y"), (2, "x")]
    assert matching.new_rows(incoming, empty(spark, incoming.schema), ["a"]).count() == 3


def test_orphans_are_dropped_and_counted(spark):
    facts = table(spark, "id int, customer_id int", (1, 10), (2, 10), (3, 99), (4, None), (5, 11))
    parent = table(spark, "customer_id int", (10,), (11,), (11,), (None,))
    seen = Observation("orphans")
    kept = matching.reject_orphans(facts, parent, "customer_id", seen)
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 5]
    assert seen.get == {"kept": 3, "dropped": 2}
    assert bag(matching.reject_orphans(facts, parent, "customer_id")) == bag(kept)
    assert kept.columns == facts.columns


# --- numbering and dimensions ---------------------------------------------------------------------


def test_numbers_are_dense_and_continue(spark):
    fresh = spark.range(1000).select(F.concat(F.lit("name "), "id").alias("name"))
    existing = table(spark, "id bigint, name string", (0, "Unknown"), (41, "old"))
    got = sorted(r["id"] for r in numbering.number_members(fresh, existing, ["name"]).collect())
    assert got == list(range(42, 1042))


def test_numbers_do_not_depend_on_partitioning(spark):
    fresh = spark.range(500).select(F.concat(F.lit("n"), "id").alias("name"))
    none = empty(spark, schemas.MEMBERS)
    once = numbering.number_members(fresh.repartition(7), none, ["name"])
    again = numbering.number_members(fresh.repartition(2).orderBy(F.desc("name")), none, ["name"])
    assert bag(once) == bag(again)


def test_join_few_is_a_left_join(spark):
    rows = [(i, None if i % 7 == 0 else f"s{i % 3}") for i in range(400)] + [(5, "s2"), (None, "s0"), (None, None)]
    df = table(spark, "id bigint, status string", *rows)
    lookup = table(spark, "status string, status_id bigint", ("s0", 1), ("s1", 2), ("s9", 3))
    got = matching.join_few(df, lookup, "status", "id", shares=4)
    assert bag(got.select("id", "status", "status_id")) == bag(
        df.join(lookup, "status", "left").select("id", "status", "status_id")
    )
    assert bag(matching.join_few(df, lookup.limit(0), "status", "id").select("status_id")) == [(None,)] * len(rows)


def test_members_are_numbered_per_dimension_and_only_once(spark):
    source = table(
        spark, "brand string, line string", ("a", "x"), ("b", "x"), ("a", None), (None, "n/a"), ("N/A", "y")
    )
    found = dimensions.distinct_members(source, {"brands": "brand", "lines": "line"}, ["brands"])
    assert bag(found) == [("brands", "a"), ("brands", "b"), ("lines", "n/a"), ("lines", "x"), ("lines", "y")]
    first = dimensions.new_members(found, empty(spark, schemas.MEMBERS))
    assert sorted((r["dimension"], r["id"]) for r in first.collect()) == [
        ("brands", 1), ("brands", 2), ("lines", 1), ("lines", 2), ("lines", 3),
    ]
    assert dimensions.new_members(found, first).count() == 0
    more = found.unionByName(table(spark, "dimension string, name string", ("brands", "c"), ("sizes", "s")))
    assert bag(dimensions.new_members(more, first)) == [("brands", 3, "c"), ("sizes", 1, "s")]


def test_unknown_member_is_added_once(spark):
    members = table(spark, "dimension string, id bigint, name string", ("brands", 1, "a"), ("lines", 0, "Unknown"))
    once = dimensions.with_unknown_members(members, ["brands", "lines"])
    assert bag(once) == [("brands", 0, "Unknown"), ("brands", 1, "a"), ("lines", 0, "Unknown")]
    assert bag(dimensions.with_unknown_members(once, ["brands", "lines"])) == bag(once)


def nowhere(spark):
    return dimensions.Locations(
        empty(spark, schemas.COUNTRIES), empty(spark, schemas.STATES), empty(spark, schemas.POSTCODES)
    )


def test_location_hierarchy(spark):
    customers = table(
        spark, "country string, state string, postcode int",
        ("AU", "VIC", 3000), ("AU", "Victoria", 3000), ("AU", "New South Wales", 2000), ("AU", "NSW", 2000),
        ("NZ", "NSW", 3000), ("AU", "QLD", None), ("AU", None, 4000), (None, "WA", 6000), ("NZ", "Otago", 2000),
    )
    places = dimensions.distinct_places(customers)
    got = dimensions.new_locations(places, nowhere(spark), settle)
    country = {r["country_name"]: r["id"] for r in got.countries.collect()}
    assert sorted(country) == ["AU", "NZ"] and sorted(country.values()) == [1, 2]
    state = {(r["state_name"], r["country_id"]): r["id"] for r in got.states.collect()}
    assert set(state) == {
        ("Victoria", country["AU"]), ("NSW", country["AU"]), ("NSW", country["NZ"]),
        ("QLD", country["AU"]), ("Otago", country["NZ"]),
    }
    assert sorted(state.values()) == [1, 2, 3, 4, 5]
    # A postcode of several states belongs to the smallest state id; those without a state drop out.
    assert bag(got.postcodes) == [
        ("2000", min(state["NSW", country["AU"]], state["Otago", country["NZ"]])),
        ("3000", min(state["Victoria", country["AU"]], state["NSW", country["NZ"]])),
    ]
    again = dimensions.new_locations(places, got, settle)
    assert [df.count() for df in (again.countries, again.states, again.postcodes)] == [0, 0, 0]


# --- checks ---------------------------------------------------------------------------------------


def test_duplicate_keys(spark):
    df = table(spark, "a int, b int", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1))
    assert bag(checks.duplicate_keys(df, ["a", "b"])) == bag(table(spark, "a int, b int, n int", (1, 1, 2), (None, 1, 2)))


def test_missing_parents_ignores_null(spark):
    child = table(spark, "k int", (1,), (2,), (2,), (None,))
    parent = table(spark, "id int", (1,))
    assert bag(checks.missing_parents(child, "k", parent, "id")) == [(2, 2)]


def test_null_counts_and_defaults(spark):
    df = table(spark, "a int, b string", (1, None), (None, None), (3, "x"))
    assert bag(checks.null_counts(df, ["a", "b"])) == [("a", 1), ("b", 2)]
    filled = checks.with_defaults(df, {"a": 0, "b": "U"})
    assert rows(filled) == [(1, "U"), (0, "U"), (3, "x")]
    assert filled.schema["a"].dataType == df.schema["a"].dataType


def test_report_status(spark):
    good = table(spark, "a int", (1,), (2,))
    assert bag(checks.report_status({"good": good, "bad": good.filter("a > 5")})) == [
        ("bad", 0, False), ("good", 2, True),
    ]
