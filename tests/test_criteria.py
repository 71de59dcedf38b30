import random
from datetime import date, datetime

import pytest

from conftest import bag
from tradeloom.functions.criteria import matches
from tradeloom.plans import documents

SCHEMA = (
    "_id int, year int, title string, genres array<string>, live boolean, on date, at timestamp, "
    "place struct<city: string, geo: array<double>>, cast array<struct<name: string, roles: array<string>>>, "
    "tags map<string, int>"
)
DOCS = [
    (1, 1940, "One", ["Horror", "Drama"], True, date(2020, 1, 1), datetime(2020, 1, 1, 5), ("Rome", [1.5, 2.5]),
     [("Ann", ["x", "y"]), ("Bob", [])], {"a": 1}),
    (2, None, "Two", ["Film-Noir"], False, None, None, ("Oslo", None), [("Cy", None)], {"a": 2, "b": 3}),
    (3, 1955, None, [], None, date(2021, 5, 5), None, None, [], None),
    (4, 1949, "Four", None, True, None, None, (None, []), None, {}),
    (5, 1945, "Drama", ["Drama", None, "Horror"], None, None, None, ("Rome", [9.0]), [("Ann", ["z"]), (None, ["x"])], {"b": 3}),
]
FIELDS = [f.split(":")[0].split()[0] for f in ("_id", "year", "title", "genres", "live", "on", "at", "place", "cast", "tags")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


CASES = [
    ({}, [1, 2, 3, 4, 5]),
    ({"genres.0": "Horror"}, [1]),
    ({"genres": "Horror"}, [1, 5]),
    ({"genres": ["Film-Noir"]}, [2]),
    ({"genres": ["Horror"]}, []),
    ({"genres": {"$size": 0}}, [3]),
    ({"genres.1": None}, [2, 3, 4, 5]),
    ({"year": {"$gte": 1940, "$lte": 1949}}, [1, 4, 5]),
    ({"year": {"$gt": 1940, "$lt": 1949}}, [5]),
    ({"year": None}, [2]),
    ({"year": {"$ne": 1940}}, [2, 3, 4, 5]),
    ({"year": {"$not": {"$gte": 1945}}}, [1, 2]),
    ({"year": {"$in": [1940, None]}}, [1, 2]),
    ({"year": {"$nin": [1940, 1949]}}, [2, 3, 5]),
    ({"year": "1940"}, []),
    ({"title": 1940}, []),
    ({"title": {"$gte": "One"}}, [1, 2]),
    ({"title": {"$exists": False}}, [3]),
    ({"live": True}, [1, 4]),
    ({"live": 1}, []),
    ({"live": {"$ne": True}}, [2, 3, 5]),
    ({"on": date(2020, 1, 1)}, [1]),
    ({"on": {"$gt": date(2020, 1, 1)}}, [3]),
    ({"at": {"$lt": datetime(2020, 1, 1, 6)}}, [1]),
    ({"place.city": "Rome"}, [1, 5]),
    ({"place": {"city": "Oslo", "geo": None}}, [2]),
    ({"place": {"city": "Rome"}}, []),
    ({"place.geo": {"$gt": 2}}, [1, 5]),
    ({"place.geo.0": {"$lt": 2}}, [1]),
    ({"cast.name": "Ann"}, [1, 5]),
    ({"cast.0.name": {"$in": ["Cy", "Bob"]}}, [2]),
    ({"cast.roles": "x"}, [1, 5]),
    ({"cast.1.roles.0": "x"}, [5]),
    ({"tags.b": 3}, [2, 5]),
    ({"tags.c": {"$exists": True}}, []),
    ({"nothing.here": 1}, []),
    ({"nothing.here": None}, [1, 2, 3, 4, 5]),
    ({"nothing": {"$ne": 1}}, [1, 2, 3, 4, 5]),
    ({"$or": [{"genres.0": "Horror"}, {"genres.0": "Film-Noir"}], "year": {"$lte": 1949}}, [1]),
    ({"$and": [{"genres": "Horror"}, {"genres": "Drama"}]}, [1, 5]),
    ({"$nor": [{"year": {"$lt": 1950}}, {"title": "Two"}]}, [3]),
    ({"$or": [{"year": None}, {"$and": [{"live": True}, {"$nor": [{"title": "One"}]}]}]}, [2, 4]),
    ({"genres": {"$ne": "Horror"}}, [2, 3, 4]),
    ({"genres": {"$in": ["Film-Noir", "Drama"]}}, [1, 2, 5]),
]


@pytest.mark.parametrize("document, expected", CASES, ids=[str(c[0])[:60] for c in CASES])
def test_documents_found(docs, document, expected):
    assert [r[0] for r in bag(documents.find(docs, document).select("_id"))] == expected


def test_negations_part_the_documents(docs):
    draw = random.Random(1)
    plain = [d for d, _ in CASES if d]
    for _ in range(15):
        one, two = draw.choice(plain), draw.choice(plain)
        ids = lambda d: {r[0] for r in documents.find(docs, d).select("_id").collect()}
        assert ids({"$nor": [one]}) == {1, 2, 3, 4, 5} - ids(one)
        assert ids({"$or": [one, two]}) == ids(one) | ids(two)
        assert ids({"$and": [one, two]}) == ids(one) & ids(two)


@pytest.mark.parametrize(
    "document", [{"$xor": []}, {"year": {"$near": 1}}, {"$or": []}, {"$or": "x"}, {"year": {"$gt": 1, "b": 2}}]
)
def test_what_is_no_filter_is_refused(docs, document):
    with pytest.raises(ValueError):
        matches(docs.schema, document)


def test_names_with_dots_and_quotes(spark):
    docs = spark.createDataFrame([(1, "x")], "`a``b` int, c string")
    assert documents.find(docs, {"a`b": 1, "c": "x"}).count() == 1


def test_conditions_reach_the_scan(docs, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    stored = docs.sparkSession.read.parquet(str(tmp_path / "docs"))
    wanted = {
        "year": {"$gte": 1940, "$lte": 1949}, "place.city": "Rome", "$or": [{"title": "One"}, {"title": "Drama"}],
        "_id": {"$in": [1, 2, 5]}, "live": True,
    }
    found = documents.find(stored, wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for pushed in (
        "GreaterThanOrEqual(year,1940)", "LessThanOrEqual(year,1949)", "EqualTo(place.city,Rome)",
        "Or(EqualTo(title,One),EqualTo(title,Drama))", "In(_id, [1,2,5])", "EqualTo(live,true)",
    ):
        assert pushed in plan
    assert [r["_id"] for r in found.collect()] == [1]
