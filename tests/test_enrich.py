"""Value rules of the eleven types, on open payloads (VARIANT) as one batch."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import values as v
from tidemark.operators import enrich

# (type, payload, expected namespace)
CASES = [
    ("account", {"accounttype": "  Premium  ", "keep": 1}, {"accounttype": "Premium"}),
    ("account", {"accounttype": "   "}, None),
    ("account", {"accounttype": 123}, {"accounttype": "123"}),
    ("account", {"accounttype": ["x"]}, None),
    ("account", {"accounttype": False}, None),
    ("address", {"lat": "52.5200", "lng": "13.4050", "city": " Berlin ", "country": " DE "},
     {"lat": 52.52, "lng": 13.405, "city": "Berlin", "country": "DE"}),
    ("address", {"lat": 200, "lng": 13, "city": "X"}, {"city": "X"}),
    ("address", {"lat": "x", "lng": "y", "city": "X"}, {"city": "X"}),
    ("address", {"lat": 999, "lng": 999, "city": " ", "country": ""}, None),
    ("address", {"lat": "1e1", "lng": " 5 "}, {"lat": 10.0, "lng": 5.0}),
    ("address", {"lat": "1d", "lng": "5"}, None),
    ("address", {"lat": True, "lng": 5, "city": 12}, None),
    ("address", {"lat": 0, "lng": -180}, {"lat": 0.0, "lng": -180.0}),
    ("contact", {"firstname": " Ada ", "lastname": " L ", "dateofbirth": "1980-02-03"},
     {"firstname": "Ada", "lastname": "L", "dateofbirth": "1980-02-03", "birth_ts": 318384000}),
    ("contact", {"dateofbirth": "03.02.1980"}, None),
    ("contact", {"dateofbirth": "2020-02-31"}, None),
    ("contact", {"dateofbirth": "0999-02-01"}, None),
    ("contact", {"firstname": 123, "lastname": True}, {"firstname": "123", "lastname": "1"}),
    ("contact", {"firstname": 1.5, "lastname": 2.0}, {"firstname": "1.5", "lastname": "2"}),
    ("contact", {"dateofbirth": "1960-01-01"}, {"dateofbirth": "1960-01-01", "birth_ts": -315619200}),
    ("date", {"start": "2020-01-02 03:04:05", "end": "2020-01-03"}, {"start_ts": 1577934245, "end_ts": 1578009600}),
    ("date", {"start": "0000-00-00 00:00:00", "end": "not-a-date"}, None),
    ("date", {"end": "0000-00-00"}, None),
    ("date", {"start": "2020-02-31"}, {"start_ts": 1583107200}),
    ("date", {"start": "2020-13-01 25:00:00"}, {"start_ts": 1609549200}),
    ("date", {"allday": True}, {"allday": 1}), ("date", {"allday": "no"}, {"allday": 0}),
    ("date", {"allday": 1}, {"allday": 1}), ("date", {"allday": " OFF "}, {"allday": 0}),
    ("date", {"allday": "maybe"}, None), ("date", {"allday": 1.0}, None), ("date", {"allday": None}, None),
    ("file", {"mime": " a/b ", "filename": " f ", "url": " u ", "size": "123"},
     {"mime_type": "a/b", "filename": "f", "size": 123, "url": "u"}),
    ("file", {"size": 42}, {"size": 42}), ("file", {"size": "0042"}, {"size": 42}),
    ("file", {"size": "42.5"}, None), ("file", {"size": 0}, None), ("file", {"size": " 42"}, None),
    ("file", {"size": -3, "mime": 5}, None),
    ("product", {"code": " P-001 ", "weight": "42"}, {"code": "P-001", "weight": 42}),
    ("product", {"weight": 7}, {"weight": 7}), ("product", {"weight": True}, {"weight": 1}),
    ("product", {"weight": 2.4}, {"weight": 2}), ("product", {"weight": 2.6}, {"weight": 3}),
    ("product", {"weight": 2.5}, {"weight": 3}), ("product", {"weight": -2.5}, {"weight": -3}),
    ("product", {"weight": " -12 "}, {"weight": -12}), ("product", {"weight": "42.5"}, None),
    ("product", {"weight": "99999999999999999999"}, {"weight": 9223372036854775807}),
    ("product", {"weight": "-99999999999999999999"}, {"weight": -9223372036854775808}),
    ("project", {"projid": " 1 ", "alias": " A ", "start": "2020-01-01", "deadline": "2020-02-01"},
     {"projid": "1", "alias": "A", "start_ts": 1577836800, "deadline_ts": 1580515200}),
    ("project", {"start": "2020-02-31", "deadline": "not-a-date", "projid": " "}, None),
    ("resource", {"quota": " 100 ", "used": 50}, {"quota": 100, "used": 50}),
    ("resource", {"quota": " -12 ", "used": False}, {"quota": -12, "used": 0}),
    ("tag", {"tag": "  Hello  "}, {"tag": "Hello"}), ("tag", {"tag": "   "}, None), ("tag", {"tag": 123}, {"tag": "123"}),
    ("task", {"start": "2020-01-01", "deadline": "2020-02-01", "expense": "42", "done": "yes"},
     {"start_ts": 1577836800, "deadline_ts": 1580515200, "expense": 42, "done": 1}),
    ("task", {"expense": "1.5", "done": "maybe", "start": "x"}, None),
    ("task", {"expense": 7.2, "done": "1"}, {"expense": 7, "done": 1}), ("task", {"done": 0}, {"done": 0}),
    ("text", {"mime": " text/plain "}, {"mime": "text/plain"}), ("text", {"mime": " "}, None),
    ("text", {"mime": 123}, {"mime": "123"}), ("text", {"mime": "\t\x0b\n"}, None),
]


def items_of(spark, rows):
    """(id, alias in content, alias in metadata, payload) as an item frame."""
    data = [(i, a, m, json.dumps(p)) for i, (a, m, p) in enumerate(rows)]
    frame = spark.createDataFrame(data, "job_id int, a string, type_alias string, p string")
    return frame.select(
        "job_id", "type_alias",
        F.struct(F.struct(F.col("a").alias("alias")).alias("type"), F.parse_json("p").alias("payload")).alias("content"))


def test_value_rules(spark):
    items = items_of(spark, [(alias, None, payload) for alias, payload, _ in CASES])
    got = {r["job_id"]: r for r in enrich.enrich_items(items).drop("content").collect()}
    for i, (alias, payload, expected) in enumerate(CASES):
        found = got[i][alias]
        found = found and {k: x for k, x in found.asDict().items() if x is not None}
        assert found == expected, (alias, payload)
        assert all(got[i][other] is None for other in enrich.RULES if other != alias)
        assert got[i]["parser"] == alias


def test_routing(spark):
    rows = [
        ("account", None, {"accounttype": "a"}), (None, "account", {"accounttype": "a"}),
        ("  AcCoUnT  ", "text", {"accounttype": "a"}), ("  ", "account", {"accounttype": "a"}),
        ("other", None, {"accounttype": "a"}), (None, None, {"accounttype": "a"}),
    ]
    got = {r["job_id"]: r for r in enrich.enrich_items(items_of(spark, rows)).drop("content").collect()}
    assert [got[i]["parser"] for i in range(6)] == ["account"] * 4 + ["fallback"] * 2
    assert [got[i]["account"] is not None for i in range(6)] == [True] * 4 + [False] * 2


def test_parsed_value_wins_and_others_stay(spark):
    items = items_of(spark, [("contact", None, {"firstname": "New"}), ("contact", None, {"firstname": " "})])
    old = F.struct(
        F.lit("Old").alias("firstname"), F.lit("Kept").alias("lastname"),
        F.lit(None).cast("string").alias("dateofbirth"), F.lit(None).cast("bigint").alias("birth_ts"))
    got = enrich.enrich_items(items.withColumn("contact", old)).orderBy("job_id").select("contact.*").collect()
    assert [(r.firstname, r.lastname) for r in got] == [("New", "Kept"), ("Old", "Kept")]


def test_merge_maps(spark):
    row = spark.sql(
        "SELECT map('a', '1', 'b', '2') old, map('b', '3', 'c', '4') new, cast(map() AS map<string,string>) none, "
        "cast(NULL AS map<string,string>) missing")
    got = row.select(
        enrich.merge_maps(F.col("old"), F.col("new")).alias("m"), enrich.merge_maps(F.col("old"), F.col("none")).alias("n"),
        enrich.merge_maps(F.col("old"), F.col("missing")).alias("k")).first()
    assert got.m == {"a": "1", "b": "3", "c": "4"}
    assert got.n == got.k == {"a": "1", "b": "2"}


@pytest.mark.parametrize("number, expected", [
    (1.0, "1"), (0.1 + 0.2, "0.3"), (-2.5, "-2.5"), (1e15, "1.0E+15"), (12345678901234.0, "12345678901234"), (1e14, "1.0E+14"),
    (1e25, "1.0E+25"), (1.5e-7, "1.5E-7"), (0.0001, "0.0001"), (0.0, "0"), (100000.0, "100000")])
def test_float_text(spark, number, expected):
    got = spark.range(1).select(v.float_text(F.lit(number)).alias("t")).first().t
    assert got == expected
