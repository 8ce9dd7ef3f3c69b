"""Operators on small tables with the cases the sample data lacks."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from haulbook.operators import filters, scorecard
from haulbook.operators.activity import active_drivers, active_entities
from haulbook.operators.latest import latest_per_key, latest_wide_rows, row_mark
from haulbook.operators.lists import array_list_columns, listagg_distinct, tag_rows
from haulbook.operators.routes import active_route_drivers, route_drivers, route_history

AS_OF = date(2024, 5, 31)  # the window opens on 2024-05-01
IN, EDGE = datetime(2024, 5, 20), datetime(2024, 5, 1)
OUT, FUTURE = datetime(2024, 4, 30, 23, 59, 59), datetime(2025, 1, 1)
DELIVERY = """delivery_id long, delivery_external_id string, carrier_external_id string, carrier_name string,
    driver_external_id string, driver_name string, delivery_type string, created_at timestamp_ntz,
    is_completed_delivery boolean, customer_rating double"""
ETA = "delivery_id long, seconds_to_origin_delta long, seconds_to_destination_delta long"
VIOLATION = """delivery_external_id string, carrier_external_id string, carrier_name string, driver_external_id string,
    driver_name string, delivery_type string, created_at timestamp_ntz, violation_type_code string"""


def delivery(id, carrier="C1", driver="D1", kind="hotshot", at=IN, done=True, rating=None, external=None):
    return (id, external or f"X{id}", carrier, f"name of {carrier}", driver, f"name of {driver}", kind, at, done, rating)


def violation(id, code, carrier="C1", driver="D1", kind="hotshot", at=IN, name=None):
    name = name or f"name of {carrier}"
    return (f"X{id}", carrier, name, driver, f"name of {driver}", kind, at, code)


@pytest.fixture(scope="module")
def deliveries(spark):
    data = [
        delivery(1, rating=5.0),
        delivery(2, at=EDGE, rating=4.0, driver="D2"),
        delivery(3, at=OUT, rating=1.0),  # rated all time, not in the window
        delivery(4, at=FUTURE),
        delivery(5, done=False),
        delivery(6, done=None),
        delivery(7, kind="route"),
        delivery(8, kind=None),
        delivery(9, carrier=None),
        delivery(10, driver=None),
        (None, None, "C1", "n", "D1", "n", "msd", IN, True, None),  # no ids: accurate, no ETA
        delivery(11, carrier="C2", driver="D3"),
        delivery(11, carrier="C2", driver="D3"),  # repeated delivery
        delivery(12, carrier="C3", driver="D4", done=False),
    ]
    return spark.createDataFrame(data, DELIVERY)


@pytest.fixture(scope="module")
def violations(spark):
    data = [
        violation(1, "wrong_vehicle"),
        violation(1, "wrong_accessories"),  # one delivery, two violations
        violation(2, "wrong_vehicle", at=OUT),
        violation(4, "wrong_vehicle", kind="cms"),
        violation(11, "did_not_deliver_all_items", carrier="C9", driver="D9"),  # reported by another carrier
        violation(12, "self_unassignment", carrier="C3", driver="D4", name="another name"),
        violation(10, "late_arrival"),
        violation(10, "scheduled_delivery_failure", driver=None),
    ]
    return spark.createDataFrame(data, VIOLATION)


@pytest.fixture(scope="module")
def etas(spark):
    data = [(1, -1800, -1801), (1, 1620, 720), (2, 1621, 721), (4, None, None), (11, 0, 0), (None, 0, 0), (99, 0, 0)]
    return spark.createDataFrame(data, ETA)


def test_lookback_bounds(deliveries):
    kept = filters.in_lookback(deliveries, AS_OF).select("delivery_id").collect()
    assert {r[0] for r in kept} >= {2, 4} and 3 not in {r[0] for r in kept}


def test_completions(deliveries, violations, rows):
    got = scorecard.completions(deliveries, violations, as_of=AS_OF)
    # C1: deliveries 1, 2, 4, 10 and the one without id; only 1 has an accuracy violation in the window.
    assert rows(got.select("carrier_external_id", "completed_deliveries", "accurate_deliveries", "driver_count")) == [
        ("C1", 5, 4, 2),
        ("C2", 2, 0, 1),
    ]
    by_driver = scorecard.completions(deliveries, violations, scorecard.DRIVER, AS_OF)
    assert rows(by_driver) == [("D1", 4, 3), ("D2", 1, 1), ("D3", 2, 0)]
    assert rows(scorecard.distinct_drivers(deliveries, AS_OF)) == [("C1", 2), ("C2", 1)]


def test_ratings_ignore_the_window(deliveries, rows):
    assert rows(scorecard.ratings(deliveries)) == [("C1", 10.0 / 3, 3), ("C2", None, 0)]


def test_on_time_counts_pairs(deliveries, etas, rows):
    # C1: two rows for delivery 1, one each for 2 and 4; C2: one ETA row for a delivery stored twice.
    assert rows(scorecard.on_time(deliveries, etas, as_of=AS_OF)) == [("C1", 4, 50.0, 25.0), ("C2", 2, 100.0, 100.0)]


def test_scorecard_of_entities_without_data(spark, deliveries, violations, etas):
    ids = spark.createDataFrame([("C1",), ("C2",), ("C3",), ("C4",)], "external_id string")
    card = scorecard.scorecard(ids, "external_id", deliveries, violations, etas, as_of=AS_OF)
    assert card.columns[1:] == list(scorecard.scorecard_columns(scorecard.CARRIER))
    got = {r[0]: tuple(r)[1:] for r in card.collect()}
    assert got["C1"] == (2, 5, 1, 83.33, 4, 80.0, 3.33, 3, 4, 50.0, 25.0)
    assert got["C2"] == (1, 2, 0, 100.0, 0, 0.0, None, 0, 2, 100.0, 100.0)
    assert got["C3"] == (0, 0, 1, 0.0, 0, None, None, 0, None, None, None)
    assert got["C4"] == (0, 0, 0, None, 0, None, None, 0, None, None, None)


def test_one_hot_delivery_id_does_not_multiply(spark, rows):
    """Delivery id and ETA id repeat 2000 times each: four million pairs are counted, none is built."""
    same = spark.createDataFrame([delivery(1)] * 2000, DELIVERY)
    eta = spark.createDataFrame([(1, 0, 9999)] * 2000, ETA)
    assert rows(scorecard.on_time(same, eta, as_of=AS_OF)) == [("C1", 4_000_000, 100.0, 0.0)]


def test_active_entities_keep_both_names(deliveries, violations, rows):
    got = rows(active_entities(deliveries, violations, as_of=AS_OF))
    assert [r for r in got if r[0] == "C3"] == [("C3", "another name"), ("C3", "name of C3")]
    assert [r for r in got if r[0] == "C1"] == [("C1", "name of C1")]
    assert ("D9", "name of D9", "C9", "name of C9") in rows(active_drivers(deliveries, violations, AS_OF))


def test_latest_breaks_ties_the_same_way(spark, rows):
    data = [("a", 1, x) for x in "pqrs"] + [("b", None, "t"), ("b", 0, "u"), (None, 5, "v"), (None, 6, "w")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    first = rows(latest_per_key(df, "k", "t"))
    assert first == rows(latest_per_key(df.repartition(7, "v"), "k", "t"))
    assert [r for r in first if r[0] != "a"] == [("b", 0, "u"), (None, 6, "w")]
    assert rows(latest_per_key(df, "k", "t", [F.col("v").desc()]))[0] == ("a", 1, "s")


def test_list_columns(spark, rows):
    data = [
        ("a", ["x", "x", None], ["m"]),
        ("a", ["w"], ["m", "n"]),
        ("a", ["lost"], []),
        ("b", [None], ["o"]),
        ("c", [], ["p"]),
        ("d", None, ["p"]),
    ]
    df = spark.createDataFrame(data, "k string, xs array<string>, ys array<string>")
    assert rows(array_list_columns(df, "k", {"xs": "x_list", "ys": "y_list"})) == [("a", "w;x", "m;n"), ("b", "", "o")]


def test_list_columns_of_a_hot_key(spark):
    """A key with very many rows holds each distinct element once."""
    df = spark.range(20_000).selectExpr("'k' as k", "array(cast(id % 5 as string)) as xs", "array('y') as ys")
    assert array_list_columns(df, "k", {"xs": "x_list", "ys": "y_list"}).collect() == [("k", "0;1;2;3;4", "y")]


def test_listagg_and_tags(spark, rows):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", "z"), ("b", None)], "k string, v string")
    assert rows(listagg_distinct(df, "k", "v", "vs")) == [("a", "b;z"), ("b", "")]
    tags = spark.createDataFrame([("a", ["Vest (ppe)", "Rope"]), ("b", None), ("c", [])], "k string, xs array<string>")
    assert rows(tag_rows(tags, "k", "xs", "%(PPE)%", "tag")) == [("a", "Vest (ppe)")]


def test_not_blank_and_exclusions(spark, rows):
    df = spark.createDataFrame([("a", "x@y"), (" ", " X@y"), ("", None), (None, "z@y")], "name string, mail string")
    listed = spark.createDataFrame([("x@y",), ("other",)], "mail string")
    assert rows(df.filter(filters.not_blank(F.col("name"), "", " ")).select("name")) == [("a",)]
    assert rows(filters.without_listed(df, listed, "mail").select("mail")) == [(" X@y",), ("z@y",)]


def test_routes(spark, rows):
    day = date(2024, 5, 24)
    early = date(2024, 5, 23)
    data = [(1, 1, 1, day), (2, 1, 1, day), (2, 1, 1, early), (3, 2, 1, early), (9, None, 1, day), (1, 2, 9, None)]
    routes = spark.createDataFrame(data, "route_template_id long, driver_id long, carrier_id long, fulfilled_on date")
    templates = spark.createDataFrame([(1, "T1"), (2, "T0"), (3, "T3")], "id long, external_id string")
    drivers = spark.createDataFrame([(1, "D1"), (2, "D2"), (3, "D3")], "driver_id long, driver_external_id string")
    carriers = spark.createDataFrame([(1, "C1")], "id long, external_id string")
    # Same day, two templates: the smaller id. The 23rd is eight days back. A route without driver counts as one.
    assert rows(active_route_drivers(routes, templates, drivers, AS_OF)) == [("D1", "T0", True), (None, None, True)]
    assert rows(route_drivers(routes, drivers)) == [("D1",), ("D2",)]
    history = route_history(routes.union(routes), templates, drivers, carriers, AS_OF)
    assert rows(history) == sorted(
        [
            ("D1", "C1", "T1", day, True),
            ("D1", "C1", "T0", day, True),
            ("D1", "C1", "T0", early, False),
            ("D2", "C1", "T3", early, False),
            (None, "C1", None, day, True),
            ("D2", None, "T1", None, None),
        ],
        key=repr,
    )


def test_latest_per_key_tells_shifted_nulls_apart(spark):
    data = [("k", None, "x"), ("k", "x", None)]
    picks = set()
    for rows in (data, data[::-1]):
        df = spark.createDataFrame(rows, "k string, a string, b string").withColumn("t", F.lit(1))
        picks.add(tuple(latest_per_key(df.coalesce(1), "k", "t").select("a", "b").first()))
    assert len(picks) == 1


def test_null_in_the_exclusion_list_excludes_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "e string")
    listed = spark.createDataFrame([("a",), (None,)], "e string")
    assert [r.e for r in filters.without_listed(df, listed, "e").collect()] == ["b"]


def test_latest_wide_rows_are_those_of_latest_per_key(spark, rows):
    """Null keys and dates, ties, rows that come twice, a null where another row has its value, keys without facts."""
    data = [
        ("a", 1, "p", None), ("a", 1, "q", None), ("a", 1, "q", None), ("a", 0, "z", "z"), ("a", None, "y", "y"),
        ("b", None, None, "r"), ("b", None, "r", None), ("b", None, "r", None), (None, 3, "s", "t"), (None, 3, "s", "t"),
        (None, 2, "u", "u"), ("", 3, "s", "t"), (None, None, None, None), ("c", 5, None, None), ("c", 5, None, None),
    ]
    df = spark.createDataFrame(data, "k string, t int, v string, w string")
    facts = spark.createDataFrame([("a", 10), ("c", None), ("", 30), ("d", 40)], "k string, n int")
    marked = df.withColumn("mark", row_mark(df.columns))
    want = rows(latest_per_key(df, "k", "t").join(facts, "k", "left").select("k", "t", "v", "w", "n"))
    assert len(want) == 5
    for parts in (1, 7):
        got = latest_wide_rows(marked.repartition(parts), "k", "t", "mark", facts)
        assert got.columns == ["k", "t", "v", "w", "n"] and rows(got) == want
