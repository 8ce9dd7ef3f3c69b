"""Balanced joins give the rows of the plain join and do spread a hot key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from haulbook.operators import joins, members, scorecard
from haulbook.operators.joins import exists_flag, fanout_join, fanout_keys, lookup_join
from haulbook.operators.latest import latest_per_key
from haulbook.operators.members import possible_members


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows: a third on one key, a sixth on null, exact copies among them."""
    other = F.concat(F.lit("k"), F.col("id") % 40)
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None).otherwise(other)
    return spark.range(0, 600, 1, 6).select(key.alias("k"), (F.col("id") % 50).alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    data = [("hot", "h"), ("hot", "h2"), ("k1", "one"), ("k1", "one"), ("k2", "two"), (None, "never"), ("unused", "u")]
    return spark.createDataFrame(data, "k string, w string")


def test_lookup_join_equals_left_join(skewed, lookup, rows, shuffled_joins):
    got = lookup_join(skewed, lookup, ["k"], ["v"])
    assert rows(got) == rows(skewed.join(lookup, "k", "left"))


def test_lookup_join_of_different_integer_types(spark, rows, shuffled_joins):
    left = spark.range(0, 9).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    right = spark.range(3, 12).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    assert rows(lookup_join(left, right, ["k"], ["v"])) == rows(left.join(right, "k", "left"))


def test_lookup_join_with_two_keys(spark, rows, shuffled_joins):
    data = [("a", 1, i) for i in range(50)] + [(None, 1, 1), ("b", None, 2), ("b", 2, 3)]
    left = spark.createDataFrame(data, "x string, y int, z int")
    right = spark.createDataFrame([("a", 1, "w"), ("b", 2, "q"), (None, 1, "no")], "x string, y int, w string")
    got = lookup_join(left, right, ["x", "y"], ["z"])
    assert rows(got) == rows(left.join(right, ["x", "y"], "left"))


SPLIT = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
}


@pytest.fixture
def split(spark, shuffled_joins):
    """Adaptive execution at the scale of a test."""
    before = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def task_rows(df):
    """Rows that each task of the last join gives."""
    tasks = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("w"), F.max("v"))
    return sorted(r.n for r in tasks.collect())


@pytest.mark.parametrize("hot", [1, 20])
def test_lookup_join_splits_every_hot_key(spark, split, hot):
    """One key, or twenty, with a third of the rows, and null keys with a third."""
    key = F.when(F.col("id") % 3 == 0, -1 - (F.col("id") / 3).cast("long") % hot)
    key = key.when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256)  # does not compress, so bytes go by rows
    left = spark.range(0, 120_000, 1, 16).select(key.alias("k"), text.alias("v"))
    right = left.select("k").dropna().distinct().withColumn("w", F.lit(1))
    tasks = task_rows(lookup_join(left, right, ["k"], ["v"]))
    assert sum(tasks) == 120_000 and tasks[-1] < 2.5 * 120_000 / 64


@pytest.fixture(autouse=True)
def large(monkeypatch):
    """Every table counts as large."""
    monkeypatch.setattr(members, "FILTER_FROM", 0)
    monkeypatch.setattr(joins, "BYTES_PER_ROW", 0)


def test_fanout_keys_have_slots_by_their_matches(spark):
    counted = spark.range(0, 300).select((F.col("id") % 10).alias("k"), F.lit(1).alias("n"))
    assert fanout_keys(counted, ["k"], F.col("n"), 40).count() == 0  # 30 matches each
    hot = counted.unionByName(spark.range(0, 95).select(F.lit(-1).alias("k"), F.lit(1).alias("n")))
    assert [tuple(r) for r in fanout_keys(hot, ["k"], F.col("n"), 40).collect()] == [(-1, 3)]


def test_fanout_join_splits_a_left_key_and_its_matches(spark, split):
    left = spark.range(0, 60, 1, 4).select(F.when(F.col("id") < 20, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 9_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 60).alias("k"), F.col("id").alias("w"))
    got = fanout_join(left, right, ["k"], ["v"], rows_per_slot=50)
    want = left.join(right, "k", "left")
    assert got.agg(F.count("*"), F.sum("w"), F.sum("v")).first() == want.agg(F.count("*"), F.sum("w"), F.sum("v")).first()
    tasks = task_rows(got)
    assert tasks[-1] < sum(tasks) / 8  # a plain join gives most of them in one task


def test_fanout_join_of_a_left_key_that_is_hot(spark, split):
    """One (mail, id) on a third of the left rows: no task of the join has many more than the others."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256)  # does not compress, so bytes go by rows
    left = spark.range(0, 120_000, 1, 16).select(key.alias("k"), F.concat(F.lit("m"), key).alias("mail"), text.alias("v"))
    right = spark.range(0, 3000).select(F.col("id").alias("k"), F.concat(F.lit("m"), "id").alias("mail"), F.col("id").alias("w"))
    tasks = task_rows(fanout_join(left, right, ["mail", "k"], ["v"]))
    assert sum(tasks) == 120_000 and tasks[-1] < 2.5 * 120_000 / 64


def test_few_of_many_hot_keys_are_listed(spark, rows, monkeypatch, shuffled_joins):
    monkeypatch.setattr(joins, "MOST_HOT_KEYS", 2)
    left = spark.range(0, 9).select((F.col("id") % 4).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 60).select((F.col("id") % 5).alias("k"), F.col("id").alias("w"))
    assert rows(fanout_join(left, right, ["k"], ["v"], rows_per_slot=3)) == rows(left.join(right, "k", "left"))


def test_own_columns_with_the_names_of_helpers(spark, rows, shuffled_joins):
    left = spark.createDataFrame([(1, 7, "a", 5), (2, 8, "b", 6)], "k int, _tag int, _slot string, _Copies int")
    right = spark.createDataFrame([(1, "x", 3), (1, "y", 4)], "k int, _piece string, _copy int")
    want = rows(left.join(right, "k", "left"))
    assert rows(lookup_join(left, right, ["k"], ["_tag"])) == want
    assert rows(fanout_join(left, right, ["k"], ["_tag"])) == want
    twice = left.withColumn("_rank", F.lit(9)).unionByName(left.withColumn("_rank", F.lit(8)))
    newest = rows(latest_per_key(twice, "k", "_rank"))
    assert newest == rows(left.withColumn("_rank", F.lit(9)))


def test_fanout_join_equals_left_join(spark, rows, shuffled_joins):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("c", 4)], "k string, v int")
    right = spark.createDataFrame(
        [("a", "x")] * 25 + [("a", f"y{i}") for i in range(30)] + [("b", None), ("b", None), (None, "z"), ("d", "w")],
        "k string, w string",
    )
    want = rows(left.join(right, "k", "left"))
    assert rows(fanout_join(left, right, ["k"], ["v"])) == want
    assert rows(fanout_join(left, right, ["k"], ["v"], copies_per_piece=4)) == want
    assert rows(fanout_join(left, right, ["k"], ["v"], copies_per_piece=2, rows_per_slot=3)) == want


def test_exists_flag_is_two_valued(spark, rows):
    left = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    want = sorted([("a", True), ("a", True), (None, False), ("b", False)], key=repr)
    assert rows(exists_flag(left, right, "k", "found")) == want
    assert rows(exists_flag(left, right, "k", "found", spread=["k"])) == want


# --- membership filter


def test_possible_members_keeps_all_members_and_few_others(spark):
    keys = spark.range(0, 40_000, 4).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    many = spark.range(0, 200_000).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("k"))
    got = possible_members(many, keys, "k")
    kept = {r.k for r in got.collect()}
    members = {i for i in range(0, 40_000, 4) if i % 7}
    assert members <= kept and None not in kept and len(kept - members) < 0.01 * 160_000
    assert possible_members(many, keys.filter("false"), "k").count() == 0
    words = keys.select(F.concat(F.lit("k"), "k").alias("k"))
    text = possible_members(many.select(F.concat(F.lit("k"), "k").alias("k")), words, "k")
    assert {f"k{x}" for x in members} <= {r.k for r in text.collect()} and text.count() < len(members) + 1600
    assert possible_members(many, keys.filter("false"), "k").count() == 0
    mixed = possible_members(many, keys.select(F.col("k").cast("int")), "k")  # integers of another width
    assert members <= {r.k for r in mixed.collect()}


def test_a_hot_delivery_id_is_counted_before_it_moves(spark, split):
    """An id on a third of the window's rows and ETAs: a row per id and entity reaches the join, with the right sums."""
    hot = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id"))
    deliveries = spark.range(0, 60_000, 1, 8).select(
        hot.alias("delivery_id"), F.concat(F.lit("C"), F.col("id") % 30).alias("carrier_external_id"),
        F.lit("msd").alias("delivery_type"), F.lit(True).alias("is_completed_delivery"), F.to_timestamp(F.lit("2001-06-15")).alias("created_at"),
    )
    etas = spark.range(0, 90_000, 1, 8).select(
        hot.alias("delivery_id"), (F.col("id") % 4000 - 2000).alias("seconds_to_origin_delta"), F.lit(None).cast("long").alias("seconds_to_destination_delta")
    )
    matches = scorecard.eta_matches(deliveries, etas, as_of="2001-06-30")
    tasks = sorted(r["n"] for r in matches.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("etas")).collect())
    assert tasks[-1] < 2 * sum(tasks) / len(tasks)
    got = {r["carrier_external_id"]: r for r in scorecard.on_time(deliveries, etas, as_of="2001-06-30").collect()}
    plain = deliveries.join(etas.select("delivery_id"), "delivery_id")
    plain = plain.groupBy("carrier_external_id", "delivery_id").agg(F.count("*").alias("n")).groupBy("carrier_external_id").agg(F.sum("n").alias("n"))
    assert {k: r["eta_delivery_count"] for k, r in got.items()} == {r["carrier_external_id"]: r["n"] for r in plain.collect()}
