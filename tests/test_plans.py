"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from haulbook.operators import joins, members, scorecard
from haulbook.operators.filters import in_lookback
from haulbook.queries import QUERIES
from haulbook.sources import write_bucketed, write_facts
from haulbook.sources.sample import AS_OF, SampleTables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_pair_loops(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for operator in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert operator not in text


@pytest.mark.parametrize("name", ["active_route_driver", "latest_per_key", "drivers_model"])
def test_top_row_is_found_before_the_shuffle(spark, small, name):
    assert plan(QUERIES[name](spark, small)).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["rolling_lookback", "accurate_deliveries", "eta_ontime", "completion_violations"])
def test_window_reaches_the_scan(spark, small, name):
    assert "GreaterThanOrEqual(l_shipdate,2001-05-31" in plan(QUERIES[name](spark, small))


def test_scan_reads_only_needed_columns(spark, small):
    text = plan(QUERIES["distinct_rows"](spark, small))
    assert "l_extendedprice" not in text and "l_shipdate" not in text


@pytest.mark.parametrize("name", ["active_entities", "active_drivers"])
def test_text_maximum_sorts_distinct_rows_only(spark, small, name):
    """Below the sorting maximum, hashing has already removed the repeats."""
    text = plan(QUERIES[name](spark, small))
    assert text.index("SortAggregate") < text.index("HashAggregate(keys=", text.index("SortAggregate"))


def test_wide_driver_rows_move_seldom(spark, small, shuffled_joins):
    """For an exclusion list too long to broadcast, to pick the latest row, and for the final order;
    the join with the facts reuses the second."""
    text = plan(QUERIES["drivers_model"](spark, small))
    moves = [line for line in text[: text.index("FileScan")].splitlines() if " Exchange" in line]
    assert ["rangepartitioning" in m for m in moves] == [True, False, False]
    assert "email_address" in moves[2]


def test_wide_driver_rows_are_not_sorted_where_they_are_read(spark, small):
    """The exclusions are broadcast, drivers are not: from their scan to their exchange a task holds no wide rows back."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        text = plan(QUERIES["drivers_model"](spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    branch = text[: text.index("FileScan")]
    reading = branch[branch.rindex(" Exchange ") :]
    assert "driver_tags" in reading and "BroadcastHashJoin" in reading and "SortMergeJoin" not in reading
    for operator in ("Sort", "WindowGroupLimit", "Aggregate"):
        assert operator not in reading


def exchanges(text: str) -> list[str]:
    return [line for line in text.splitlines() if " Exchange " in line]


def test_window_is_shuffled_once_before_the_entities(spark, small, shuffled_joins):
    """Rows by delivery id, then partial results by entity (and driver); no other shuffle above the scan of the window."""
    text = plan(QUERIES["accurate_deliveries"](spark, small))
    branch = text[: text.index("FileScan")]
    assert sum("delivery" in e and "_tag" in e for e in exchanges(branch)) == 1
    assert not any("delivery" in e and "_tag" not in e for e in exchanges(branch))


def indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def without_subqueries(text: str) -> list[str]:
    """The lines of a plan less those of the subqueries inside its expressions."""
    out, inside = [], None
    for line in text.splitlines():
        if inside is not None and indent(line) > inside:
            continue
        inside = indent(line) if re.match(r"[ :+-]*(Reused)?Subquery ", line) else None
        if inside is None:
            out.append(line)
    return out


def up_to_the_join(lines: list[str], scan: str) -> list[str]:
    """From the last scan whose columns match ``scan`` to the join above it."""
    at = max(i for i, line in enumerate(lines) if "FileScan" in line and re.search(scan, line.split("]")[0]))
    out, depth = [lines[at]], indent(lines[at])
    for line in reversed(lines[:at]):
        if indent(line) < depth:
            out.append(line)
            depth = indent(line)
            if "Join" in line:
                break
    return out


@pytest.fixture
def large(monkeypatch):
    """Every table counts as large."""
    monkeypatch.setattr(members, "FILTER_FROM", 0)
    monkeypatch.setattr(joins, "BYTES_PER_ROW", 0)


def test_etas_are_filtered_in_the_scan_and_cross_one_exchange(spark, small, shuffled_joins, large):
    """From the scan of the ETAs upwards: the membership filter, the aggregate of each task, one exchange, the join."""
    lines = without_subqueries(plan(QUERIES["eta_ontime"](spark, small)))
    above = up_to_the_join(lines, r"\[o_orderkey")
    names = [next((n for n in ("Scan", "Filter", "Aggregate", "Exchange", "Join") if n in line.split("(")[0]), "") for line in above]
    assert [n for n in names if n] == ["Scan", "Filter", "Aggregate", "Exchange", "Aggregate", "Join"]
    assert "getbit" in above[names.index("Filter")] and "partial_count" in above[names.index("Aggregate")]


def test_window_pairs_are_counted_before_they_move(spark, small, shuffled_joins):
    lines = without_subqueries(plan(QUERIES["eta_ontime"](spark, small)))
    above = up_to_the_join(lines, "l_shipdate")
    first = next(i for i, line in enumerate(above) if " Exchange " in line)
    assert any("partial_count" in line for line in above[:first])


def test_drivers_are_formatted_above_the_final_order(spark, small):
    """No formatter below the pick or the sort: they run once per row of the result."""
    text = plan(QUERIES["drivers_model"](spark, small))
    top, _, below = text.partition("rangepartitioning")
    for formatter in ("date_from_unix_date", "unix_micros"):
        assert formatter in top and formatter not in below
    assert "regexp_replace" not in below or "State__c" not in below


def test_owner_join_moves_carriers_once(spark, small, shuffled_joins, large):
    lines = without_subqueries(plan(QUERIES["composite_key_join"](spark, small)))
    assert sum("Join" in line.split("(")[0].split("[")[0] for line in lines) == 1
    assert len(exchanges("\n".join(up_to_the_join(lines, "s_suppkey")))) == 1


def test_partitioned_facts_read_the_days_of_the_window(spark, small, tmp_path):
    """A partition filter in the scan; rows at the boundary, in the future and without a date as in the whole table."""
    rows = [("2001-05-31 00:00:00", 1), ("2001-05-30 23:59:59", 2), ("2050-01-01 00:00:00", 3), (None, 4), ("2000-01-01 00:00:00", 5)]
    df = spark.createDataFrame(rows, "t string, n int").select(F.col("t").cast("timestamp").alias("created_at"), "n")
    deliveries = SampleTables(spark, small)["deliveries"]
    for table, name in ((df, "few"), (deliveries, "deliveries")):
        write_facts(table, str(tmp_path / name))
        stored = spark.read.parquet(str(tmp_path / name))
        for zone in ("UTC", "Pacific/Kiritimati", "Pacific/Pago_Pago"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            try:
                recent = in_lookback(stored, "2001-06-30")
                scan = next(line for line in plan(recent).splitlines() if "FileScan" in line)
                assert "PartitionFilters: [isnotnull(created_on" in scan and ">= 2001-05-29" in scan
                want = in_lookback(table, "2001-06-30")
                assert recent.drop("created_on").exceptAll(want).count() == 0 and recent.count() == want.count()
            finally:
                spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.n for r in in_lookback(spark.read.parquet(str(tmp_path / "few")), "2001-06-30").collect()} == {1, 3}


def test_bucketed_facts_need_no_exchange(spark, small, tmp_path, rows, shuffled_joins, large):
    tables = SampleTables(spark, small)
    keys = {"deliveries": scorecard.CARRIER, "violations": scorecard.CARRIER, "etas": "delivery_id"}
    for name, key in keys.items():
        write_bucketed(tables[name], f"bucketed_{name}", key, 6, str(tmp_path / name))
    try:
        deliveries, violations, etas = (spark.table(f"bucketed_{name}") for name in keys)
        pairs = [
            (scorecard.ratings(deliveries), scorecard.ratings(tables["deliveries"])),
            (scorecard.completion_violations(violations, as_of=AS_OF), scorecard.completion_violations(tables["violations"], as_of=AS_OF)),
            (scorecard.eta_counts(etas), scorecard.eta_counts(tables["etas"])),
        ]
        both = pairs[0][0].join(pairs[1][0], scorecard.CARRIER, "left")
        for df in (*[a for a, _ in pairs], both):
            assert not exchanges(plan(df))
        for ours, want in pairs:
            assert rows(ours) == rows(want)
        cards = [
            scorecard.scorecard(tables["carriers"].select("external_id").distinct(), "external_id", *facts, as_of=AS_OF)
            for facts in ((deliveries, violations, etas), (tables["deliveries"], tables["violations"], tables["etas"]))
        ]
        assert rows(cards[0]) == rows(cards[1])
        ours, usual = (without_subqueries(plan(card)) for card in cards)
        assert len(exchanges("\n".join(ours))) < len(exchanges("\n".join(usual)))
        assert not exchanges("\n".join(up_to_the_join(ours, "seconds_to_origin_delta")))
    finally:
        for name in keys:
            spark.sql(f"drop table bucketed_{name}")


def test_list_columns_read_once_and_shuffle_once(spark, small, shuffled_joins):
    text = plan(QUERIES["array_list_columns"](spark, small))
    assert len(exchanges(text)) == 1


def test_wide_carrier_rows_move_once(spark, small, shuffled_joins):
    text = plan(QUERIES["carriers_model"](spark, small))
    wide = [e for e in exchanges(text[: text.index("FileScan")])]
    assert len(wide) == 1 and "_mail" in wide[0]
