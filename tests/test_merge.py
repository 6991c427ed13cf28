"""Merges on hand-written rows, on the two-day fixture, and against a plain-Python model."""

import datetime as dt

import pytest
from conftest import LARGER
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonearm.operators import merge
from tonearm.queries.fixtures import Catalogue

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
VERSIONED = "k string, v string, valid_from date, valid_to date, flag boolean"
TARGET = "k string, v string, w string, created_at timestamp, updated_at timestamp"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def two_days(spark):
    """Target and staging rows of the two-day change fixture."""
    track = Catalogue(spark, LARGER).src_track.withColumn("k", F.col("track_id").cast("int"))
    columns = ["track_id", "name", "plays_count"]
    version = {
        "valid_from": F.lit(D1), "valid_to": F.lit(None).cast("date"), "flag": F.lit(True),
    }
    day1 = track.where("k % 7 <> 6").select(*columns).withColumns(version)
    closed = track.where("k % 14 = 3").select(*columns).withColumns(
        {"valid_from": F.lit(dt.date(2023, 1, 1)), "valid_to": F.lit(dt.date(2023, 6, 1)), "flag": F.lit(False)}
    )
    plays = F.expr(
        "case when k % 7 in (3, 4) then plays_count + 1 when k % 7 = 5 then if(plays_count is null, 1, null) else plays_count end"
    )
    name = F.expr("if(k % 7 in (3, 4), name || 'v2', name)")
    day2 = track.where("k % 14 <> 0").select("track_id", name.alias("name"), plays.alias("plays_count"))
    return day1.unionByName(closed), day2


@pytest.mark.parametrize("strategy", merge.STRATEGIES)
def test_two_day_fixture(spark, rows, strategy):
    target, staging = two_days(spark)
    assert target.count() == 1858
    result = merge.scd2(target, staging, ["track_id"], D2, strategy=strategy)
    assert result.count() == 3000
    open_rows = result.where("flag")
    assert open_rows.count() == 2000 == open_rows.select("track_id").distinct().count()
    assert result.where("flag <> (valid_to is null)").count() == 0
    assert rows(result.where("valid_to = '2023-06-01'")) == rows(target.where("valid_to is not null"))
    again = merge.scd2(result, staging, ["track_id"], D2, strategy=strategy)
    assert rows(again) == rows(result)


def test_change_and_back_gives_three_versions(spark, rows):
    def staged(value):
        return spark.createDataFrame([("a", value)], "k string, v string")

    table = spark.createDataFrame([("a", "A", D1, None, True)], VERSIONED)
    table = merge.scd2(table, staged("B"), ["k"], D2)
    table = merge.scd2(table, staged("A"), ["k"], D3)
    assert rows(table) == sorted(
        [("a", "A", D1, D2, False), ("a", "B", D2, D3, False), ("a", "A", D3, None, True)], key=repr
    )


def test_two_changes_on_one_day_give_an_empty_interval(spark, rows):
    table = spark.createDataFrame([("a", "A", D2, None, True)], VERSIONED)
    table = merge.scd2(table, spark.createDataFrame([("a", "B")], "k string, v string"), ["k"], D2)
    assert rows(table) == sorted([("a", "A", D2, D2, False), ("a", "B", D2, None, True)], key=repr)


def test_closed_history_that_differs_is_left_alone(spark, rows):
    table = spark.createDataFrame([("a", "old", D1, D2, False), ("a", "new", D2, None, True)], VERSIONED)
    result = merge.scd2(table, spark.createDataFrame([("a", "new")], "k string, v string"), ["k"], D3)
    assert rows(result) == rows(table)


@pytest.mark.parametrize("strategy", merge.STRATEGIES)
def test_scd1_sees_changes_from_and_to_null(spark, rows, strategy):
    target = spark.createDataFrame(
        [("a", None, "x", T1, T1), ("b", "1", "x", T1, T1), ("c", None, None, T1, T1), ("d", "1", "1", T1, T1)], TARGET
    )
    staging = spark.createDataFrame(
        [("a", "1", "x"), ("b", None, "x"), ("c", None, None), ("e", None, "n")], "k string, v string, w string"
    )
    result = merge.scd1(target, staging, ["k"], T2, strategy=strategy)
    assert rows(result) == sorted(
        [
            ("a", "1", "x", T1, T2), ("b", None, "x", T1, T2), ("c", None, None, T1, T1),
            ("d", "1", "1", T1, T1), ("e", None, "n", T2, T2),
        ],
        key=repr,
    )
    assert rows(merge.scd1(result, staging, ["k"], T2, strategy=strategy)) == rows(result)


def test_missing_column_is_named(spark):
    target = spark.createDataFrame([("a", "1", "x", T1, T1)], TARGET)
    with pytest.raises(ValueError, match="w"):
        merge.scd1(target, spark.createDataFrame([("a", "1")], "k string, v string"), ["k"], T2)
    with pytest.raises(ValueError, match="strategy"):
        merge.match_sides(target, target, ["k"], "other")


def test_insert_absent_adds_nothing_the_second_time(spark, rows):
    ddl = "day int, k string, extra string"
    target = spark.createDataFrame([(20240101, "a", "t"), (20200101, "z", "t")], ddl)
    staging = spark.createDataFrame([(20240101, "a", "s"), (20240101, "b", "s"), (20240103, "a", "s")], ddl)
    fresh = merge.insert_absent(target, staging, ["day", "k"], "day")
    assert rows(fresh, "day", "k") == [(20240101, "b"), (20240103, "a")]
    assert merge.insert_absent(target.unionByName(fresh), staging, ["day", "k"], "day").count() == 0
    assert merge.insert_absent(target, staging.where("false"), ["day", "k"], "day").count() == 0


def test_partial_upsert_tells_absent_from_null(spark, rows):
    target = spark.createDataFrame([("a", "1", "x", T1, T1), ("b", "1", "x", T1, T1), ("c", "1", "x", T1, T1)], TARGET)
    records = spark.createDataFrame(
        [("a", None, "y", ["v"]), ("b", None, None, ["w"]), ("c", "1", "z", ["v"]), ("d", "5", "q", ["w"])],
        "k string, v string, w string, present array<string>",
    )
    result = merge.upsert_partial(target, records, ["k"], T2, "present")
    assert rows(result) == sorted(
        [
            ("a", None, "x", T1, T2), ("b", "1", None, T1, T2), ("c", "1", "x", T1, T1), ("d", None, "q", T2, T2),
        ],
        key=repr,
    )


def test_combine_partial_takes_the_last_carried_value(spark, rows):
    records = spark.createDataFrame(
        [("a", "1", "x", 1, ["v", "w"]), ("a", None, "y", 2, ["w"]), ("a", None, None, 3, ["v"]), ("b", "9", None, 1, ["v"])],
        "k string, v string, w string, at int, present array<string>",
    )
    folded = merge.combine_partial(records, ["k"], ["at"], "present")
    assert rows(folded) == [("a", None, "y", ["v", "w"]), ("b", "9", None, ["v"])]


KEYS = st.sampled_from("abcdef")
VALUES = st.sampled_from([None, "1", "2"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.dictionaries(KEYS, VALUES, max_size=6), min_size=1, max_size=3))
@pytest.mark.parametrize("strategy", merge.STRATEGIES)
def test_scd2_like_plain_python(spark, strategy, days):
    versions = []
    table = spark.createDataFrame([], VERSIONED)
    for number, staged in enumerate(days):
        day = D1 + dt.timedelta(days=number)
        for key, value in staged.items():
            current = next((v for v in versions if v[0] == key and v[4]), None)
            if current is None or current[1] != value:
                if current is not None:
                    current[3:5] = [day, False]
                versions.append([key, value, day, None, True])
        staging = spark.createDataFrame(list(staged.items()), "k string, v string")
        merged = merge.scd2(table, staging, ["k"], day, strategy=strategy)
        table = spark.createDataFrame(merged.collect(), VERSIONED)
    assert sorted(map(tuple, table.collect()), key=repr) == sorted(map(tuple, versions), key=repr)
