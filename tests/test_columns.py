"""Edge values of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tonearm.functions import change, dates, html, values
from tonearm.schemas import ALBUM_TYPE_CODES


def one(spark, ddl, data, column):
    df = spark.createDataFrame([(value,) for value in data], ddl)
    return [row[0] for row in df.select(column).collect()]


def test_blank_and_null_defaults(spark):
    assert one(spark, "c string", ["", None, " ", "x"], values.blank_to("c", "unknown")) == [
        "unknown", "unknown", " ", "x",
    ]
    assert one(spark, "c string", ["", None], values.null_to("c", "unknown")) == ["", "unknown"]


@pytest.mark.parametrize(
    "text, key",
    [
        ("2020", 20200000), ("2020-05", 20200500), ("2020-05-07", 20200507), ("", 0), (None, 0),
        ("x", 0), ("in 1999", 19990000), ("2020-5", 20200000), ("2020-05-07T01:02:03Z", 20200507),
    ],
)
def test_partial_date_key(spark, text, key):
    assert one(spark, "c string", [text], dates.partial_date_key("c")) == [key]


def test_codes(spark):
    labels = ["album", "single", "compilation", "ep", "ALBUM", "", None]
    assert one(spark, "c string", labels, values.code_of("c", ALBUM_TYPE_CODES)) == [1, 2, 3, -1, -1, -1, -1]


def test_text_to_int(spark):
    texts = ["1,234,567", "12", "", "abc", None, "1.5"]
    assert one(spark, "c string", texts, values.text_to_int("c")) == [1234567, 12, None, None, None, None]


def test_duration_class_bounds(spark):
    found = one(spark, "c int", [179_999, 180_000, 240_000, 240_001, None], values.duration_class("c"))
    assert found == ["short", "normal", "normal", "long", "long"]


def test_first_and_last_of_empty_arrays(spark):
    data = [[], None, ["a"], ["a", "b"]]
    assert one(spark, "c array<string>", data, values.first_of("c")) == [None, None, "a", "a"]
    assert one(spark, "c array<string>", data, values.last_of("c")) == [None, None, "a", "b"]


def test_overlap_of_null_array_is_null(spark):
    data = [["a"], ["b"], None, []]
    assert one(spark, "c array<string>", data, values.shares_any("c", ["a", "z"])) == [True, False, None, False]


def test_iso_timestamps(spark):
    texts = ["2021-03-04T05:06:07Z", "2021-03-04T05:06:07.250Z", "2021-03-04T05:06:07.123456Z", "2021-03-04", "", None]
    base = dt.datetime(2021, 3, 4, 5, 6, 7)
    assert one(spark, "c string", texts, dates.iso_timestamp("c")) == [
        base, base.replace(microsecond=250_000), base.replace(microsecond=123_456), None, None, None,
    ]


def test_micros_are_cut_to_seconds(spark):
    assert one(spark, "c bigint", [1_500_000, 1_999_999, None], dates.micros_to_timestamp("c")) == [
        dt.datetime(1970, 1, 1, 0, 0, 1), dt.datetime(1970, 1, 1, 0, 0, 1), None,
    ]


def test_bad_date_text_is_null(spark):
    assert one(spark, "c string", ["2020-02-30", "x", "2020-02-29T10:00:00Z"], dates.date_of_text("c")) == [
        None, None, dt.date(2020, 2, 29),
    ]


def test_on_date_is_a_range(spark):
    times = [dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 23, 59), dt.datetime(2024, 1, 3)]
    assert one(spark, "c timestamp", times, dates.on_date("c", dt.date(2024, 1, 2))) == [False, True, True, False]


def test_strict_hash_loses_rows_with_null_and_lenient_hash_collides(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    columns = ["x", "y", "z"]
    assert [r[0] for r in df.select(change.strict_hash(columns)).collect()] == [None, None]
    assert df.select(change.lenient_hash(columns)).distinct().count() == 1


def test_tuple_equality_never_matches_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    joined = df.alias("l").join(df.alias("r"), change.same_keys("l", "r", ["x", "y"]))
    assert joined.count() == 1


def test_id_from_uri(spark):
    df = spark.createDataFrame(
        [("1", "site:track:2"), (None, "site:track:2"), ("", "site:track:2"), (None, None)], "id string, uri string"
    )
    found = [r[0] for r in df.select(values.id_from_uri("id", "uri", "track")).collect()]
    assert found == ["1", "2", "2", None]


def test_play_count_takes_the_link_of_the_track(spark):
    span = '<span class="encore-text-marginal">{}</span>'
    pages = [
        f'<a href="/track/other">{span.format(1)}</a><a href="/track/t1"><b>\n{span.format("2,345")}</b></a>',
        f'<a href="/track/t1">name</a>{span.format(9)}',
        '<span data-testid="playcount">7,000</span>',
        f'<link href="/track/t1">{span.format(9)}',
        f'<a href="/track/t1">{span.format(0)}</a><span data-testid="playcount">3</span>',
        "",
        None,
    ]
    df = spark.createDataFrame([(p,) for p in pages], "html string").withColumn("id", F.lit("t1"))
    assert [r[0] for r in df.select(html.play_count("html", "id")).collect()] == [2345, None, 7000, None, 3, None, None]
