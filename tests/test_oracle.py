"""Every registered query against its checking SQL."""

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as entry
from tonearm.queries import all_oracles, all_queries

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_same_rows(spark, duck, key):
    total, problem = compare(duck, entry.queries()[key](spark, SMALL), ORACLES[key])
    assert not problem
    assert total >= 0


def test_every_query_has_sql():
    assert set(all_oracles()) == set(all_queries())
    assert set(all_queries()) <= set(entry.queries())


def test_every_inventory_line_has_a_query():
    sizes = {"a": 17, "b": 33, "c": 13, "d": 11, "e": 5, "f": 4, "g": 11, "h": 15, "i": 17, "j": 17}
    prefixes = {key.split("_")[0] for key in entry.queries()}
    expected = {f"{letter}{n:02d}" for letter, size in sizes.items() for n in range(1, size + 1)}
    assert expected <= prefixes


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["name", "genre", "tracks_count", "tracks_plays_count"]
    assert result.count() > 0
