"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
import oracle
from lathework import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(driver.queries()[name](spark, FOLDER), con, driver.oracle_sql()[name]) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_every_query_of_the_library_has_sql():
    """Those of the training-data operators are held to their contracts in their own folder."""
    assert set(registry.QUERIES) == set(registry.ORACLE)


@pytest.mark.parametrize("name,columns", [
    ("word_count_sorted", ["-n", "word"]), ("word_count_top10", ["-n", "word"]), ("tag_counts", ["-n", "tag"]),
    ("significance", ["-n", "vertex"]), ("top_bigram_by_initial", ["initial"]), ("blocked_by_source", ["-n", "source"]),
])
def test_sorted_queries_come_in_order(spark, name, columns):
    """The comparison with SQL sorts both sides, so the order itself is looked at here."""
    rows = driver.queries()[name](spark, FOLDER).collect()
    keys = [tuple(-r[c[1:]] if c[0] == "-" else r[c] for c in columns) for r in rows]
    assert keys == sorted(keys) and len(keys) > 1
