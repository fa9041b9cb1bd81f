"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from check_oracle import compare, oracle_connection

import __spark_entry__ as entry

SF_DIR = os.environ.get("COFFER_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql_twin(spark, con, name):
    assert compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    learned = {"op1_language", "op2_quality", "op5_packing", "op7_toxicity", "op9_rules", "op10_sharding", "op11_pieces", "pipeline"}
    assert set(entry.queries()) - set(entry.oracle_sql()) <= learned


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
