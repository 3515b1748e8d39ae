"""Every registered query against its SQL on the smallest tables (SF_DIR chooses others)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from workload import ORACLES, QUERIES

from .compare import differences, duck

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert differences(contract.queries()[name](spark, SF_DIR), tables, contract.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


def test_flagship_has_rows_and_thirty_columns(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 30 and not df.isEmpty()
