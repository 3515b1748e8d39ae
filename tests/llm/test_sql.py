"""Queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from indicatorlake.llm.queries import ORACLES, QUERIES

from ..compare import differences, duck

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) == []
