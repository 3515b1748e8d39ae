"""Versions of tables: concurrent runs, and what is left in the catalog."""

from __future__ import annotations

import os
import uuid

import pytest

from indicatorlake.sources import tables
from indicatorlake.sources.tables import Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"versions_{uuid.uuid4().hex}", f"file://{tmp_path}/lake")


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "uid string, v long")


def shown(lake):
    return sorted((r.uid, r.v) for r in lake.read("t").collect())


def while_storing(monkeypatch, act):
    """Let another run act between the files of this one and its view."""
    plain = Lake._store

    def store(self, *args):
        out = plain(self, *args)
        monkeypatch.setattr(Lake, "_store", plain)
        act()
        return out

    monkeypatch.setattr(Lake, "_store", store)


def test_two_runs_on_different_keys_both_stay(spark, lake, monkeypatch):
    lake.write("t", rows(spark, [("a", 1), ("b", 1), ("c", 1)]), "uid")
    while_storing(monkeypatch, lambda: lake.replace_keys("t", rows(spark, [("b", 2)]), "uid", ["b"]))
    lake.replace_keys("t", rows(spark, [("a", 2)]), "uid", ["a"])
    assert shown(lake) == [("a", 2), ("b", 2), ("c", 1)]


@pytest.mark.parametrize("other", [lambda spark, lake: lake.replace_keys("t", rows(spark, [("a", 9)]), "uid", ["a"]),
                                   lambda spark, lake: lake.write("t", rows(spark, [("a", 9), ("b", 1)]), "uid")])
def test_a_run_on_the_same_keys_is_refused(spark, lake, monkeypatch, other):
    lake.write("t", rows(spark, [("a", 1), ("b", 1)]), "uid")
    while_storing(monkeypatch, lambda: other(spark, lake))
    with pytest.raises(RuntimeError, match="changed by another run"):
        lake.replace_keys("t", rows(spark, [("a", 2)]), "uid", ["a"])
    assert shown(lake) == [("a", 9), ("b", 1)]


def test_many_replaced_keys_are_folded_into_one_version(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "MOST_GENERATIONS", 3)
    lake.write("t", rows(spark, [(f"k{k}", 0) for k in range(6)]), "uid")
    for k in range(6):
        lake.replace_keys("t", rows(spark, [(f"k{k}", k)] if k != 2 else [("x", 1)]), "uid", [f"k{k}"])
        assert len(tables._generations(lake._noted("t"))) <= 3
    assert shown(lake) == [(f"k{k}", k) for k in range(6) if k != 2]


def test_old_versions_are_dropped_with_their_files(spark, lake, tmp_path):
    lake.write("t__x", rows(spark, [("other", 1)]))  # a table of a like name
    for k in range(12):
        lake.write("t", rows(spark, [("a", k)]), "uid" if k % 2 else None)
    assert lake.drop_old_versions("t", keep=2) == 9 and lake.drop_old_versions("t", keep=2) == 0
    assert shown(lake) == [("a", 11)]
    stored = [n for (n,) in spark.sql(f"SHOW TABLES IN `{lake.database}`").select("tableName").collect() if n.startswith("t__") and not n.startswith("t__x")]
    assert len(stored) == 3 and len(os.listdir(tmp_path / "lake" / "t")) == 3
    assert lake.read("t__x").count() == 1
    assert lake.drop_old_versions("t", keep=0) == 2 and shown(lake) == [("a", 11)]
