"""The kept gap-filled table against whole builds, change by change."""

from __future__ import annotations

import uuid

import pytest

from indicatorlake.operators.grid import TAXONOMY
from indicatorlake.plans import export, kept, stage
from indicatorlake.sources.tables import Lake
from workload.export_cases import _REST

TABLE = stage.table_name("feed")
COLUMNS = ["afs_uid", "afs_m49_code", "afs_iso3c", "area_ref", "area_name", "afs_year", *_REST[3:]]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"kept_{uuid.uuid4().hex}", f"file://{tmp_path}/lake")


def stage_rows(spark, rows):
    nulls = {c: f"CAST(NULL AS {'timestamp' if c == 'afs_source_ingested_at' else 'string'}) AS {c}" for c in COLUMNS}
    df = spark.createDataFrame(rows, "afs_uid string, afs_m49_code string, afs_year long, afs_value double")
    return df.selectExpr(*[c if c in df.columns else nulls[c] for c in COLUMNS])


def put_config(spark, lake, rows):
    names = ", ".join(f"{c} string" for c in ("afs_uid", "afs_source_code", "filter_string", "status", *TAXONOMY))
    lake.write(stage.CONFIG, spark.createDataFrame([(u, "feed", "TRUE", status, *[f"{note} {c}" for c in TAXONOMY]) for u, status, note in rows], names))


def test_only_what_changed_is_built_and_the_table_equals_a_whole_build(spark, lake):
    areas = spark.createDataFrame([("003", "A"), ("005", "B")], "m49_code string, area_name string")
    rows = [("a", "003", 2010, 1.0), ("a", "003", 2010, 1.0), ("a", None, 2011, 2.0), ("b", "005", 2012, 3.0), ("b", "999", 2012, 4.0),
            ("c", "003", 2009, 5.0), ("d/é", "005", 2011, 6.0), ("unpublished", "005", 2011, 7.0)]
    config = [("a", "ACTIVE", "t"), ("b", "REVIEW", "t"), ("c", "ACTIVE", "t"), ("d/é", "ACTIVE", "t"), ("e", "ACTIVE", "t"), ("unpublished", "DRAFT", "t")]
    put_config(spark, lake, config)
    lake.write(TABLE, stage_rows(spark, rows), "afs_uid")
    used = {"areas": areas, "end": 2012}

    def built():
        log = kept.refresh_gap_filled(lake, used["areas"], 2010, used["end"]).head()
        whole = export.gap_filled_export(export.stage_rows(lake, "feed"), used["areas"], lake.read(stage.CONFIG), 2010, used["end"])
        assert sorted(map(repr, kept.kept_rows(lake).collect())) == sorted(map(repr, whole.select(kept.kept_rows(lake).columns).collect()))
        assert (log.job_status == "SUCCESS") == bool(log.source_stg_tbls)
        return set(log.source_stg_tbls)

    assert built() == {"a", "b", "c", "d/é", "e", "unpublished"}
    assert built() == set()
    lake.replace_keys(TABLE, stage_rows(spark, [("a", "003", 2010, 9.0), ("b", "005", 2012, 3.0), ("b", "999", 2012, 4.0)]), "afs_uid", ["a", "b"])
    assert built() == {"a"}  # b was staged again, with the same rows
    lake.replace_keys(TABLE, stage_rows(spark, [("e", "003", 2012, 1.5)]), "afs_uid", ["e", "d/é"])
    assert built() == {"e", "d/é"}
    put_config(spark, lake, [(u, "DRAFT" if u == "b" else s, "new" if u == "c" else n) for u, s, n in config if u != "unpublished"])
    assert built() == {"b", "c"}
    lake.replace_keys(TABLE, stage_rows(spark, []), "afs_uid", ["unpublished"])
    assert built() == {"unpublished"} and built() == set()
    lake.write(TABLE, export.stage_rows(lake, "feed"), "afs_uid")  # a new version of the same rows
    assert built() == set()
    used["areas"] = areas.unionByName(spark.createDataFrame([("007", "C")], areas.schema))
    assert built() == {"a", "b", "c", "d/é", "e"}
    used["end"] = 2013
    assert built() == {"a", "b", "c", "d/é", "e"}


def test_a_run_that_dies_is_made_good_by_the_next(spark, lake, monkeypatch):
    areas = spark.createDataFrame([("003", "A")], "m49_code string, area_name string")
    put_config(spark, lake, [("a", "ACTIVE", "t"), ("b", "ACTIVE", "t")])
    lake.write(TABLE, stage_rows(spark, [("a", "003", 2010, 1.0), ("b", "003", 2010, 1.0)]), "afs_uid")
    kept.refresh_gap_filled(lake, areas, 2010, 2011)
    lake.replace_keys(TABLE, stage_rows(spark, [("a", "003", 2010, 2.0)]), "afs_uid", ["a"])
    plain = Lake.write
    monkeypatch.setattr(Lake, "write", lambda self, table, *rest, **more: 1 / 0 if table == kept.STATE_TABLE else plain(self, table, *rest, **more))
    with pytest.raises(ZeroDivisionError):
        kept.refresh_gap_filled(lake, areas, 2010, 2011)
    monkeypatch.setattr(Lake, "write", plain)
    assert kept.refresh_gap_filled(lake, areas, 2010, 2011).head().source_stg_tbls == ["a"]
    assert sorted((r.afs_uid, r.afs_year, r.afs_value) for r in kept.kept_rows(lake).collect() if r.afs_value) == [("a", 2010, 2.0), ("b", 2010, 1.0)]
