"""New versions of sources restage only what changed."""

from __future__ import annotations

import uuid

import pytest

from indicatorlake.operators.selection import Indicator, selected
from indicatorlake.plans import stage
from indicatorlake.session import compiled_in_parts
from indicatorlake.sources.tables import Lake
from workload.harmonise_cases import view
from workload.stage_cases import CODE, _config

SF = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"refresh_{uuid.uuid4().hex}", f"file://{tmp_path}/lake")


def test_a_new_version_restages_the_indicators_it_changes(spark, lake, tmp_path):
    config = [("late", "afs_year >= 1998"), ("early", "afs_year < 1996"), ("area", "afs_m49_code = '003'"), ("none", "afs_m49_code = 'zzz'"),
              ("stamp", "afs_source_updated_at = '' AND afs_year = 1997")]
    lake.write(stage.CONFIG, _config(spark, [(u, CODE, c, "ACTIVE", None) for u, c in config]))
    view(spark, SF, CODE).write.parquet(f"{tmp_path}/v1")
    v1 = spark.read.parquet(f"{tmp_path}/v1")
    stage.reconstruct(lake, {CODE: v1})
    # rows of one year change, one row comes twice, and everything is stored anew at another time
    v1.selectExpr(*[f"IF(afs_year = 1998, 'other', {c}) AS {c}" if c == "afs_unit" else f"TIMESTAMP '2030-01-01' AS {c}" if c == "afs_source_ingested_at" else c
                    for c in v1.columns]).write.parquet(f"{tmp_path}/v2")
    v2 = spark.read.parquet(f"{tmp_path}/v2")
    spark.createDataFrame(v2.where("afs_year < 1996").head(1), v2.schema).write.mode("append").parquet(f"{tmp_path}/v2")
    v2 = spark.read.parquet(f"{tmp_path}/v2")
    before = {u: stage_rows(lake, u) for u, _ in config}
    log = {tuple(r.afs_uid_list): r for r in stage.refresh(lake, {CODE: v1}, {CODE: v2}).collect()}
    changed = {u for uids, r in log.items() if r.job_status == "SUCCESS" for u in uids}
    area_hit = v2.where("afs_m49_code = '003' AND (afs_year = 1998 OR afs_year < 1996)").count() > 0
    assert {"late", "early", "stamp"} <= changed <= {"late", "early", "stamp", "area"} and ("area" in changed) <= area_hit
    for u, condition in config:
        now = stage_rows(lake, u)
        wanted = sorted(map(repr, v2.where(condition).drop("afs_source_ingested_at").collect()))
        assert sorted(map(repr, lake.read("stg_faostat_qcl_tbl").where(f"afs_uid = '{u}'").select(*[c for c in v2.columns if c != "afs_source_ingested_at"]).collect())) == wanted
        assert (now == before[u]) == (u not in changed) or not now
    again = stage.refresh(lake, {CODE: v2}, {CODE: v2}).collect()
    assert {r.job_status for r in again if "late" in r.afs_uid_list} == {"SKIPPED"} or {tuple(r.afs_uid_list) for r in again if r.job_status == "SUCCESS"} == {("stamp",)}
    assert {tuple(r.afs_uid_list) for r in again if r.job_status == "SUCCESS"} <= {("stamp",)}


def stage_rows(lake, uid):
    return sorted(map(repr, lake.read("stg_faostat_qcl_tbl").where(f"afs_uid = '{uid}'").collect()))


def test_a_published_table_knows_what_it_stood_for(spark, lake, tmp_path):
    for k in (1, 2, 3):
        spark.range(k).write.parquet(f"{tmp_path}/p{k}")
        lake.publish("t", f"file://{tmp_path}/p{k}")
        lake.publish("t", f"file://{tmp_path}/p{k}")
        earlier = lake.before("t")
        assert lake.read("t").count() == k and (earlier.count() == k - 1 if earlier is not None else k < 3)


def test_changed_uids_read_every_version_once(spark, tmp_path):
    view(spark, SF, CODE).write.parquet(f"{tmp_path}/v1")
    v1 = spark.read.parquet(f"{tmp_path}/v1")
    v2 = v1.where("NOT (afs_flag <=> 'flag 4')").unionByName(v1.where("afs_year = 1997").limit(1))
    n1, n2 = v1.count(), v2.count()
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    wanted = [Indicator("four", "afs_flag = 'flag 4'"), Indicator("nil", "afs_flag IS NULL AND afs_year <> 1997"), Indicator("year", "afs_year = 1997"),
              Indicator("none", "afs_year = 1"), Indicator("stamp", "afs_source_updated_at = ''")]
    assert stage.changed_uids(v1.mapInArrow(noted, v1.schema), v2.mapInArrow(noted, v2.schema), wanted) == ["four", "stamp", "year"]
    assert seen.value == n1 + n2
    assert stage.changed_uids(v1, v1, wanted) == ["stamp"]


def test_few_indicators_are_selected_without_a_join(spark):
    v = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", 2, "x"), (None, None, "7")], "k string, n int, t string")
    wanted = [Indicator("eq", "k = 'a' AND n >= 1"), Indicator("guard", "CAST(t AS INT) = 7 AND n IS NULL"), Indicator("both", "(n = 2 OR n = 1) AND k IN ('a', 'b')"),
              Indicator("late", "CAST(t AS INT) > 0 AND t = '7'"), Indicator("rest", "n > 1")]
    found = selected(v.where("NOT t <=> 'x'"), wanted)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.afs_uid for r in found.collect()) == ["both", "both", "eq", "eq", "guard", "late"]
    # the rest of a predicate sees only rows that have its equality
    assert sorted((r.afs_uid, r.t) for r in selected(v, wanted[3:]).collect()) == [("late", "7"), ("rest", "x")]


def test_stores_run_in_parts_that_the_jvm_compiles(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    own = spark.conf.get(name)
    spark.conf.set(name, "65535")
    try:
        with compiled_in_parts(spark):
            with compiled_in_parts(spark):
                assert spark.conf.get(name) == "8000"
            assert spark.conf.get(name) == "8000"
        assert spark.conf.get(name) == "65535"
        spark.conf.set(name, "4000")
        with compiled_in_parts(spark):
            assert spark.conf.get(name) == "4000"
    finally:
        spark.conf.set(name, own)
