"""Indicator selection and the stage tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake.operators.quality import orphan_rows
from indicatorlake.operators.selection import Indicator, select_indicators
from indicatorlake.plans import runlog, stage
from indicatorlake.session import scratch_folder
from indicatorlake.sources.tables import Lake

from . import duck
from .harmonise_cases import view
from .registry import case
from .standins import INGESTED_AT, OBSERVATIONS, observations, shown, table

CODE = "faostat_qcl"
# (uid, Spark predicate, DuckDB predicate); the last one is never true because of NULL.
PREDICATES = [
    ("late", "afs_year >= 2000", "afs_year >= 2000"),
    ("big", "afs_value > 25000000", "afs_value > 25000000"),
    ("flagged", "afs_flag = 'flag 3' OR afs_flag IS NULL", "afs_flag = 'flag 3' OR afs_flag IS NULL"),
    ("item", "get_json_object(SERIES, '$.item_code') = 'item_code 5'",
     "json_extract_string(\"SERIES\", '$.item_code') = 'item_code 5'"),
    ("area", "afs_m49_code IN ('003', '007')", "afs_m49_code IN ('003', '007')"),
    ("all", "TRUE", "TRUE"),
    ("none", "afs_unit = NULL", "afs_unit = NULL"),
]


def indicators() -> list[Indicator]:
    return [Indicator(uid, condition) for uid, condition, _ in PREDICATES]


_VIEW = f"WITH {duck.source_sql(CODE)}, v AS ({duck.view_sql(CODE)})"
_SELECTED = " UNION ALL ".join(f"SELECT '{uid}' AS afs_uid, * FROM v WHERE {sql}" for uid, _, sql in PREDICATES)


@case("stage_select", f"{_VIEW} {_SELECTED}")
def stage_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(select_indicators(view(spark, sf_dir, CODE), indicators()))


# Every area with every item, each an indicator of its own: 1,000 predicates of equalities, half of them with a range beside.
_MANY_AREAS, _MANY_ITEMS = 25, 40


def many_indicators() -> list[Indicator]:
    out = [Indicator(f"a{a}i{i}", f"afs_m49_code = '{a:03}' AND get_json_object(SERIES, '$.item_code') = 'item_code {i}'" + (" AND afs_year >= 2000" if i % 2 else ""))
           for a in range(_MANY_AREAS) for i in range(_MANY_ITEMS)]
    return [*out, Indicator("some", "afs_m49_code IN ('003', '004', '005') AND afs_flag IS NULL"), Indicator("late", "afs_year >= 2010")]


@case("stage_many_indicators", f"""
    {_VIEW}, asked AS (
        SELECT 'a' || a || 'i' || i AS afs_uid, printf('%03d', a) AS area, 'item_code ' || i AS item, CASE WHEN i % 2 = 1 THEN 2000 ELSE -9999 END AS since
        FROM range({_MANY_AREAS}) AS x(a), range({_MANY_ITEMS}) AS y(i))
    SELECT afs_uid, v.* FROM v JOIN asked ON afs_m49_code = area AND json_extract_string("SERIES", '$.item_code') = item
    WHERE since = -9999 OR afs_year >= since
    UNION ALL SELECT 'some', v.* FROM v WHERE afs_m49_code IN ('003', '004', '005') AND afs_flag IS NULL
    UNION ALL SELECT 'late', v.* FROM v WHERE afs_year >= 2010""")
def stage_many_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan, in which rows meet their indicators by an equi-join."""
    return shown(select_indicators(view(spark, sf_dir, CODE), many_indicators()))


@case("stage_query_plan", f"""
    {_VIEW}, picked AS ({_SELECTED})
    SELECT 'src_faostat_qcl_vw' AS stg_view, 'stg_faostat_qcl_tbl' AS stg_tbl,
           'all,area,big,flagged,item,late,none' AS uids, count(*) AS n_rows FROM picked""")
def stage_query_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group per source view with the sorted uids it covers."""
    config = _config(spark, [(uid, CODE, condition, "DRAFT", None) for uid, condition, _ in PREDICATES])
    group = stage.plan_groups(config, {CODE: view(spark, sf_dir, CODE)})[0]
    return group["frame"].select(
        F.lit(group["stg_view"]).alias("stg_view"), F.lit(group["stg_tbl"]).alias("stg_tbl"),
        F.lit(",".join(group["afs_uid_list"])).alias("uids"),
    ).groupBy("stg_view", "stg_tbl", "uids").agg(F.count(F.lit(1)).alias("n_rows"))


# A yearly total per area, and the latest value of each area and item: both reached through SQL of the config.
_TOTALS = """
    WITH totals AS (
      SELECT afs_uid, afs_m49_code, afs_iso3c, afs_year, sum(CAST(afs_value AS BIGINT)) AS total
      FROM input WHERE afs_value IS NOT NULL AND afs_m49_code IS NOT NULL GROUP BY afs_uid, afs_m49_code, afs_iso3c, afs_year)
    SELECT afs_uid, 'extra' AS extra, afs_m49_code, afs_iso3c, CAST(NULL AS STRING) AS area_ref, CAST(NULL AS STRING) AS area_name,
           afs_year, CAST(total AS DOUBLE) AS afs_value, CAST(CAST(total AS BIGINT) AS STRING) AS value, 'cents' AS afs_unit,
           CAST(NULL AS STRING) AS afs_flag, '{}' AS GEO, '{}' AS TIME_PERIOD, '{}' AS SERIES, '{}' AS DIMS, '{}' AS ATTRS,
           'faostat_qcl' AS afs_source_code, '' AS afs_source_updated_at, %s AS afs_source_ingested_at
    FROM totals"""
_LATEST = """
    SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY afs_m49_code, afs_unit ORDER BY afs_year DESC NULLS LAST, value DESC NULLS LAST, GEO, SERIES, ATTRS, TIME_PERIOD, area_name NULLS LAST, area_ref NULLS LAST) AS rn
        FROM input) AS ranked WHERE rn = 1"""


@case("stage_pre_process", f"""
    {_VIEW}, i1 AS (SELECT 'totals' AS afs_uid, * FROM v WHERE afs_year >= 1996),
    i2 AS (SELECT 'latest' AS afs_uid, * FROM v WHERE afs_m49_code IS NOT NULL),
    t AS ({_TOTALS.replace('FROM input', 'FROM i1') % f"'{INGESTED_AT}'"}), l AS ({_LATEST.replace('FROM input', 'FROM i2')})
    SELECT * EXCLUDE (extra) FROM t UNION ALL BY NAME SELECT * EXCLUDE (rn) FROM l
    UNION ALL BY NAME SELECT 'late' AS afs_uid, * FROM v WHERE afs_year >= 2000""")
def stage_pre_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [
        Indicator("totals", "afs_year >= 1996", _TOTALS % f"TIMESTAMP '{INGESTED_AT}'" + " ;\n"),
        Indicator("latest", "afs_m49_code IS NOT NULL", _LATEST),
        Indicator("late", "afs_year >= 2000", " "),
    ]
    return shown(select_indicators(view(spark, sf_dir, CODE), wanted))


# Stage tables --------------------------------------------------------------

def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, f"stage_{uuid.uuid4().hex}", scratch_folder(spark, "stage"))


def _config(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(
        rows, "afs_uid string, afs_source_code string, filter_string string, status string, pre_process string")


@case("replace_by_key", """
    SELECT o_orderpriority AS afs_uid, o_orderkey, 1 AS generation FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')
    UNION ALL SELECT o_orderpriority, o_orderkey, 2 FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus = 'F'""")
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three uids are replaced twice over; one of them has no rows any more."""
    lake = _lake(spark)
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("afs_uid"), "o_orderkey", "o_orderstatus")
    lake.write("stg_orders_tbl", rows.drop("o_orderstatus").withColumn("generation", F.lit(1)), "afs_uid", replace=False)
    new = rows.where("o_orderstatus = 'F' AND afs_uid <> '2-HIGH'").drop("o_orderstatus").withColumn("generation", F.lit(2))
    for _ in range(2):
        lake.replace_keys("stg_orders_tbl", new, "afs_uid", ["1-URGENT", "2-HIGH", "5-LOW"])
    return lake.read("stg_orders_tbl")


# The next version of the view: rows of one unit are gone, those of one area doubled.
_NEXT = "SELECT * FROM v WHERE afs_flag IS DISTINCT FROM 'flag 4' UNION ALL SELECT * FROM v WHERE afs_m49_code = '007' AND afs_year = 1997"


@case("stage_refreshed", f"""
    {_VIEW}, v2 AS ({_NEXT}), changed AS (
        (SELECT * EXCLUDE (afs_source_ingested_at) FROM v EXCEPT ALL SELECT * EXCLUDE (afs_source_ingested_at) FROM v2)
        UNION ALL (SELECT * EXCLUDE (afs_source_ingested_at) FROM v2 EXCEPT ALL SELECT * EXCLUDE (afs_source_ingested_at) FROM v))
    {" UNION ALL ".join(f"SELECT '{uid}' AS afs_uid, (SELECT count(*) FROM v2 WHERE {sql}) AS n_rows, EXISTS (SELECT 1 FROM changed WHERE {sql}) AS restaged"
                        for uid, _, sql in PREDICATES)}""")
def stage_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new version of a source: rows of each indicator afterwards, and whether it was staged anew."""
    lake = _lake(spark)
    lake.write(stage.CONFIG, _config(spark, [(uid, CODE, condition, "ACTIVE", None) for uid, condition, _ in PREDICATES]))
    now = view(spark, sf_dir, CODE)
    later = now.where("NOT (afs_flag <=> 'flag 4')").unionByName(now.where("afs_m49_code = '007' AND afs_year = 1997"))
    stage.reconstruct(lake, {CODE: now})
    log = stage.refresh(lake, {CODE: now}, {CODE: later}).where("job_status = 'SUCCESS'").select(F.explode("afs_uid_list").alias("afs_uid"), F.lit(True).alias("restaged"))
    counts = lake.read(stage.table_name(CODE)).groupBy("afs_uid").agg(F.count("*").alias("n_rows"))
    asked = spark.createDataFrame([(uid,) for uid, _, _ in PREDICATES], "afs_uid string")
    return asked.join(counts, "afs_uid", "left").join(log, "afs_uid", "left").select(
        "afs_uid", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("restaged", F.lit(False)).alias("restaged"))


CONFIG_ROWS = [
    ("late", CODE, "afs_year >= 2000", "DRAFT", None),
    ("area", CODE, "afs_m49_code IN ('003', '007')", "ACTIVE", None),
    ("old", CODE, "afs_year < 1997", "REVIEW", None),
    ("off", CODE, "TRUE", "INACTIVE", None),
    ("blank", CODE, " ", "DRAFT", None),
    ("elsewhere", "unknown_source", "TRUE", "DRAFT", None),
    ("big", "fsd", "afs_value > 25000000", "DRAFT", None),
    ("broken", "usda", "no_such_column = 1", "DRAFT", None),
]


def _stage_run(spark: SparkSession, sf_dir: str) -> Lake:
    """update() on a new lake, then reconstruct() of one source, then update() again with a changed uid."""
    lake = _lake(spark)
    views = {code: view(spark, sf_dir, code) for code in (CODE, "fsd", "usda")}
    lake.write(stage.CONFIG, _config(spark, CONFIG_ROWS))
    stage.update(lake, views, run_id="run1")
    stage.reconstruct(lake, views, [CODE, "nowhere"], run_id="run2")
    changed = lake.read(stage.CONFIG).withColumns({
        "filter_string": F.when(F.col("afs_uid") == "old", F.lit("afs_year < 1996")).otherwise(F.col("filter_string")),
        "status": F.when(F.col("afs_uid") == "old", F.lit("DRAFT")).otherwise(F.col("status")),
    })
    lake.write(stage.CONFIG, changed)
    stage.update(lake, views, run_id="run3")
    return lake


@case("stage_tables", f"""
    SELECT * FROM ({_VIEW} SELECT 'late' AS afs_uid, * FROM v WHERE afs_year >= 2000
      UNION ALL SELECT 'area', * FROM v WHERE afs_m49_code IN ('003', '007')
      UNION ALL SELECT 'old', * FROM v WHERE afs_year < 1996)
    UNION ALL SELECT 'big', * FROM ({duck.view_query('fsd')}) WHERE afs_value > 25000000""")
def stage_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the stage tables after three runs."""
    lake = _stage_run(spark, sf_dir)
    return shown(lake.read(stage.table_name(CODE)).unionByName(lake.read(stage.table_name("fsd"))))


@case("stage_rebuilt_rows", f"""
    {_VIEW} SELECT 'late' AS afs_uid, * FROM v WHERE afs_year >= 2000
    UNION ALL SELECT 'area', * FROM v WHERE afs_m49_code IN ('003', '007')
    UNION ALL SELECT 'old', * FROM v WHERE afs_year < 1997""")
def stage_rebuilt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    lake.write(stage.CONFIG, _config(spark, CONFIG_ROWS))
    stage.reconstruct(lake, {CODE: view(spark, sf_dir, CODE)})
    return shown(lake.read(stage.table_name(CODE)))


@case("stage_run_log", f"""
    {_VIEW}, counts AS (SELECT count(*) FILTER (afs_year >= 2000) AS late, count(*) FILTER (afs_m49_code IN ('003', '007')) AS area,
        count(*) FILTER (afs_year < 1997) AS old, count(*) FILTER (afs_year < 1996) AS older FROM v),
    big AS (SELECT count(*) AS big FROM obs WHERE k % 11 <> 0 AND k % 29 <> 0 AND k % 31 <> 0 AND k % 37 <> 0 AND k % 41 <> 0 AND cents > 25000000)
    SELECT 'run1' AS run_id, 'UPDATE' AS run_type, 'stg_faostat_qcl_tbl' AS stg_tbl, 'late' AS uids, 'SUCCESS' AS job_status, late AS rows_affected FROM counts
    UNION ALL SELECT 'run1', 'UPDATE', 'stg_fsd_tbl', 'big', 'SUCCESS', big FROM big
    UNION ALL SELECT 'run1', 'UPDATE', 'stg_usda_tbl', 'broken', 'FAILED', NULL
    UNION ALL SELECT 'run2', 'RECONSTRUCT', 'stg_faostat_qcl_tbl', 'area,late,old', 'SUCCESS', late + area + old FROM counts
    UNION ALL SELECT 'run3', 'UPDATE', 'stg_faostat_qcl_tbl', 'old', 'SUCCESS', older FROM counts
    UNION ALL SELECT 'run3', 'UPDATE', 'stg_usda_tbl', 'broken', 'FAILED', NULL
    UNION ALL SELECT run, 'UPDATE', t, u, 'SKIPPED', NULL FROM (VALUES ('run1'), ('run3')) AS r(run),
        (VALUES ('stg_faostat_qcl_tbl', 'blank'), ('stg_unknown_source_tbl', 'elsewhere')) AS s(t, u)
    UNION ALL SELECT 'run2', 'RECONSTRUCT', 'stg_faostat_qcl_tbl', 'blank', 'SKIPPED', NULL
    UNION ALL SELECT 'run2', 'RECONSTRUCT', 'stg_nowhere_tbl', '', 'SKIPPED', NULL""")
def stage_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _stage_run(spark, sf_dir).read(stage.LOG)
    return log.select("run_id", "run_type", "stg_tbl", F.array_join("afs_uid_list", ",").alias("uids"), "job_status", "rows_affected")


# Orphans: customers' segments are uids, two of them without a runnable config row.
_LIVE = [("BUILDING", "ACTIVE"), ("MACHINERY", "DRAFT"), ("FURNITURE", "INACTIVE"), ("HOUSEHOLD", "REVIEW")]


@case("orphan_stage_rows", f"""
    WITH obs AS ({OBSERVATIONS}) SELECT kind AS afs_source_code, CAST(count(*) AS BIGINT) AS n_rows FROM obs
    WHERE part NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY kind ORDER BY kind""")
def orphan_stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage_frame = observations(spark, sf_dir).select(F.col("kind").alias("afs_source_code"), F.col("part").alias("afs_uid"))
    return orphan_rows(stage_frame, spark.createDataFrame(_LIVE, "afs_uid string, status string"))


@case("run_log_rows", "SELECT o_orderstatus AS stg_tbl, count(*) AS rows_affected, TRUE AS dated FROM orders GROUP BY o_orderstatus")
def run_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written one by one, their row counts appended to a log."""
    lake = _lake(spark)
    for kind in ("F", "O", "P"):
        n = lake.write(f"t_{kind}", table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == kind))
        runlog.write_log(lake, stage.LOG, runlog.STAGE_LOG, [{"stg_tbl": kind, "rows_affected": n, "created_at": runlog.now()}])
    return lake.read(stage.LOG).select("stg_tbl", "rows_affected", F.col("created_at").isNotNull().alias("dated"))
