"""The 49 views, and the column functions they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake import functions as fn
from indicatorlake.operators.reshape import diagonal_union, rename_columns, rows_per_measure
from indicatorlake.plans.harmonise import harmonise
from indicatorlake.plans.ingest import source_view_name
from indicatorlake.plans.specs import SPECS
from indicatorlake.plans.stage import view_name
from indicatorlake.plans.views import register_views
from indicatorlake.sources.tables import register_view

from . import duck
from .registry import case
from .standins import AREA_CELLS, OBSERVATIONS, VALUE_CELL, YEAR_CELLS, areas, observations, raw_source, shown, table


def view(spark: SparkSession, sf_dir: str, code: str) -> DataFrame:
    return harmonise(raw_source(spark, sf_dir, code), areas(spark, sf_dir), code)


def _register(code: str) -> None:
    @case(f"view_{code}", duck.view_query(code))
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(view(spark, sf_dir, code))


for _code in SPECS:
    _register(_code)


@case("area_keys", rf"""
    WITH obs AS ({OBSERVATIONS}), raw AS (SELECT k, {AREA_CELLS['m49']} AS code FROM obs),
    cut AS (SELECT k, code, regexp_replace(code, '^''', '') AS bare FROM raw)
    SELECT k, code, CASE WHEN length(bare) < 3 THEN lpad(bare, 3, '0') ELSE bare END AS m49_key FROM cut""")
def area_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = observations(spark, sf_dir).selectExpr("k", f"{AREA_CELLS['m49']} AS code")
    return raw.select("k", "code", fn.m49_key(F.col("code")).alias("m49_key"))


_YEAR_COLUMNS = {"plain": "p", "last_four": "l", "range_end": "r", "leading": "q", "census": "c"}
_YEAR_RAW = ", ".join(f"{YEAR_CELLS[rule][0]} AS {c}" for rule, c in _YEAR_COLUMNS.items())
_YEAR_RAW += f", {YEAR_CELLS['end_or_start'][0]} AS e, {YEAR_CELLS['end_or_start'][1]} AS s, {AREA_CELLS['survey']} AS v"


@case("year_rules", f"""
    WITH obs AS ({OBSERVATIONS}), raw AS (SELECT k, {_YEAR_RAW} FROM obs)
    SELECT k, {', '.join(f"{duck.YEARS[rule](c)} AS {rule}" for rule, c in _YEAR_COLUMNS.items())},
           {duck.YEARS['end_or_start']('e', 's')} AS end_or_start, {duck.YEARS['last_four']('v')} AS survey
    FROM raw""")
def year_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(f"SELECT k, {_YEAR_RAW} FROM {{obs}}", obs=observations(spark, sf_dir))
    rules = [fn.afs_year(rule, F.col(c)).alias(rule) for rule, c in _YEAR_COLUMNS.items()]
    return raw.select(
        "k", *rules,
        fn.afs_year("end_or_start", F.col("e"), F.col("s")).alias("end_or_start"),
        fn.afs_year("last_four", F.col("v")).alias("survey"),
    )


@case("safe_numbers", f"""
    WITH obs AS ({OBSERVATIONS}), raw AS (SELECT k, {VALUE_CELL} AS value FROM obs)
    SELECT k, value, {duck.safe_double('value')} AS as_double, {duck.safe_int('value')} AS as_int,
           nullif(value, 'NA') AS without_na FROM raw""")
def safe_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    raw = observations(spark, sf_dir).selectExpr("k", f"{VALUE_CELL} AS value")
    return raw.select(
        "k", "value",
        fn.safe_double(value).alias("as_double"),
        fn.safe_int(value).alias("as_int"),
        fn.na_to_null(value).alias("without_na"),
    )


_CODES = """CASE l_linenumber % 3 WHEN 0 THEN CAST(l_partkey AS STRING) || '.0'
            WHEN 1 THEN ' -' || CAST(l_suppkey AS STRING) || '.00 ' ELSE CAST(l_partkey AS STRING) || '.5' END"""


@case("strip_dot_zero", rf"""
    SELECT l_orderkey, l_linenumber, {_CODES} AS raw_code,
           CASE WHEN regexp_full_match({_CODES}, '\s*-?\d+\.0+\s*')
                THEN regexp_extract({_CODES}, '(-?\d+)\.0', 1) ELSE {_CODES} END AS code FROM lineitem""")
def strip_dot_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_CODES} AS raw_code")
    return raw.withColumn("code", fn.strip_dot_zero(F.col("raw_code")))


@case("code_label_rename", """
    SELECT o_orderkey, o_orderstatus AS element_code, o_orderpriority AS element FROM orders""")
def code_label_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus AS element", "o_orderpriority AS element_1")
    return rename_columns(raw, {"element": "element_code", "element_1": "element"})


_MEASURES = """CAST(CAST(l_quantity AS BIGINT) AS STRING) AS support_usd,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) END AS relevantvalueproduction,
    CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS STRING) END AS nra"""


@case("unpivot_measures", f"""
    WITH raw AS (SELECT l_orderkey, l_linenumber, l_partkey, {_MEASURES} FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, measure, value,
           CASE WHEN measure <> 'nra' THEN 'USD' END AS unit
    FROM (UNPIVOT raw ON support_usd, relevantvalueproduction, nra INTO NAME measure VALUE value)""")
def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(f"SELECT l_orderkey, l_linenumber, l_partkey, {_MEASURES} FROM {{lineitem}}",
                    lineitem=table(spark, sf_dir, "lineitem"))
    rows = rows_per_measure(raw, ("support_usd", "relevantvalueproduction", "nra"), "measure", "value")
    return rows.withColumn("unit", F.when(F.col("measure") != "nra", F.lit("USD")))


@case("lineage_timestamp", """
    SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS VARCHAR) AS ingested_at,
           strftime(o_orderdate, '%Y%m%d') AS version,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d') ELSE 'run' END AS version_or_run
    FROM orders""")
def lineage_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("string")
    published = F.when(F.col("o_orderstatus") == "F", day).otherwise(F.lit("soon"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.strict_timestamp(day).cast("string").alias("ingested_at"),
        fn.source_version(day, "run").alias("version"),
        fn.source_version(published, "run").alias("version_or_run"),
    )


@case("view_batch", """
    SELECT code AS afs_source_code, action, status, n_rows FROM (VALUES ('fsd', 'CREATE', 'SUCCESS', TRUE), ('usda', 'REPLACE', 'SUCCESS', TRUE),
        ('wb_wgi', '', 'SKIPPED', FALSE), ('No Code', '', 'SKIPPED', FALSE)) AS t(code, action, status, made)
    LEFT JOIN (SELECT count(*) AS n_rows FROM orders JOIN customer ON o_custkey = c_custkey) ON made""")
def view_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views are made for the sources that have a table, replaced where there is one already."""
    for code in ("fsd", "usda"):
        register_view(raw_source(spark, sf_dir, code), source_view_name(code))
        spark.catalog.dropTempView(view_name(code))
    register_views(areas(spark, sf_dir), ["usda"])
    _, rows = register_views(areas(spark, sf_dir), ["fsd", "usda", "wb_wgi", "No Code", "fsd"])
    made = [spark.table(r["target_view"]).groupBy(F.lit(r["afs_source_code"]).alias("afs_source_code")).agg(F.count(F.lit(1)).alias("n_rows"))
            for r in rows if r["status"] == "SUCCESS"]
    outcome = spark.createDataFrame(
        [(r["afs_source_code"], r["action"], r["status"]) for r in rows], "afs_source_code string, action string, status string")
    return outcome.join(diagonal_union(made), "afs_source_code", "left")
