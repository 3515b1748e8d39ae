"""Configuration rows, table differences and status changes.

Customers stand for config rows: two share a uid, statuses and blanks rotate.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake.functions import source_version
from indicatorlake.operators import quality as q
from indicatorlake.operators.changes import key_diff, row_changes
from indicatorlake.operators.lookup import duplicate_keys
from indicatorlake.plans import sync
from indicatorlake.session import scratch_folder
from indicatorlake.sources import config as c
from indicatorlake.sources.tables import Lake, new_versions

from .registry import case
from .standins import run_sql, table

CONFIG = """
    SELECT CASE WHEN c_custkey % 43 = 0 THEN ' ' WHEN c_custkey % 47 = 0 THEN NULL
                WHEN c_custkey % 9 = 0 THEN 'U' || CAST(c_custkey + 1 AS STRING)
                ELSE 'U' || CAST(c_custkey AS STRING) END AS afs_uid,
           CASE WHEN c_custkey % 31 = 0 THEN '' ELSE 'src' || CAST(c_nationkey AS STRING) END AS afs_source_code,
           CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN '  '
                ELSE 'afs_year >= ' || CAST(1990 + c_custkey % 10 AS STRING) END AS filter_string,
           CASE c_custkey % 8 WHEN 0 THEN 'DRAFT' WHEN 1 THEN 'REVIEW' WHEN 2 THEN 'ACTIVE' WHEN 3 THEN 'INACTIVE'
                WHEN 4 THEN 'DELETED' WHEN 5 THEN 'PAUSED' WHEN 6 THEN NULL ELSE 'DRAFT' END AS status,
           c_custkey AS row_no
    FROM customer
"""
VIEWS = "SELECT 'src' || CAST(n_nationkey AS STRING) AS afs_source_code FROM nation WHERE n_regionkey <> 2"


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, CONFIG, "customer")


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, VIEWS, "nation")


_CHECKED = f"""
    WITH cfg AS ({CONFIG}), views AS ({VIEWS}),
    live AS (SELECT * FROM cfg WHERE status IS NULL OR status NOT IN ('INACTIVE', 'DELETED')),
    flags AS (SELECT *, count(*) OVER (PARTITION BY afs_uid) AS copies,
                     coalesce(trim(afs_uid), '') = '' AS no_uid, coalesce(trim(afs_source_code), '') = '' AS no_src
              FROM live),
    checked AS (SELECT afs_uid, afs_source_code, filter_string, status, row_no, concat_ws(';',
        CASE WHEN coalesce(status NOT IN ('DRAFT', 'REVIEW', 'ACTIVE'), TRUE) THEN 'bad status' END,
        CASE WHEN no_uid THEN 'blank afs_uid' END,
        CASE WHEN no_src THEN 'blank afs_source_code' END,
        CASE WHEN coalesce(trim(filter_string), '') = '' THEN 'blank filter_string' END,
        CASE WHEN copies > 1 AND NOT no_uid THEN 'duplicate afs_uid' END,
        CASE WHEN NOT no_src AND afs_source_code NOT IN (SELECT afs_source_code FROM views) THEN 'missing view' END
    ) AS reasons FROM flags)
"""


@case("config_checks", f"{_CHECKED} SELECT * FROM checked")
def config_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = q.with_reasons(config(spark, sf_dir), views(spark, sf_dir))
    return checked.withColumn("reasons", F.array_join("reasons", ";"))


@case("config_valid_rows", f"{_CHECKED} SELECT * EXCLUDE (reasons) FROM checked WHERE reasons = ''")
def config_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.valid_rows(config(spark, sf_dir), views(spark, sf_dir))


@case("config_runnable_slice", f"""{_CHECKED} SELECT * EXCLUDE (reasons) FROM checked
    WHERE reasons = '' AND status IN ('DRAFT', 'REVIEW') AND afs_source_code IN ('src1', 'src3', 'src9')""")
def config_runnable_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = q.valid_rows(config(spark, sf_dir), views(spark, sf_dir))
    return q.runnable(valid, ["DRAFT", "REVIEW"], ["src1", "src3", "src9"])


@case("config_status_counts", f"""
    WITH cfg AS ({CONFIG}) SELECT status, count(*) AS n_rows FROM cfg
    WHERE status IS NULL OR status NOT IN ('INACTIVE', 'DELETED') GROUP BY status""")
def config_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.status_counts(q.live_rows(config(spark, sf_dir)))


@case("config_keyed_rows", f"""
    WITH cfg AS ({CONFIG}) SELECT * FROM cfg WHERE afs_source_code IS NOT NULL AND afs_source_code <> ''""")
def config_keyed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.keyed_rows(config(spark, sf_dir), "afs_source_code")


@case("config_source_codes", f"WITH cfg AS ({CONFIG}) SELECT DISTINCT afs_source_code FROM cfg WHERE afs_source_code IS NOT NULL")
def config_source_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.source_codes(config(spark, sf_dir))


_DONE = ["U8", "U15", "U24", "U16", "U9"]


@case("status_promotion", f"""
    WITH cfg AS ({CONFIG}) SELECT * REPLACE (CASE WHEN status = 'DRAFT' AND afs_uid IN ('U8', 'U15', 'U24', 'U16', 'U9')
        THEN 'REVIEW' ELSE status END AS status) FROM cfg""")
def status_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.promote(config(spark, sf_dir), _DONE)


@case("config_update_fields", """
    SELECT c_custkey, c_name, coalesce(CAST(last_key AS VARCHAR), c_mktsegment) AS c_mktsegment
    FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last_key FROM orders WHERE o_orderstatus = 'P'
                             GROUP BY o_custkey) ON c_custkey = o_custkey""")
def config_update_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    last = (
        table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("c_mktsegment"))
    )
    return c.update_fields(rows, last, "c_custkey")


@case("config_text_out", f"""
    WITH cfg AS ({CONFIG}) SELECT coalesce(afs_uid, '') AS afs_uid, afs_source_code,
        coalesce(filter_string, '') AS filter_string, coalesce(status, '') AS status,
        CAST(row_no AS VARCHAR) AS row_no FROM cfg""")
def config_text_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.sheet_rows(config(spark, sf_dir))


_V1 = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0"
_V2 = "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'"


@case("table_diff", f"""
    WITH v1 AS ({_V1}), v2 AS ({_V2})
    SELECT 'row' AS kind, CAST(c_custkey AS VARCHAR) AS name, 'left' AS only_in FROM v1
    WHERE c_custkey NOT IN (SELECT c_custkey FROM v2)
    UNION ALL SELECT 'row', CAST(c_custkey AS VARCHAR), 'right' FROM v2
    WHERE c_custkey NOT IN (SELECT c_custkey FROM v1)
    UNION ALL SELECT 'column', 'c_acctbal', 'left' UNION ALL SELECT 'column', 'c_mktsegment', 'right'""")
def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = run_sql(spark, sf_dir, _V1, "customer"), run_sql(spark, sf_dir, _V2, "customer")
    only_left, only_right = q.column_diff(left, right)
    columns = [("column", n, "left") for n in only_left] + [("column", n, "right") for n in only_right]
    rows = key_diff(left, right, "c_custkey").select(F.lit("row").alias("kind"), F.col("key").alias("name"), "only_in")
    return rows.unionByName(spark.createDataFrame(columns, rows.schema))


# Lines of two versions: some are gone, some came, some changed a NULL from one column to the other, some are there once more.
_LINES = "SELECT l_orderkey, l_suppkey, l_returnflag, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linestatus END AS l_linestatus, l_quantity FROM lineitem"
_BEFORE = f"SELECT * FROM ({_LINES}) WHERE l_orderkey % 50 <> 7"
_AFTER = f"""SELECT l_orderkey, l_suppkey, CASE WHEN l_orderkey % 40 = 3 THEN l_linestatus ELSE l_returnflag END AS l_returnflag,
        CASE WHEN l_orderkey % 40 = 3 THEN l_returnflag ELSE l_linestatus END AS l_linestatus, l_quantity FROM ({_LINES}) WHERE l_orderkey % 60 <> 9
    UNION ALL SELECT * FROM ({_LINES}) WHERE l_orderkey % 70 = 1 AND l_orderkey % 60 <> 9"""


@case("changed_rows", f"""
    WITH b AS ({_BEFORE}), a AS ({_AFTER})
    SELECT 'gone' AS kind, *, count(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL
    UNION ALL SELECT 'came', *, count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL""")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new version of a table lost and gained, each row as often as it did."""
    before, after = run_sql(spark, sf_dir, _BEFORE, "lineitem"), run_sql(spark, sf_dir, _AFTER, "lineitem")
    found = row_changes(before, after, before.columns)
    return found.select(F.when(F.col("n_before") > F.col("n_after"), F.lit("gone")).otherwise(F.lit("came")).alias("kind"), *before.columns,
                        F.abs(F.col("n_before") - F.col("n_after")).alias("n"))


@case("table_problems", """
    SELECT * FROM (VALUES ('empty', 'empty is empty', CAST(0 AS BIGINT)), ('odd', 'odd has blank column names at [2]', 0), ('odd', 'odd repeats column names [''c_name'']', 0))
    AS t(kind, issue, n) WHERE (SELECT count(*) FROM customer) > 0
    UNION ALL SELECT 'fine', 'keys of c_nationkey in several rows', count(*) FROM (SELECT 1 FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1)
    UNION ALL SELECT 'fine', 'blank cells of label', count(*) FROM customer WHERE c_custkey % 4 IN (0, 1)
    UNION ALL SELECT 'fine', 'blank cells of c_custkey', 0""")
def table_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard problems of a table without rows, one with unusable columns, and one that is fine, whose rows are looked at too."""
    customers = table(spark, sf_dir, "customer")
    rows = customers.select("c_name", "c_custkey")
    odd = rows.select("c_name", F.col("c_name"), F.col("c_custkey").alias(" "))
    found = [(kind, issue, 0) for kind, df in (("empty", rows.where("c_custkey < 0")), ("odd", odd), ("fine", rows)) for issue in q.table_issues(df, kind)]
    issues = spark.createDataFrame(found, "kind string, issue string, n long")
    label = F.when(F.col("c_custkey") % 4 == 0, F.lit(" ")).when(F.col("c_custkey") % 4 != 1, F.col("c_name"))
    blank = q.blank_cells(customers.select("c_custkey", label.alias("label")))
    twice = duplicate_keys(customers, ["c_nationkey", "c_mktsegment"]).agg(F.count("*").alias("n"))
    return issues.unionByName(twice.select(F.lit("fine").alias("kind"), F.lit("keys of c_nationkey in several rows").alias("issue"), "n")).unionByName(
        blank.select(F.lit("fine").alias("kind"), F.concat(F.lit("blank cells of "), "column_name").alias("issue"), F.col("n_blank").alias("n")))


@case("missing_inputs", """
    SELECT DISTINCT l_partkey, CASE WHEN l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N' AND l_quantity < 10)
        THEN 'found' ELSE 'missing' END AS state FROM lineitem WHERE l_returnflag = 'R'""")
def missing_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    expected = lines.where("l_returnflag = 'R'")
    existing = lines.where("l_returnflag = 'N' AND l_quantity < 10")
    found = q.present_in(expected, existing, "l_partkey").withColumn("state", F.lit("found"))
    return found.unionByName(q.missing_from(expected, existing, "l_partkey").withColumn("state", F.lit("missing")))


# A day as publishers write it, each sort of order in a way of its own; day first only where the day is beyond 12.
_Y, _M, _D = "CAST(year(o_orderdate) AS STRING)", "CAST(month(o_orderdate) AS STRING)", "CAST(day(o_orderdate) AS STRING)"
_WANTED = f"""SELECT DISTINCT 'src' || CAST(o_custkey AS STRING) AS afs_source_code, CAST(o_orderdate AS DATE) AS day,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' WHEN o_orderpriority = '1-URGENT' AND day(o_orderdate) > 12 THEN {_D} || '/' || {_M} || '/' || {_Y}
         WHEN o_orderpriority = '1-URGENT' THEN {_M} || '/' || {_D} || '/' || {_Y} || ' 0:00'
         WHEN o_orderpriority = '2-HIGH' THEN {_Y} || '.' || {_M} || '.' || {_D}
         WHEN o_orderpriority = '3-MEDIUM' THEN {_M} || '/' || {_D} || '/' || CAST(year(o_orderdate) - 1900 + 1900 AS STRING)
         ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS published
    FROM orders"""
_STORED = "SELECT 'src' || CAST(o_custkey AS STRING) AS afs_source_code, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'F'"


@case("new_versions", f"""
    WITH wanted AS (SELECT DISTINCT afs_source_code, CASE WHEN published = 'unknown' THEN 'run'
                    ELSE strftime(day, '%Y%m%d') END AS version FROM ({_WANTED})),
    stored AS (SELECT afs_source_code, strftime(day, '%Y%m%d') AS version FROM ({_STORED}))
    SELECT * FROM wanted ANTI JOIN stored USING (afs_source_code, version)""")
def new_source_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = run_sql(spark, sf_dir, _WANTED, "orders").select(
        "afs_source_code", source_version(F.col("published"), "run").alias("version")).distinct()
    stored = run_sql(spark, sf_dir, _STORED, "orders").select(
        "afs_source_code", F.date_format("day", "yyyyMMdd").alias("version"))
    return new_versions(wanted, stored)


@case("config_sheet_push", """
    SELECT '00' || CAST(c_custkey AS VARCHAR) AS afs_uid, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS status,
           'push' AS direction, 'SUCCESS' AS outcome, CAST(count(*) OVER () AS VARCHAR) || ' rows' AS detail FROM customer""")
def config_sheet_push(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes such as 007 keep their zeros on the way from sheet to table."""
    lake = Lake(spark, f"sync_{uuid.uuid4().hex}", scratch_folder(spark, "sync"))
    sheet = table(spark, sf_dir, "customer").selectExpr(
        "concat('00', c_custkey) AS afs_uid", "c_name", "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS status")
    sheet.write.option("header", True).csv(f"{lake.root}/sheet.csv")
    sync.push(lake, f"{lake.root}/sheet.csv", "cfg_stage_tbl", "afs_uid")
    log = lake.read(sync.LOG).head()
    noted = {"direction": log.direction, "outcome": log.status, "detail": log.detail}
    return lake.read("cfg_stage_tbl").withColumns({k: F.lit(v) for k, v in noted.items()})
