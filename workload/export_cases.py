"""The published tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicatorlake.operators.grid import TAXONOMY, reference_grid
from indicatorlake.plans import export, ingest, kept, stage
from indicatorlake.plans.views import register_views
from indicatorlake.session import scratch_folder
from indicatorlake.sources.tables import Lake, export_files

from . import config_cases, duck
from .harmonise_cases import view
from .registry import ORACLES, case
from .stage_cases import CODE
from .standins import AREAS, END_YEAR, START_YEAR, UPDATED_AT, areas, raw_source, run_sql, shown

_TWO = ("faostat_qcl", "wb_wdi")
_RAW = " UNION ALL ".join(
    f"SELECT * FROM (WITH {duck.source_sql(code)} {duck.view_sql(code)}) WHERE afs_year >= {START_YEAR}" for code in _TWO
)


@case("raw_export", f"SELECT * FROM ({_RAW}) ORDER BY afs_m49_code, afs_source_code, afs_year")
def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(export.raw_export({code: view(spark, sf_dir, code) for code in _TWO}, START_YEAR))


@case("reference_grid", f"""
    WITH cfg AS ({config_cases.CONFIG}), areas AS ({AREAS}),
    uids AS (SELECT DISTINCT afs_uid FROM cfg WHERE status IN ('REVIEW', 'ACTIVE'))
    SELECT m49_code AS afs_m49_code, area_name AS afs_area_name, afs_uid, y.y AS afs_year
    FROM areas, uids, (SELECT unnest(generate_series({START_YEAR}, {END_YEAR})) AS y) AS y""")
def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    uids = export.published_uids(config_cases.config(spark, sf_dir))
    return reference_grid(areas(spark, sf_dir), uids, START_YEAR, END_YEAR)


# Indicators: one per customer and state, published or not by their state.
_CONFIG = f"""
    SELECT 'U' || CAST(c_custkey AS STRING) AS afs_uid, 'feed' AS afs_source_code,
           CASE WHEN c_acctbal < 0 THEN 'INACTIVE' WHEN c_acctbal < 3000 THEN 'ACTIVE'
                WHEN c_acctbal < 6000 THEN 'REVIEW' ELSE 'DRAFT' END AS status,
           'TRUE' AS filter_string, {', '.join(f"'{c} ' || c_mktsegment AS {c}" for c in TAXONOMY)}
    FROM customer
"""
_STAGE_ROWS = """
    SELECT 'U' || CAST(o_custkey AS STRING) AS afs_uid,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE lpad(CAST(c_nationkey AS STRING), 3, '0') END AS afs_m49_code,
           CAST(year(o_orderdate) AS BIGINT) + CASE WHEN o_orderkey % 13 = 0 THEN 3 ELSE 0 END AS afs_year,
           CAST(o_orderkey AS DOUBLE) AS afs_value, CAST(o_orderkey AS STRING) AS value, o_orderstatus AS afs_unit
    FROM orders JOIN customer ON o_custkey = c_custkey
"""
_REST = ["afs_iso3c", "area_ref", "area_name", "afs_value", "value", "afs_unit", "afs_flag", "GEO", "TIME_PERIOD",
         "SERIES", "DIMS", "ATTRS", "afs_source_code", "afs_source_updated_at", "afs_source_ingested_at"]
_FILLED = ["afs_value", "value", "afs_unit"]
_REST_SQL = ", ".join(f"s.{c}" if c in _FILLED else f'CAST(NULL AS VARCHAR) AS "{c}"' for c in _REST)


def _stage_frame(spark: SparkSession, sf_dir: str, stage_rows: str = _STAGE_ROWS) -> DataFrame:
    rows = run_sql(spark, sf_dir, stage_rows, "orders", "customer")
    nulls = {c: F.lit(None).cast("timestamp" if c == "afs_source_ingested_at" else "string") for c in _REST if c not in _FILLED}
    columns = ["afs_uid", "afs_m49_code", "afs_iso3c", "area_ref", "area_name", "afs_year", *_REST[3:]]
    return rows.withColumns(nulls).select(columns)


@case("gap_filled_export", f"""
    WITH cfg AS ({_CONFIG}), areas AS ({AREAS}), stg AS (SELECT * FROM ({_STAGE_ROWS}) WHERE afs_year >= {START_YEAR}),
    uids AS (SELECT DISTINCT afs_uid FROM cfg WHERE status IN ('REVIEW', 'ACTIVE')),
    ref AS (SELECT m49_code AS afs_m49_code, area_name AS afs_area_name, afs_uid, y.y AS afs_year
            FROM areas, uids, (SELECT unnest(generate_series({START_YEAR}, {END_YEAR})) AS y) AS y),
    joined AS (
      SELECT r.afs_m49_code, r.afs_uid, r.afs_year, r.afs_area_name, {_REST_SQL}
      FROM ref AS r LEFT JOIN stg AS s USING (afs_m49_code, afs_uid, afs_year)
      UNION ALL SELECT s.afs_m49_code, s.afs_uid, s.afs_year, NULL, {_REST_SQL}
      FROM stg AS s LEFT JOIN ref AS r USING (afs_m49_code, afs_uid, afs_year) WHERE r.afs_year IS NULL),
    tax AS (SELECT DISTINCT afs_uid AS uid, {', '.join(TAXONOMY)} FROM cfg WHERE status IN ('REVIEW', 'ACTIVE'))
    SELECT joined.*, {', '.join(TAXONOMY)} FROM joined LEFT JOIN tax ON afs_uid = uid""")
def gap_filled_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = run_sql(spark, sf_dir, _CONFIG, "customer")
    stage_frame = _stage_frame(spark, sf_dir)
    return shown(export.gap_filled_export(stage_frame, areas(spark, sf_dir), config, START_YEAR, END_YEAR))


# Sixty indicators; the next day some have other rows, states or taxonomies, and one is gone.
_FEW_STAGE = _STAGE_ROWS.replace("CAST(o_custkey AS STRING)", "CAST(o_custkey % 60 AS STRING)")
_FEW_CONFIG = f"{_CONFIG} WHERE c_custkey < 60"
_NEXT_STAGE = f"""SELECT afs_uid, afs_m49_code, afs_year, CASE WHEN afs_uid LIKE '%7' THEN afs_value + 1 ELSE afs_value END AS afs_value, value, afs_unit
    FROM ({_FEW_STAGE}) WHERE afs_uid NOT LIKE '%9' OR afs_year <> 1997"""
_NEXT_CONFIG = f"""SELECT afs_uid, afs_source_code, CASE WHEN afs_uid LIKE '%3' THEN 'INACTIVE' ELSE status END AS status, filter_string,
    {', '.join(f"CASE WHEN afs_uid LIKE '%5' THEN 'new' ELSE {c} END AS {c}" for c in TAXONOMY)} FROM ({_FEW_CONFIG}) WHERE afs_uid <> 'U11'"""


def _filled_sql(config: str, stage_rows: str) -> str:
    sql = ORACLES["gap_filled_export"]
    return sql.replace(f"cfg AS ({_CONFIG})", f"cfg AS ({config})").replace(f"FROM ({_STAGE_ROWS})", f"FROM ({stage_rows})")


@case("gap_filled_refreshed", _filled_sql(_NEXT_CONFIG, _NEXT_STAGE))
def gap_filled_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept table after a whole build, a day on which some indicators changed, and a run of that day alone."""
    lake = Lake(spark, f"kept_{uuid.uuid4().hex}", scratch_folder(spark, "kept"))
    table = stage.table_name("feed")
    lake.write(stage.CONFIG, run_sql(spark, sf_dir, _FEW_CONFIG, "customer"))
    first = _stage_frame(spark, sf_dir, _FEW_STAGE)
    lake.write(table, first, "afs_uid")
    kept.refresh_gap_filled(lake, areas(spark, sf_dir), START_YEAR, END_YEAR)
    values = run_sql(spark, sf_dir, _NEXT_STAGE, "orders", "customer").select("value", F.col("afs_value").alias("_next"))
    later = first.join(values, "value").withColumn("afs_value", F.col("_next")).select(first.columns)
    some = [r[0] for r in first.select("afs_uid").distinct().collect() if r[0][-1] in "79"]
    for part in (some[::2], some[1::2]):
        lake.replace_keys(table, later, "afs_uid", part)
    lake.write(stage.CONFIG, run_sql(spark, sf_dir, _NEXT_CONFIG, "customer"))
    kept.refresh_gap_filled(lake, areas(spark, sf_dir), START_YEAR, END_YEAR)
    return shown(kept.kept_rows(lake))


@case("parquet_roundtrip", f"SELECT * FROM ({duck.view_query('fsd')})")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger export is followed by a smaller one into the same folder; nothing of the first is left."""
    folder = f"{scratch_folder(spark, 'files')}/exp"
    export_files(view(spark, sf_dir, "fsd").repartition(7), folder, compression="zstd", rows_per_file=1000)
    export_files(view(spark, sf_dir, "fsd"), folder)
    return shown(spark.read.parquet(folder))


@case("stored_grid", f"""
    WITH cfg AS ({_CONFIG}), areas AS ({AREAS}),
    uids AS (SELECT DISTINCT afs_uid FROM cfg WHERE status IN ('REVIEW', 'ACTIVE'))
    SELECT m49_code AS afs_m49_code, area_name AS afs_area_name, afs_uid, y.y AS afs_year, TRUE AS in_order
    FROM areas, uids, (SELECT unnest(generate_series({START_YEAR}, {END_YEAR})) AS y) AS y""")
def stored_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid as a table; in_order compares every row with the last one before it in its file."""
    lake = Lake(spark, f"grid_{uuid.uuid4().hex}", scratch_folder(spark, "grid"))
    lake.write(stage.CONFIG, run_sql(spark, sf_dir, _CONFIG, "customer"))
    export.build_grid(lake, areas(spark, sf_dir), START_YEAR, END_YEAR)
    rows = lake.read(export.GRID_TABLE)
    key = F.struct("afs_m49_code", "afs_uid", "afs_year")
    inside = Window.partitionBy("file").orderBy("n")
    numbered = rows.select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"), key.alias("key"))
    ordered = F.coalesce(F.lag("key").over(inside) <= F.col("key"), F.lit(True))
    return numbered.select(*rows.columns, ordered.alias("in_order"))


_CONFIG_ROWS = [("late", CODE, "afs_year >= 2000", "ACTIVE"), ("area", CODE, "afs_m49_code IN ('003', '007')", "REVIEW"),
                ("fresh", CODE, "afs_year = 1999", "DRAFT"), ("lost", "no_such_source", "TRUE", "ACTIVE")]


def _exported(spark: SparkSession, sf_dir: str) -> tuple[Lake, str]:
    lake = Lake(spark, f"export_{uuid.uuid4().hex}", scratch_folder(spark, "export"))
    rows = [(*r, *[f"{c} {r[0]}" for c in TAXONOMY]) for r in _CONFIG_ROWS]
    types = ", ".join(f"{c} string" for c in ("afs_uid", "afs_source_code", "filter_string", "status", *TAXONOMY))
    lake.write(stage.CONFIG, spark.createDataFrame(rows, types))
    views = {CODE: view(spark, sf_dir, CODE)}
    stage.reconstruct(lake, views)
    folder = f"{lake.root}/out"
    export.run_raw_export(lake, views, folder, START_YEAR, run_id="raw")
    export.run_gap_filled_export(lake, areas(spark, sf_dir), folder, START_YEAR, END_YEAR, run_id="filled")
    return lake, folder


_EXPORT_VIEW = f"WITH {duck.source_sql(CODE)}, v AS ({duck.view_sql(CODE)})"
_PICKED = f"""picked AS (SELECT 'late' AS afs_uid, * FROM v WHERE afs_year >= 2000 UNION ALL
        SELECT 'area', * FROM v WHERE afs_m49_code IN ('003', '007') AND afs_year >= {START_YEAR} UNION ALL
        SELECT 'fresh', * FROM v WHERE afs_year = 1999),
    ref AS (SELECT m49_code AS afs_m49_code, area_name AS afs_area_name, u AS afs_uid, y AS afs_year
        FROM areas, (VALUES ('late'), ('area'), ('fresh'), ('lost')) AS t(u), (SELECT unnest(generate_series({START_YEAR}, {END_YEAR})) AS y))"""
_OBSERVED = ["afs_iso3c", "area_ref", "area_name", "afs_value", "value", "afs_unit", "afs_flag", "GEO", "TIME_PERIOD",
             "SERIES", "DIMS", "ATTRS", "afs_source_code", "afs_source_updated_at", "afs_source_ingested_at"]


def _select(prefix: str) -> str:
    return ", ".join(f'{prefix}."{c}"' for c in _OBSERVED)


# fresh was a DRAFT when the tables were built and is REVIEW from then on, so its rows and cells count.
@case("published_files", f"""
    {_EXPORT_VIEW}, {_PICKED},
    joined AS (SELECT r.afs_m49_code, r.afs_uid, r.afs_year, r.afs_area_name, {_select("p")}
          FROM ref AS r LEFT JOIN picked AS p USING (afs_m49_code, afs_uid, afs_year)
        UNION ALL SELECT p.afs_m49_code, p.afs_uid, p.afs_year, NULL, {_select("p")}
          FROM picked AS p LEFT JOIN ref AS r USING (afs_m49_code, afs_uid, afs_year) WHERE r.afs_year IS NULL)
    SELECT joined.*, {", ".join(f"'{c} ' || afs_uid AS {c}" for c in TAXONOMY)} FROM joined""")
def published_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both workflows from view to files; the rows of the gap-filled one, read back from its files."""
    _, folder = _exported(spark, sf_dir)
    return shown(spark.read.parquet(f"{folder}/{export.STAGE_TABLE}/*"))


@case("published_raw_files", f"{_EXPORT_VIEW} SELECT * FROM v WHERE afs_year >= {START_YEAR}")
def published_raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _exported(spark, sf_dir)
    return shown(spark.read.parquet(f"{folder}/{export.SOURCE_TABLE}/*"))


@case("export_log", f"""
    {_EXPORT_VIEW}, {_PICKED}, raw_rows AS (SELECT count(*) AS n FROM v WHERE afs_year >= {START_YEAR}), grid AS (SELECT count(*) AS n FROM ref),
    full_rows AS (SELECT count(*) AS n FROM picked FULL JOIN ref USING (afs_m49_code, afs_uid, afs_year))
    SELECT 'raw' AS run_id, 'CHECK_INPUTS' AS step, 'src_no_such_source_vw' AS object_name, 'SKIPPED' AS job_status, NULL AS rows_affected
    UNION ALL SELECT 'raw', 'BUILD_SRC_TABLE', 'exp_src_long_tbl', 'SUCCESS', n FROM raw_rows
    UNION ALL SELECT 'raw', 'EXPORT_SRC_FILES', 'exp_src_long_tbl', 'SUCCESS', n FROM raw_rows
    UNION ALL SELECT 'filled', 'CHECK_INPUTS', 'stg_no_such_source_tbl', 'SKIPPED', NULL
    UNION ALL SELECT 'filled', 'BUILD_REF_TABLE', 'exp_ref_area_indicator_year', 'SUCCESS', n FROM grid
    UNION ALL SELECT 'filled', 'BUILD_STG_TABLE', 'exp_stg_long_tbl', 'SUCCESS', n FROM full_rows
    UNION ALL SELECT 'filled', 'EXPORT_STG_FILES', 'exp_stg_long_tbl', 'SUCCESS', n FROM full_rows""")
def export_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _exported(spark, sf_dir)
    name = F.element_at(F.split("object_name", "/"), -1)
    return lake.read(export.LOG).select("run_id", "step", name.alias("object_name"), "job_status", "rows_affected")


# Two days ----------------------------------------------------------------

def _landed(spark: SparkSession, sf_dir: str, lake: Lake) -> str:
    raw = raw_source(spark, sf_dir, CODE).drop("afs_source_code", "afs_source_updated_at", "afs_source_ingested_at")
    raw.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{lake.root}/in/a.csv")
    return f"{lake.root}/in"


@case("second_run", f"""
    {_EXPORT_VIEW} SELECT afs_m49_code, afs_iso3c, nullif(area_ref, '') AS area_ref, area_name, afs_year, afs_value, value, afs_unit, afs_flag, "GEO", "SERIES", 'late' AS afs_uid,
        'SKIPPED' AS second FROM v WHERE afs_year >= 2000""")
def second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is landed; on the next day, without the first session's views, it is skipped, and the rest of the work finds it all the same."""
    lake = Lake(spark, f"days_{uuid.uuid4().hex}", scratch_folder(spark, "days"))
    folder = _landed(spark, sf_dir, lake)
    lake.write(ingest.SOURCE_CONFIG, spark.createDataFrame(
        [(CODE, "ag", UPDATED_AT, None)], "afs_source_code string, agency string, afs_source_updated_at string, afs_source_ingested_at string"))
    lake.write(stage.CONFIG, spark.createDataFrame(
        [("late", CODE, "afs_year >= 2000", "DRAFT", *[c for c in TAXONOMY])],
        ", ".join(f"{c} string" for c in ("afs_uid", "afs_source_code", "filter_string", "status", *TAXONOMY))))
    ingest.ingest(lake, {CODE: folder}, None)
    spark.catalog.dropTempView(ingest.source_view_name(CODE))
    spark.catalog.dropTempView(stage.view_name(CODE))
    second = ingest.ingest(lake, {CODE: folder}, None).head().status
    made, _ = register_views(areas(spark, sf_dir), [CODE], lake=lake)
    stage.update(lake, made)
    export.run_gap_filled_export(lake, areas(spark, sf_dir), f"{lake.root}/out", START_YEAR, END_YEAR)
    rows = lake.read(export.STAGE_TABLE).where("afs_source_code IS NOT NULL")
    return rows.select("afs_m49_code", "afs_iso3c", "area_ref", "area_name", "afs_year", "afs_value", "value", "afs_unit", "afs_flag", "GEO", "SERIES",
                       "afs_uid", F.lit(second).alias("second"))


@case("default_grid_years", f"""
    SELECT m49_code AS afs_m49_code, y AS afs_year FROM ({AREAS}), (SELECT unnest(generate_series(2010, CAST(year(current_date) AS BIGINT))) AS y)""")
def default_grid_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without an end year the grid ends with this year."""
    uids = spark.createDataFrame([("u",)], "afs_uid string")
    return reference_grid(areas(spark, sf_dir), uids, 2010).select("afs_m49_code", "afs_year")
