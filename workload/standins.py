"""Indicator-like inputs derived from the driver tables.

Text expressions here are read by Spark and by DuckDB alike, so both sides
start from the same raw cells; everything after that is written twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake.plans.specs import SPECS, ViewSpec

START_YEAR, END_YEAR = 1998, 2001
UPDATED_AT, INGESTED_AT = "2024-05-01", "2024-06-01 10:20:30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Area reference: nations outside the first region are in scope, the others stay unmatched.
AREAS = """
    SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS m49_code,
           'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS iso3c,
           n_name AS area_name
    FROM nation WHERE n_regionkey <> 0
"""

# Observations: one per order, placed in the customer's nation.
OBSERVATIONS = """
    SELECT o_orderkey AS k, c_nationkey AS nat, CAST(year(o_orderdate) AS BIGINT) AS yr,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
           o_orderstatus AS kind, o_orderpriority AS grade, c_mktsegment AS part
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


def run_sql(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """Run SQL over the named driver tables."""
    frames = {n: table(spark, sf_dir, n) for n in names}
    for name in names:
        sql = _as_argument(sql, name)
    return spark.sql(sql, **frames)


def _as_argument(sql: str, name: str) -> str:
    return re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}} AS {name}", sql)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, AREAS, "nation")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, OBSERVATIONS, "orders", "customer")


# Raw cells of a key column, by area rule.
AREA_CELLS = {
    "m49": """CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN ''
                   WHEN k % 3 = 0 THEN chr(39) || lpad(CAST(nat AS STRING), 3, '0')
                   WHEN k % 23 = 0 THEN '1' || lpad(CAST(nat AS STRING), 3, '0')
                   ELSE CAST(nat AS STRING) END""",
    "iso3": "CASE WHEN k % 17 = 0 THEN NULL ELSE 'N' || lpad(CAST(nat AS STRING), 2, '0') END",
    "survey": """lpad(CAST(nat AS STRING), 3, '0') || '_' ||
                 CASE WHEN k % 13 = 0 THEN 'late' ELSE CAST(yr AS STRING) END""",
}
AREA_CELLS["m49_plain"] = AREA_CELLS["m49"]

# Raw cells of the year columns, by year rule and position.
YEAR_CELLS = {
    "plain": ["CASE WHEN k % 13 = 0 THEN CAST(yr AS STRING) || '-' || CAST(yr + 2 AS STRING) ELSE CAST(yr AS STRING) END"],
    "last_four": ["CAST(yr - 2 AS STRING) || CAST(yr AS STRING)"],
    "range_end": ["CASE WHEN k % 13 = 0 THEN 'n/a' ELSE CAST(yr - 10 AS STRING) || '-' || CAST(yr AS STRING) || ' ' END"],
    "leading": ["CASE WHEN k % 2 = 0 THEN CAST(yr AS STRING) || 'Q' || CAST(1 + k % 4 AS STRING) ELSE CAST(yr AS STRING) END"],
    "end_or_start": ["CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(yr + 1 AS STRING) END", "CAST(yr AS STRING)"],
    "census": ["""CASE WHEN k % 13 = 0 THEN NULL WHEN k % 2 = 0 THEN CAST(yr AS STRING)
                       ELSE CAST(yr AS STRING) || lpad(CAST((yr + 1) % 100 AS STRING), 2, '0') END"""],
}

VALUE_CELL = """CASE WHEN k % 11 = 0 THEN '<2.5' WHEN k % 29 = 0 THEN 'NA' WHEN k % 31 = 0 THEN NULL
                     WHEN k % 37 = 0 THEN '1d' WHEN k % 41 = 0 THEN '12e3' ELSE CAST(cents AS STRING) END"""


def other_cell(name: str, i: int) -> str:
    return (
        f"CASE WHEN (k + {i}) % 7 = 0 THEN NULL WHEN (k + {i}) % 11 = 0 THEN 'NA' "
        f"ELSE '{name} ' || CAST((k * {i + 1}) % 13 AS STRING) || CASE WHEN k % 5 = 0 THEN ' \"x\"' ELSE '' END END"
    )


def raw_cells(spec: ViewSpec) -> dict[str, str]:
    """Raw column name to the expression of its cells over OBSERVATIONS."""
    cells = {name: other_cell(name, i) for i, name in enumerate(spec.raw_columns())}
    years = [c for c in spec.year[1:] if c in cells]
    cells.update(zip(years, YEAR_CELLS[spec.year[0]]))
    for value in spec.measures or (spec.value,):
        cells[value] = VALUE_CELL if value in ("value", "obs_value") else f"CASE WHEN k % {2 + len(value) % 5} = 0 THEN NULL ELSE ({VALUE_CELL}) END"
    cells[spec.area] = AREA_CELLS[spec.area_rule]
    return cells


def raw_source(spark: SparkSession, sf_dir: str, code: str) -> DataFrame:
    """The raw source table of one view, with lineage."""
    cells = {
        **raw_cells(SPECS[code]),
        "afs_source_code": f"'{code}'",
        "afs_source_updated_at": f"'{UPDATED_AT}'",
        "afs_source_ingested_at": f"'{INGESTED_AT}'",
    }
    return observations(spark, sf_dir).selectExpr(*[f"{e} AS `{n}`" for n, e in cells.items()])


def shown(df: DataFrame) -> DataFrame:
    """Timestamps as text, the form both engines print alike."""
    return df.select(
        [F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
         for f in df.schema]
    )
