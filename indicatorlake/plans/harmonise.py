"""Raw source table to the 17-column observation view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import afs_year, bag, na_to_null, pad_m49, safe_double, strict_timestamp, strip_quote
from ..operators.areas import join_areas
from ..operators.reshape import rename_columns, rows_per_measure
from .specs import BAGS, SPECS, ViewSpec

# The canonical columns, in order.
OBSERVATION = T.StructType(
    [
        T.StructField("afs_m49_code", T.StringType()),
        T.StructField("afs_iso3c", T.StringType()),
        T.StructField("area_ref", T.StringType()),
        T.StructField("area_name", T.StringType()),
        T.StructField("afs_year", T.LongType()),
        T.StructField("afs_value", T.DoubleType()),
        T.StructField("value", T.StringType()),
        T.StructField("afs_unit", T.StringType()),
        T.StructField("afs_flag", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in BAGS],
        T.StructField("afs_source_code", T.StringType()),
        T.StructField("afs_source_updated_at", T.StringType()),
        T.StructField("afs_source_ingested_at", T.TimestampType()),
    ]
)


def _area_columns(spec: ViewSpec) -> dict[str, Column]:
    """Cleaned key and published area code."""
    raw = F.col(spec.area).cast("string")
    if spec.area_rule == "survey":
        return {"_key": F.left(raw, F.lit(3)), "_ref": F.left(raw, F.lit(3)),
                "survey_year": F.right(raw, F.lit(4))}
    if spec.area_rule == "iso3":
        return {"_key": raw, "_ref": raw}
    code = raw if spec.area_rule == "m49_plain" else strip_quote(raw)
    key = pad_m49(code)
    return {"_key": key, "_ref": code if spec.area_ref == "raw" else key}


def _text(column: str | None, na: bool = False) -> Column:
    if column is None:
        return F.lit(None).cast("string")
    text = F.col(column).cast("string")
    return na_to_null(text) if na else text


def _unit(spec: ViewSpec) -> Column:
    if spec.unit_when:
        column, values, unit = spec.unit_when
        return F.when(F.col(column).isin(*values), F.lit(unit))
    return _text(spec.unit, spec.na_values)


def harmonise(source: DataFrame, areas: DataFrame, spec: ViewSpec | str) -> DataFrame:
    """Map one source to the canonical columns; rows of unknown areas stay, with NULL codes.

    One narrow pass over the source.  ``areas`` (m49_code, iso3c) is joined
    left, so Spark broadcasts it by size and the source is not shuffled.
    """
    spec = SPECS[spec] if isinstance(spec, str) else spec
    rows = rename_columns(source, spec.renames)
    if spec.measures:
        rows = rows_per_measure(rows, spec.measures, "measure", "value")
    rows = rows.withColumns(_area_columns(spec))

    def entry(column: str, na: bool) -> Column:
        return F.col("_key") if column == "@" else _text(column, na)

    bags = {
        name: bag({key: entry(column, na) for key, column, na in spec.entries(name)}) for name in BAGS
    }
    # Everything but the area codes is made before the join, so that only the
    # canonical columns pass through it however many the source has.
    observed = rows.select(
        "_key",
        F.col("_ref").alias("area_ref"),
        _text(spec.area_name, spec.na_values).alias("area_name"),
        afs_year(spec.year[0], *[F.col(c) for c in spec.year[1:]]).alias("afs_year"),
        safe_double(F.col(spec.value)).alias("afs_value"),
        _text(spec.value).alias("value"),
        _unit(spec).alias("afs_unit"),
        _text(spec.flag, spec.na_values).alias("afs_flag"),
        *[bags[name].alias(name) for name in BAGS],
        F.col("afs_source_code").cast("string").alias("afs_source_code"),
        F.col("afs_source_updated_at").cast("string").alias("afs_source_updated_at"),
        strict_timestamp(F.col("afs_source_ingested_at")).alias("afs_source_ingested_at"),
    )
    on = "iso3c" if spec.area_rule == "iso3" else "m49_code"
    joined = join_areas(observed, areas, F.col("_key"), on)
    return joined.select(
        F.col("_m49_code").alias("afs_m49_code"), F.col("_iso3c").alias("afs_iso3c"), *observed.columns[1:]
    )


def assert_observation(df: DataFrame, name: str) -> DataFrame:
    """Fail early when a frame does not have the canonical columns and types."""
    wanted = [(f.name, f.dataType) for f in OBSERVATION]
    found = [(f.name, f.dataType) for f in df.schema if f.name != "afs_uid"]
    if found != wanted:
        raise ValueError(f"{name} has columns {found}, wanted {wanted}")
    return df
