"""How the files of each source become one text table.

A recipe takes (spark, folder, names) and returns a DataFrame; ``names`` holds
the tables for turning area names into codes.  Sources without an entry in
RECIPES use ``long_table``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_blank, strip_dot_zero
from ..operators.areas import alias_table, name_codes, region_table
from ..operators.lookup import duplicate_keys, first_per_key, lookup_join
from ..operators.reshape import columns_to_rows, quoted, years_to_rows
from .csv import POSITION, all_csvs, csv_by_name, csv_headers, csv_names, find_long_table, long_table_csv, named_csv, read_csv, read_csvs
from .naming import slug


@dataclass(frozen=True)
class AreaNames:
    areas: DataFrame  # m49_code, iso3c, area_name
    regions: DataFrame  # area_name, m49_code
    aliases: DataFrame  # anchor, pattern, m49_code
    by_words: bool = True  # whether names that match nothing word for word are told by their rarest words

    @staticmethod
    def standard(areas: DataFrame) -> AreaNames:
        spark = areas.sparkSession
        return AreaNames(areas, region_table(spark), alias_table(spark))


Recipe = Callable[[SparkSession, str, AreaNames | None], DataFrame]


def lookup_table(
    spark: SparkSession,
    path: str,
    keys: list[str],
    *,
    select: list[str] | None = None,
    rename: dict[str, str] | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """A lookup file reduced to its first row per key."""
    rows = read_csv(spark, path, rename=rename, drop=drop, require=select or (), position=True)
    lacking = [k for k in keys if k not in rows.columns]
    if lacking:
        raise KeyError(f"{path} lacks key columns {lacking}")
    if select:
        rows = rows.select([F.col(quoted(c)) for c in (*select, POSITION)])
    return first_per_key(rows, keys, POSITION)


def long_table(spark: SparkSession, folder: str, names: AreaNames | None = None) -> DataFrame:
    """One long CSV, taken as it is."""
    return read_csv(spark, long_table_csv(spark, folder))


# File and column names of the wide development-indicator release.
WIDE_IDS = ["Country Name", "Country Code", "Indicator Name", "Indicator Code"]
WIDE_SERIES_COLUMNS = [
    "Series Code",
    "Topic",
    "Long definition",
    "Unit of measure",
    "Periodicity",
    "Base Period",
    "Other notes",
    "Aggregation method",
    "Limitations and exceptions",
    "Source",
    "Statistical concept and methodology",
    "Development relevance",
]
WIDE_FILES = {
    "main": "WDICSV.csv",
    "series": "WDISeries.csv",
    "country": "WDIcountry-series.csv",
    "time": "WDIseries-time.csv",
    "footnote": "WDIfootnote.csv",
}


def wide_with_lookups(spark: SparkSession, folder: str, names: AreaNames | None = None) -> DataFrame:
    """Years in columns, plus series metadata and three kinds of notes."""
    names_below = csv_names(spark, folder)
    path = {k: named_csv(folder, names_below, v) for k, v in WIDE_FILES.items()}
    wide = read_csv(spark, path["main"], require=WIDE_IDS)
    years = [c for c in wide.columns if c not in WIDE_IDS]
    rows = columns_to_rows(wide, WIDE_IDS, years, "wb_year", "Value").where(F.col("Value").isNotNull())
    rows = rows.withColumn("wb_year_code", F.concat(F.lit("YR"), F.col("wb_year")))

    series = lookup_table(spark, path["series"], ["Series Code"], select=WIDE_SERIES_COLUMNS)
    rows = lookup_join(rows, series, {"Indicator Code": "Series Code"})
    country = {"Country Code": "CountryCode", "Indicator Code": "SeriesCode"}
    year = {"Indicator Code": "SeriesCode", "wb_year_code": "Year"}
    notes = [
        ("country", "NOTE_country_series", country),
        ("time", "NOTE_series_time", year),
        ("footnote", "NOTE_footnote", {**country, **year}),
    ]
    for file, column, on in notes:
        note = lookup_table(spark, path[file], list(on.values()), rename={"DESCRIPTION": column})
        rows = lookup_join(rows, note, on)
    return rows


# File name and the columns that hold measures rather than codes.
INCENTIVES_FILE = "Aggregated_NRA 2025.csv"
INCENTIVES_MEASURES = {"support_usd", "relevantvalueproduction", "nra"}


def codes_without_dot_zero(spark: SparkSession, folder: str, names: AreaNames | None = None) -> DataFrame:
    """Integer codes written as 2005.0 lose the fraction; measures stay as they are."""
    rows = read_csv(spark, csv_by_name(spark, folder, INCENTIVES_FILE))
    return rows.select(
        [
            F.col(quoted(c)) if c.lower() in INCENTIVES_MEASURES
            else strip_dot_zero(F.col(quoted(c))).alias(c)
            for c in rows.columns
        ]
    )


# File and column names of the fishery releases.
PRODUCTION_MAIN = "GLOBAL_PRODUCTION_raw_data (without aggregates).csv"
PRODUCTION_SPECIES = "GLOBAL_PRODUCTION_SPECIES_ATTRIBUTES.csv"
PRODUCTION_WATER = "GLOBAL_PRODUCTION_WATER_AREA_ATTRIBUTES.csv"
PROCESSED_MAIN = "AQUATIC_PROCESSED_PRODUCTION_raw_data (without aggregates).csv"
PROCESSED_PRODUCT = "AQUATIC_PROCESSED_PRODUCTION_PRODUCT_ATTRIBUTES.csv"


def fishery_production(spark: SparkSession, folder: str, names: AreaNames | None = None) -> DataFrame:
    """Main table with species and water-area attributes."""
    main = read_csv(
        spark, csv_by_name(spark, folder, PRODUCTION_MAIN), require=["SPECIES", "WATER_AREA"]
    )
    # SPECIES is the key and Species its name: renamed before they can clash.
    species = lookup_table(
        spark, csv_by_name(spark, folder, PRODUCTION_SPECIES), ["SPECIES"], rename={"Species": "species_name"}
    )
    water = lookup_table(
        spark, csv_by_name(spark, folder, PRODUCTION_WATER), ["WATER_AREA"], drop=("Fishing Area",)
    )
    rows = lookup_join(main, species, {"SPECIES": "SPECIES"})
    return lookup_join(rows, water, {"WATER_AREA": "WATER_AREA"})


def fishery_processed(spark: SparkSession, folder: str, names: AreaNames | None = None) -> DataFrame:
    """Main table with product attributes."""
    main = read_csv(spark, csv_by_name(spark, folder, PROCESSED_MAIN), require=["PRODUCT"])
    product = lookup_table(spark, csv_by_name(spark, folder, PROCESSED_PRODUCT), ["PRODUCT"])
    return lookup_join(main, product, {"PRODUCT": "PRODUCT"})


# File and column names of the footprint and labour releases.
FOOTPRINT_FILE = "national-data-export.csv"
FOOTPRINT_AREA, FOOTPRINT_CODE = "Country/Region", "ref_m49_code"
LABOUR_AREA, LABOUR_CODE = "ref_area.label", "ref_area.m49code"


def _with_area_codes(rows: DataFrame, area: str, code: str, names: AreaNames, skip: bool = False) -> DataFrame:
    codes = name_codes(rows, area, code, names.areas, names.regions, names.aliases, skip, names.by_words)
    return lookup_join(rows, codes, {area: area})


def wide_with_names(spark: SparkSession, folder: str, names: AreaNames | None) -> DataFrame:
    """Years in columns, areas given by name only."""
    found = csv_names(spark, folder)
    path = f"{folder.rstrip('/')}/{FOOTPRINT_FILE}" if FOOTPRINT_FILE in found else long_table_csv(spark, folder)
    wide = read_csv(spark, path, require=[FOOTPRINT_AREA])
    rows = years_to_rows(wide, "year", "value")
    return _with_area_codes(rows, FOOTPRINT_AREA, FOOTPRINT_CODE, names)


def many_files_with_names(spark: SparkSession, folder: str, names: AreaNames | None) -> DataFrame:
    """Several long files of differing columns, areas given by name; files without the name are left out (see passed_over).

    All files are read in one scan, whatever their headers, so the plan does not grow
    with their number.
    """
    headers = {path: header for path, header in csv_headers(spark, all_csvs(spark, folder)).items() if LABOUR_AREA in header}
    if not headers:
        raise KeyError(f"no csv below {folder} has a column {LABOUR_AREA}")
    rows = read_csvs(spark, headers)
    return _with_area_codes(rows, LABOUR_AREA, LABOUR_CODE, names, skip=True)


def passed_over(spark: SparkSession, source_code: str, folder: str) -> list[str]:
    """CSVs of a landed folder that the source's recipe does not read, and why, for the log."""
    recipe = recipe_for(source_code)
    if recipe is many_files_with_names:
        return [f"no column {LABOUR_AREA}: {p}" for p, header in csv_headers(spark, all_csvs(spark, folder)).items() if LABOUR_AREA not in header]
    if recipe is long_table:
        return [f"not the first long table: {n}" for n in find_long_table(spark, folder).passed_over]
    return []


# Lookup files of each source and their keys; columns of the finished table that hold area names and codes.
LOOKUPS = {
    "wb_wdi": [(WIDE_FILES["series"], ["Series Code"]), (WIDE_FILES["country"], ["CountryCode", "SeriesCode"]),
               (WIDE_FILES["time"], ["SeriesCode", "Year"]), (WIDE_FILES["footnote"], ["CountryCode", "SeriesCode", "Year"])],
    "fao_fishstat_globalproduction": [(PRODUCTION_SPECIES, ["SPECIES"]), (PRODUCTION_WATER, ["WATER_AREA"])],
    "fao_fishstat_processed": [(PROCESSED_PRODUCT, ["PRODUCT"])],
}
NAMED = {wide_with_names: (FOOTPRINT_AREA, FOOTPRINT_CODE), many_files_with_names: (LABOUR_AREA, LABOUR_CODE)}
NAMES_IN_LOG = 20


def repeated_lookup_keys(spark: SparkSession, source_code: str, folder: str) -> list[str]:
    """Lookup files in which a key has several rows, of which only the first counts, for the log."""
    out = []
    for file, keys in LOOKUPS.get(source_code, []):
        n = duplicate_keys(read_csv(spark, csv_by_name(spark, folder, file), require=keys), keys).count()
        if n:
            out.append(f"{file}: {n} keys have several rows, the first counts")
    return out


def lost_names(table: DataFrame, source_code: str) -> DataFrame | None:
    """(name): the distinct area names of a finished source table that got no code; None for sources without names to match."""
    if recipe_for(source_code) not in NAMED:
        return None
    name, code = (slug(c) for c in NAMED[recipe_for(source_code)])
    return table.where(F.col(code).isNull() & ~is_blank(F.col(name))).select(F.col(name).alias("name")).distinct()


def names_without_code(lost: DataFrame) -> list[str]:
    """What the log says of lost names: how many, and the first of them."""
    first = [r[0] for r in lost.orderBy("name").limit(NAMES_IN_LOG + 1).collect()]
    if not first:
        return []
    more = f" and {lost.count() - NAMES_IN_LOG} more" if len(first) > NAMES_IN_LOG else ""
    return [f"names without a code: {', '.join(first[:NAMES_IN_LOG])}{more}"]


RECIPES: dict[str, Recipe] = {
    "wb_wdi": wide_with_lookups,
    "agincentives": codes_without_dot_zero,
    "fao_fishstat_globalproduction": fishery_production,
    "fao_fishstat_processed": fishery_processed,
    "scp_hat_national": wide_with_names,
    "ilostat_emp_dwap_rt": many_files_with_names,
    "ilostat_emp_xtru_rt": many_files_with_names,
    "ilostat_emp_xtru_nb": many_files_with_names,
}


def recipe_for(source_code: str) -> Recipe:
    return RECIPES.get(source_code, long_table)
