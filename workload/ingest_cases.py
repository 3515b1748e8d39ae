"""Source recipes over CSV folders that Spark writes from the driver tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake.operators.areas import name_codes, region_table, unmatched_names
from indicatorlake.operators.lookup import duplicate_keys, first_per_key, lookup_join
from indicatorlake.operators.reshape import columns_to_rows, diagonal_union, years_to_rows
from indicatorlake.plans import ingest, runlog
from indicatorlake.session import scratch_folder
from indicatorlake.sources import recipes
from indicatorlake.sources.csv import all_csvs, csv_headers, csv_rejects, read_csv, read_csvs
from indicatorlake.sources.naming import LINEAGE, source_table
from indicatorlake.sources.tables import Lake

from .registry import case
from .standins import AREAS, INGESTED_AT, OBSERVATIONS, UPDATED_AT, areas, observations, run_sql, table

LINEAGE_VALUES = dict(zip(LINEAGE, ("feed", UPDATED_AT, INGESTED_AT)))
LINEAGE_SQL = f"'feed' AS afs_source_code, '{UPDATED_AT}' AS afs_source_updated_at, '{INGESTED_AT}' AS afs_source_ingested_at"
YEARS = list(range(1995, 2002))


@contextmanager
def _case_sensitive(spark: SparkSession):
    """Only to write a header holding names that differ in case alone."""
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def _land(df: DataFrame, path: str, *names: str) -> None:
    """Write a CSV folder with the given header."""
    with _case_sensitive(df.sparkSession):
        writer = df.toDF(*names) if names else df
        writer.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                             ignoreTrailingWhiteSpace=False).csv(path)


@case("slug_columns_all_string", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS part_key_no, p_name AS part_name, p_brand AS part_name_1,
           CAST(p_size AS VARCHAR) AS unnamed_3, CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) AS retail_price_cents,
           p_type AS prix_d_unite, {LINEAGE_SQL} FROM part""")
def slug_columns_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "p_brand", "p_size", "CAST(round(p_retailprice * 100) AS BIGINT)", "p_type")
    raw = parts.toDF("Part Key (No.)", "Part Name", "part-name", " ", "Retail Price, Cents", "Prix d'unité")
    return source_table(raw, LINEAGE_VALUES)


# Wide tables ---------------------------------------------------------------

def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer's nation and status, a column per year, some cells blank."""
    cell = "CASE WHEN s % 7 = 0 THEN ' ' ELSE CAST(s AS STRING) END"
    sums = observations(spark, sf_dir).groupBy("part", "nat", "kind").pivot("yr", YEARS).agg(F.sum("cents"))
    return sums.select("part", "nat", "kind", *[F.expr(cell.replace("s %", f"`{y}` %").replace("CAST(s", f"CAST(`{y}`")).alias(f" {y} ") for y in YEARS])


_LONG_SQL = f"""
    WITH obs AS ({OBSERVATIONS}), sums AS (SELECT part, nat, kind, yr, CAST(sum(cents) AS BIGINT) AS s FROM obs GROUP BY ALL),
    long AS (SELECT part, nat, kind, CAST(yr AS VARCHAR) AS year, CASE WHEN s % 7 = 0 THEN ' ' ELSE CAST(s AS VARCHAR) END AS value FROM sums)
"""


@case("unpivot_years", f"{_LONG_SQL} SELECT * FROM long WHERE trim(value) <> ''")
def unpivot_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return years_to_rows(_wide(spark, sf_dir), "year", "value")


@case("unpivot_non_null", f"{_LONG_SQL} SELECT part, nat, kind, ' ' || year || ' ' AS year, value FROM long")
def unpivot_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide(spark, sf_dir)
    rows = columns_to_rows(wide, ["part", "nat", "kind"], wide.columns[3:], "year", "value")
    return rows.where(F.col("value").isNotNull())


# Lookups -------------------------------------------------------------------

# Part rows come twice, as two versions; the first one counts.
_PART_VERSIONS = """
    SELECT p_partkey, p_name AS label, p_brand AS brand, 2 AS version FROM part WHERE p_size < 30
    UNION ALL SELECT p_partkey, upper(p_name) AS label, NULL AS brand, 1 AS version FROM part WHERE p_size > 20 AND p_size < 40
"""


@case("lookup_1key", f"""
    WITH versions AS ({_PART_VERSIONS}),
    kept AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY version) = 1)
    SELECT l_orderkey, l_linenumber, l_partkey, label, brand FROM lineitem LEFT JOIN kept ON l_partkey = p_partkey""")
def lookup_1key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    kept = first_per_key(run_sql(spark, sf_dir, _PART_VERSIONS, "part"), ["p_partkey"], "version")
    return lookup_join(lines, kept, {"l_partkey": "p_partkey"})


# Notes of a (part, supplier) pair: the one of the earliest order counts; a status column clashes and is dropped.
_NOTES = "SELECT l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, l_orderkey AS note, 'x' AS l_returnflag FROM lineitem WHERE l_linestatus = 'F'"


@case("lookup_2key", f"""
    WITH notes AS ({_NOTES})
    SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, note FROM lineitem
    LEFT JOIN (SELECT pk, sk, min(note) AS note FROM notes GROUP BY ALL) ON l_partkey = pk AND l_suppkey = sk""")
def lookup_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    notes = run_sql(spark, sf_dir, _NOTES, "lineitem").drop("ln").withColumn("seq", F.col("note"))
    return lookup_join(lines, first_per_key(notes, ["pk", "sk"], "seq"), {"l_partkey": "pk", "l_suppkey": "sk"})


@case("lookup_3key", f"""
    WITH notes AS ({_NOTES})
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, note FROM lineitem
    LEFT JOIN (SELECT pk, sk, ln, min(note) AS note FROM notes GROUP BY ALL) ON l_partkey = pk AND l_suppkey = sk AND l_linenumber = ln""")
def lookup_3key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    notes = run_sql(spark, sf_dir, _NOTES, "lineitem").drop("l_returnflag").withColumn("seq", F.col("note"))
    kept = first_per_key(notes, ["pk", "sk", "ln"], "seq")
    return lookup_join(lines, kept, {"l_partkey": "pk", "l_suppkey": "sk", "l_linenumber": "ln"})


@case("duplicate_lookup_keys", f"""
    WITH notes AS ({_NOTES}) SELECT pk, sk, count(*) AS n_rows FROM notes GROUP BY ALL HAVING count(*) > 1""")
def duplicate_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(run_sql(spark, sf_dir, _NOTES, "lineitem"), ["pk", "sk"])


@case("diagonal_union", """
    SELECT doc_id AS id, text, lang, source, n_chars, NULL AS url, NULL AS html FROM documents
    UNION ALL SELECT page_id, NULL, NULL, NULL, NULL, url, html FROM pages""")
def diagonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    return diagonal_union([documents, table(spark, sf_dir, "pages").withColumnRenamed("page_id", "id")])


# Rows of another width than the header -------------------------------------

_RAGGED = """
    SELECT l_orderkey, l_linenumber, l_returnflag AS flag, concat_ws(',', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
        CASE WHEN l_linenumber = 1 THEN '"cut, ' || chr(10) || 'here"' WHEN l_orderkey % 5 = 1 THEN NULL ELSE l_returnflag END,
        CASE WHEN l_orderkey % 11 = 0 THEN 'lost' WHEN l_orderkey % 7 = 0 THEN '' END) AS line,
        CASE WHEN l_orderkey % 11 = 0 AND (l_linenumber = 1 OR l_orderkey % 5 <> 1) THEN 'surplus'
             WHEN l_linenumber <> 1 AND l_orderkey % 5 = 1 THEN CASE WHEN l_orderkey % 7 = 0 OR l_orderkey % 11 = 0 THEN NULL ELSE 'other width' END
             WHEN l_orderkey % 7 = 0 THEN 'other width' END AS kind
    FROM lineitem
"""


#: Rows of lineitem that a part of a feed is made of.
_PART_ROWS = 250_000


def _as_lines(spark: SparkSession, sf_dir: str, sql: str, parts: int, path: str, header: str, compression: str = "gzip") -> str:
    """Lines made of lineitem as the part files of a CSV, each with the header, in more parts the more rows there are.

    The files are compressed: long cells take a hundred times the table as plain text.
    """
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    rows = rows.repartition(max(parts, rows.count() // _PART_ROWS))
    lines = spark.sql(sql.replace("FROM lineitem", "FROM {rows}"), rows=rows)
    place = F.monotonically_increasing_id()  # counts from a multiple of 2^33 in every part
    first = place.bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines.select(F.when(first, F.concat(F.lit(f"{header}\n"), "line")).otherwise(F.col("line")).alias("value")).write.text(path, compression=compression)
    return path


def _ragged(spark: SparkSession, sf_dir: str) -> str:
    return _as_lines(spark, sf_dir, _RAGGED, 3, f"{scratch_folder(spark, 'ragged')}/r.csv", "order,line,flag")


@case("csv_rejects", f"SELECT kind, line AS record FROM ({_RAGGED}) WHERE kind IS NOT NULL")
def csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with content beyond the header, and rows that are shorter or end in an empty surplus cell."""
    return csv_rejects(spark, _ragged(spark, sf_dir)).select("kind", "record")


@case("csv_kept_rows", f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS "order", CAST(l_linenumber AS VARCHAR) AS line,
           CASE WHEN l_linenumber = 1 THEN 'cut, ' || chr(10) || 'here' WHEN l_orderkey % 5 = 1 THEN
               CASE WHEN l_orderkey % 11 = 0 THEN 'lost' END ELSE flag END AS flag, count(*) AS n FROM ({_RAGGED})
    WHERE kind IS DISTINCT FROM 'surplus' GROUP BY ALL""")
def csv_kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With surplus rows left to the reject table, all others are read, those of records over several lines as well."""
    kept = read_csv(spark, _ragged(spark, sf_dir), surplus="reject")
    return kept.groupBy("order", "line", "flag").agg(F.count(F.lit(1)).alias("n"))


# Quotes where none belong: within plain cells, after closing ones; cells over lines and of another width beside them.
_QUOTES = """
    SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS STRING) || ',' || CAST(l_linenumber AS STRING) || ',' ||
        CASE l_orderkey % 6 WHEN 0 THEN CAST(l_linenumber AS STRING) || '" pipe' WHEN 1 THEN 'say "' || l_returnflag || '", x'
            WHEN 2 THEN '"in ' || chr(10) || ' ""two"" lines",y' WHEN 3 THEN '"shut" again,z'
            WHEN 4 THEN '"' || repeat('long ""cell"", ', 300) || '"' ELSE '"' || l_returnflag || '"' END AS line,
        CASE l_orderkey % 6 WHEN 3 THEN 'malformed' WHEN 0 THEN 'other width' WHEN 4 THEN 'other width' WHEN 5 THEN 'other width' END AS kind,
        CASE l_orderkey % 6 WHEN 0 THEN CAST(l_linenumber AS STRING) || '" pipe' WHEN 1 THEN 'say "' || l_returnflag || '"'
            WHEN 2 THEN 'in ' || chr(10) || ' "two" lines' WHEN 4 THEN repeat('long "cell", ', 300) ELSE l_returnflag END AS flag,
        CASE l_orderkey % 6 WHEN 1 THEN ' x' WHEN 2 THEN 'y' END AS mark
    FROM lineitem
"""


def _quotes(spark: SparkSession, sf_dir: str) -> str:
    return _as_lines(spark, sf_dir, _QUOTES, 5, f"{scratch_folder(spark, 'quotes')}/r.csv", "order,line,flag,mark", "lz4")  # a third of the time that gzip takes


@case("csv_stray_quotes", f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS "order", CAST(l_linenumber AS VARCHAR) AS line, flag, mark FROM ({_QUOTES})
    WHERE kind IS DISTINCT FROM 'malformed'""")
def csv_stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every good record of a feed with quotes in all places, short rows and long cells."""
    return read_csv(spark, _quotes(spark, sf_dir), surplus="reject")


@case("csv_stray_quote_rejects", f"SELECT kind, line AS record FROM ({_QUOTES}) WHERE kind IS NOT NULL")
def csv_stray_quote_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_rejects(spark, _quotes(spark, sf_dir)).select("kind", "record")


# Names to codes ------------------------------------------------------------

_NAMES = """
    SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN n_name WHEN 1 THEN '  ' || lower(n_name) || ' '
        WHEN 2 THEN 'World: ' || n_name WHEN 3 THEN r_name WHEN 4 THEN 'Republic of ' || n_name
        WHEN 5 THEN replace(n_name, '_', '-') || '!' ELSE NULL END AS name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
# A second area also reads "nation 8", so that name is ambiguous.
_NAMED_AREAS = f"SELECT * FROM ({AREAS}) UNION ALL SELECT '908' AS m49_code, 'X08' AS iso3c, 'Nation 8' AS area_name FROM nation WHERE n_nationkey = 8"
_ALIASES = """SELECT CAST(n_nationkey AS STRING) AS anchor, 'republic of ' || lower(n_name) || '$' AS pattern,
    lpad(CAST(n_nationkey AS STRING), 3, '0') AS m49_code FROM nation WHERE n_nationkey >= 15"""
_NAME_CODES = f"""
    WITH facts AS ({_NAMES}), areas AS ({_NAMED_AREAS}), aliases AS ({_ALIASES}),
    names AS (SELECT DISTINCT name, lower(trim(name)) AS key,
                     trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS plain FROM facts WHERE trim(name) <> ''),
    regions AS (SELECT name, CASE key WHEN 'africa' THEN '002' WHEN 'asia' THEN '142' WHEN 'europe' THEN '150' END AS code FROM names),
    hits AS (SELECT name, m49_code FROM names JOIN areas ON plain = trim(regexp_replace(lower(area_name), '[^a-z0-9]+', ' ', 'g'))
             UNION ALL SELECT name, m49_code FROM names JOIN aliases ON regexp_matches(key, pattern)),
    codes AS (SELECT name, code FROM regions WHERE code IS NOT NULL
              UNION ALL SELECT name, min(m49_code) FROM hits WHERE name NOT LIKE '%:%' GROUP BY name HAVING count(DISTINCT m49_code) = 1)
"""


def _codes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    facts = run_sql(spark, sf_dir, _NAMES, "customer", "nation", "region")
    known = run_sql(spark, sf_dir, _NAMED_AREAS, "nation")
    aliases = run_sql(spark, sf_dir, _ALIASES, "nation")
    return facts, name_codes(facts, "name", "m49", known, region_table(spark), aliases, skip_aggregates=True)


@case("name_to_code", f"{_NAME_CODES} SELECT c_custkey, facts.name, code AS m49 FROM facts LEFT JOIN codes ON facts.name = codes.name")
def name_to_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, codes = _codes(spark, sf_dir)
    return lookup_join(facts, codes, {"name": "name"})


# Areas of two words each; names hold both in turn with generic ones, only the one that an area has for itself, only a shared one, or a strange one.
_WORD_AREAS = """SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS m49_code, 'A' || CAST(n_nationkey AS STRING) AS iso3c,
    'Own' || CAST(n_nationkey AS STRING) || ' Shared' || CAST(n_nationkey % 5 AS STRING) AS area_name FROM nation"""
_WORD_NAMES = """SELECT c_custkey, CASE c_custkey % 6
        WHEN 0 THEN 'Rep. of Shared' || CAST(c_nationkey % 5 AS STRING) || ', Own' || CAST(c_nationkey AS STRING)
        WHEN 1 THEN 'Kingdom of Own' || CAST(c_nationkey AS STRING) WHEN 2 THEN 'Shared' || CAST(c_nationkey % 5 AS STRING) || ' (Republic)'
        WHEN 3 THEN 'Own' || CAST(c_nationkey AS STRING) || ' and Other' WHEN 4 THEN 'Own' || CAST(c_nationkey AS STRING) || ' Own' || CAST((c_nationkey + 1) % 25 AS STRING)
        ELSE 'shared' || CAST(c_nationkey % 5 AS STRING) || ' OWN' || CAST(c_nationkey AS STRING) END AS name FROM customer"""


@case("name_codes_by_words", f"""
    SELECT c_custkey, name, CASE WHEN c_custkey % 6 IN (0, 1, 5) THEN printf('%03d', c_nationkey) END AS m49
    FROM ({_WORD_NAMES}) JOIN customer USING (c_custkey)""")
def name_codes_by_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that match no reference name word for word."""
    facts = run_sql(spark, sf_dir, _WORD_NAMES, "customer")
    areas, aliases = run_sql(spark, sf_dir, _WORD_AREAS, "nation"), run_sql(spark, sf_dir, _ALIASES, "nation").where("m49_code < '0'")
    codes = name_codes(facts, "name", "m49", areas, region_table(spark), aliases, by_words=True)
    return lookup_join(facts, codes, {"name": "name"})


@case("unmatched_names", f"{_NAME_CODES} SELECT name FROM names WHERE name NOT IN (SELECT name FROM codes) ORDER BY name")
def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_names(_codes(spark, sf_dir)[1], "name", "m49")


# Recipes -------------------------------------------------------------------

@case("recipe_default", f"""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS full_text, lang, source,
           CAST(n_chars AS VARCHAR) AS length, {LINEAGE_SQL} FROM documents""")
def recipe_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts hold line breaks and quotes, so records span lines."""
    folder = scratch_folder(spark, "default")
    _land(table(spark, sf_dir, "documents"), f"{folder}/Docs_E_All_Data_(Normalized).csv",
          "Doc Id", "Full Text", "Lang", "Source", "Length")
    _land(table(spark, sf_dir, "nation"), f"{folder}/Docs_E_AreaCodes.csv")
    return source_table(recipes.recipe_for("faostat_qcl")(spark, folder, None), LINEAGE_VALUES)


_SERIES = "SELECT o_orderkey AS seq, o_orderstatus AS code, o_orderpriority AS topic, o_orderkey AS n FROM orders WHERE o_orderstatus <> 'P'"
_SERIES_EXTRA = ["Unit of measure", "Periodicity", "Base Period", "Other notes", "Aggregation method",
                 "Limitations and exceptions", "Source", "Statistical concept and methodology", "Development relevance"]
_COUNTRY_NOTES = "SELECT o_orderkey AS seq, 'C' || CAST(o_custkey AS STRING) AS country, o_orderstatus AS code, 'note, \"' || CAST(o_orderkey AS STRING) || '\"' AS note FROM orders WHERE o_orderpriority = '1-URGENT'"
_TIME_NOTES = "SELECT o_orderkey AS seq, o_orderstatus AS code, 'YR' || CAST(year(o_orderdate) AS STRING) AS yr, 'time ' || CAST(o_orderkey AS STRING) AS note FROM orders WHERE year(o_orderdate) >= 1997"
_FOOT_NOTES = "SELECT o_orderkey AS seq, 'C' || CAST(o_custkey AS STRING) AS country, o_orderstatus AS code, 'YR' || CAST(year(o_orderdate) AS STRING) AS yr, 'foot ' || CAST(o_orderkey AS STRING) AS note FROM orders WHERE o_orderpriority = '2-HIGH'"
_WIDE_MAIN = "SELECT 'Customer, ' || CAST(o_custkey AS STRING) AS name, 'C' || CAST(o_custkey AS STRING) AS country, 'Orders ' || o_orderstatus AS title, o_orderstatus AS code, CAST(year(o_orderdate) AS BIGINT) AS yr, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"


@case("recipe_wide_lookups", f"""
    WITH cells AS (SELECT name, country, title, code, CAST(yr AS VARCHAR) AS wb_year, CAST(CAST(sum(cents) AS BIGINT) AS VARCHAR) AS value
                   FROM ({_WIDE_MAIN}) GROUP BY name, country, title, code, yr),
    series AS (SELECT code, arg_min(topic, seq) AS topic, min(seq) AS n FROM ({_SERIES}) GROUP BY code),
    cn AS (SELECT country, code, arg_min(note, seq) AS note FROM ({_COUNTRY_NOTES}) GROUP BY ALL),
    tn AS (SELECT code, yr, arg_min(note, seq) AS note FROM ({_TIME_NOTES}) GROUP BY ALL),
    fnote AS (SELECT country, code, yr, arg_min(note, seq) AS note FROM ({_FOOT_NOTES}) GROUP BY ALL)
    SELECT cells.name AS country_name, cells.country AS country_code, title AS indicator_name, cells.code AS indicator_code,
           wb_year, value, 'YR' || wb_year AS wb_year_code, topic, CAST(n AS VARCHAR) AS long_definition,
           {', '.join(f"CASE WHEN series.code IS NOT NULL THEN '{c}' END AS {c.lower().replace(' ', '_')}" for c in _SERIES_EXTRA)},
           cn.note AS note_country_series, tn.note AS note_series_time, fnote.note AS note_footnote, {LINEAGE_SQL}
    FROM cells LEFT JOIN series ON cells.code = series.code
    LEFT JOIN cn ON cells.country = cn.country AND cells.code = cn.code
    LEFT JOIN tn ON cells.code = tn.code AND 'YR' || wb_year = tn.yr
    LEFT JOIN fnote ON cells.country = fnote.country AND cells.code = fnote.code AND 'YR' || wb_year = fnote.yr""")
def recipe_wide_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "wide")
    main = run_sql(spark, sf_dir, _WIDE_MAIN, "orders").groupBy("name", "country", "title", "code").pivot("yr", YEARS)
    _land(main.agg(F.sum("cents")), f"{folder}/WDICSV.csv", *recipes.WIDE_IDS, *map(str, YEARS))
    series = run_sql(spark, sf_dir, _SERIES, "orders").orderBy("seq").select(
        "code", F.lit("dropped").alias("dropped"), "topic", "n", *[F.lit(c) for c in _SERIES_EXTRA])
    _land(series, f"{folder}/WDISeries.csv", "Series Code", "Indicator Name", "Topic", "Long definition", *_SERIES_EXTRA)
    for sql, name, header in (
        (_COUNTRY_NOTES, "WDIcountry-series.csv", ["CountryCode", "SeriesCode", "DESCRIPTION"]),
        (_TIME_NOTES, "WDIseries-time.csv", ["SeriesCode", "Year", "DESCRIPTION"]),
        (_FOOT_NOTES, "WDIfootnote.csv", ["CountryCode", "SeriesCode", "Year", "DESCRIPTION"]),
    ):
        _land(run_sql(spark, sf_dir, sql, "orders").orderBy("seq").drop("seq"), f"{folder}/{name}", *header)
    return source_table(recipes.recipe_for("wb_wdi")(spark, folder, None), LINEAGE_VALUES)


@case("recipe_codes", f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS year, CAST(-l_partkey AS VARCHAR) AS country_code,
           CAST(l_suppkey AS VARCHAR) || '.5' AS catprod, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0' AS support_usd,
           CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_returnflag END AS nra_cat, {LINEAGE_SQL} FROM lineitem""")
def recipe_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "codes")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '.0')", "concat(' ', -l_partkey, '.000 ')", "concat(l_suppkey, '.5')",
        "concat(CAST(l_quantity AS BIGINT), '.0')", "CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_returnflag END")
    _land(lines, f"{folder}/2025/Aggregated_NRA 2025.csv", "Year", "country_code", "CatProd", "Support_USD", "nra_cat")
    _land(table(spark, sf_dir, "nation"), f"{folder}/2025/Other.csv")
    return source_table(recipes.recipe_for("agincentives")(spark, folder, None), LINEAGE_VALUES)


@case("recipe_attributes", f"""
    WITH species AS ({_PART_VERSIONS}),
    kept AS (SELECT * FROM species QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY version) = 1)
    SELECT CAST(l_partkey AS VARCHAR) AS species, CAST(l_suppkey AS VARCHAR) AS water_area, CAST(l_orderkey AS VARCHAR) AS ref_area,
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS obs_value, label AS species_name, brand AS tax_family,
           CAST(s_nationkey AS VARCHAR) AS fishing_area, {LINEAGE_SQL}
    FROM lineitem LEFT JOIN kept ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 2000""")
def recipe_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "attributes")
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_partkey", "l_suppkey", "l_orderkey", "CAST(l_quantity AS BIGINT)")
    _land(lines, f"{folder}/{recipes.PRODUCTION_MAIN}", "SPECIES", "WATER_AREA", "ref_area", "obs_value")
    species = run_sql(spark, sf_dir, _PART_VERSIONS, "part").orderBy("version").drop("version")
    _land(species, f"{folder}/{recipes.PRODUCTION_SPECIES}", "SPECIES", "Species", "Tax family")
    water = table(spark, sf_dir, "supplier").where("s_acctbal > 2000").selectExpr("s_suppkey", "s_name", "s_nationkey", "s_name")
    _land(water, f"{folder}/{recipes.PRODUCTION_WATER}", "WATER_AREA", "Fishing Area", "FISHING_AREA", "ref_area")
    return source_table(recipes.recipe_for("fao_fishstat_globalproduction")(spark, folder, None), LINEAGE_VALUES)


@case("recipe_processed", f"""
    SELECT CAST(l_partkey AS VARCHAR) AS product, CAST(l_orderkey AS VARCHAR) AS obs_value, p_name AS aquatic_product, {LINEAGE_SQL}
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size < 30""")
def recipe_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "processed")
    _land(table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey"), f"{folder}/{recipes.PROCESSED_MAIN}", "PRODUCT", "OBS_VALUE")
    parts = table(spark, sf_dir, "part").where("p_size < 30").selectExpr("p_partkey", "p_name", "p_brand")
    _land(parts, f"{folder}/{recipes.PROCESSED_PRODUCT}", "PRODUCT", "Aquatic product", "OBS_VALUE")
    return source_table(recipes.recipe_for("fao_fishstat_processed")(spark, folder, None), LINEAGE_VALUES)


_AREA_NAMES = f"""
    WITH named AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN 'World: ' || n_name
        WHEN 2 THEN r_name ELSE NULL END AS name, c_acctbal
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
_AREA_CODE = f"""CASE name WHEN 'AFRICA' THEN '002' WHEN 'ASIA' THEN '142' WHEN 'EUROPE' THEN '150'
    ELSE (SELECT m49_code FROM ({AREAS}) WHERE area_name = name) END"""


@case("recipe_wide_names", f"""
    {_AREA_NAMES}, cells AS (SELECT name, c_custkey, '1990' AS year, CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS value FROM named
        UNION ALL SELECT name, c_custkey, '1991', CAST(c_custkey AS VARCHAR) FROM named WHERE c_acctbal >= 0)
    SELECT name AS country_region, CAST(c_custkey AS VARCHAR) AS indicator, year, value, {_AREA_CODE} AS ref_m49_code, {LINEAGE_SQL} FROM cells""")
def recipe_wide_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "names")
    named = run_sql(spark, sf_dir, f"{_AREA_NAMES} SELECT * FROM named", "customer", "nation", "region")
    wide = named.selectExpr("name", "c_custkey", "CAST(round(c_acctbal * 100) AS BIGINT)",
                            "CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS STRING) ELSE '  ' END", "CAST(NULL AS STRING)")
    _land(wide, f"{folder}/national-data-export.csv", "Country/Region", "Indicator", "1990", " 1991 ", "1992")
    names = recipes.AreaNames.standard(areas(spark, sf_dir))
    return source_table(recipes.recipe_for("scp_hat_national")(spark, folder, names), LINEAGE_VALUES)


@case("recipe_many_files", f"""
    {_AREA_NAMES}, rows AS (SELECT name, 'a' AS sex, CAST(c_custkey AS VARCHAR) AS v, NULL AS note FROM named WHERE c_acctbal >= 0
        UNION ALL SELECT name, NULL, CAST(c_custkey AS VARCHAR), 'b' FROM named WHERE c_acctbal < 0
        UNION ALL SELECT n_name, 'h', CAST(n_nationkey AS VARCHAR), NULL FROM nation)
    SELECT name AS ref_area_label, sex AS sex_label, v AS obs_value, note AS note_source_label,
           {_AREA_CODE} AS ref_area_m49code, {LINEAGE_SQL} FROM rows""")
def recipe_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "many")
    named = run_sql(spark, sf_dir, f"{_AREA_NAMES} SELECT * FROM named", "customer", "nation", "region")
    rich, poor = named.where("c_acctbal >= 0"), named.where("c_acctbal < 0")
    _land(rich.selectExpr("name", "'a'", "c_custkey"), f"{folder}/a/one.csv", "﻿ref_area.label", "sex.label", "obs_value ")
    _land(poor.selectExpr("c_custkey", "'b'", "name"), f"{folder}/two.csv", "obs_value", "note_source.label", "ref_area.label")
    _land(table(spark, sf_dir, "nation"), f"{folder}/__MACOSX/three.csv", "ref_area.label", "n", "r")
    hidden = table(spark, sf_dir, "nation").selectExpr("n_name", "'h'", "n_nationkey")
    _land(hidden, f"{folder}/_hidden.csv", "ref_area.label", "sex.label", "obs_value")
    _land(table(spark, sf_dir, "nation"), f"{folder}/notes.csv")
    names = recipes.AreaNames.standard(areas(spark, sf_dir))
    return source_table(recipes.recipe_for("ilostat_emp_dwap_rt")(spark, folder, names), LINEAGE_VALUES)


# A file for every nation, each with the columns that the bits of its number choose, in an order of its own.
_BITS = 5


@case("csv_many_headers", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id,
        {', '.join(f"CASE WHEN (c_nationkey >> {j}) & 1 = 1 THEN c_mktsegment || ' {j}, of ' || c_custkey END AS x{j}" for j in range(_BITS))}
    FROM customer""")
def csv_many_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of 25 different headers in one scan."""
    folder = scratch_folder(spark, "headers")
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_mktsegment").cache()
    for k in range(25):
        bits = [j for j in range(_BITS) if k >> j & 1]
        cells = [F.concat("c_mktsegment", F.lit(f" {j}, of "), "c_custkey") for j in bits]
        names = [f"x{j}" for j in bits]
        cut = k % (len(bits) + 1)
        rows = customers.where(F.col("c_nationkey") == k).select(*cells[:cut], "c_custkey", *cells[cut:])
        _land(rows, f"{folder}/n{k}.csv", *names[:cut], "id", *names[cut:])
    read = read_csvs(spark, csv_headers(spark, all_csvs(spark, folder)))
    customers.unpersist()
    return read.select("id", *[f"x{j}" for j in range(_BITS)])


# Ingestion -----------------------------------------------------------------

def _ingested(spark: SparkSession, sf_dir: str) -> tuple[Lake, list[str], DataFrame]:
    """Two sources landed, then asked for again together with an unknown one."""
    root = scratch_folder(spark, "ingest")
    lake = Lake(spark, f"ingest_{uuid.uuid4().hex}", root)
    codes = [f"{name}_{uuid.uuid4().hex}" for name in ("orders", "part")]
    _land(table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderpriority"), f"{root}/in/orders/o.csv", "Order Key", "Priority")
    _land(table(spark, sf_dir, "part").select("p_partkey", "p_name"), f"{root}/in/part/p.csv")
    rows = [(codes[0], "agency", UPDATED_AT, None), (codes[1], None, "2023-02-03", None), ("", None, None, None)]
    lake.write(ingest.SOURCE_CONFIG, spark.createDataFrame(
        rows, "afs_source_code string, agency string, afs_source_updated_at string, afs_source_ingested_at string"))
    folders = {codes[0]: f"{root}/in/orders", codes[1]: f"{root}/in/part"}
    first = ingest.ingest(lake, folders, None)
    again = ingest.ingest(lake, folders, None, codes=[codes[0], "nowhere", codes[0]])
    return lake, codes, first.unionByName(again)


@case("source_ingest", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS label, 'orders' AS source, '{UPDATED_AT}' AS afs_source_updated_at, TRUE AS dated FROM orders
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, 'part', '2023-02-03', TRUE FROM part""")
def source_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, codes, _ = _ingested(spark, sf_dir)
    frames = [lake.read(ingest.source_view_name(code)) for code in codes]
    named = [df.toDF("key", "label", *df.columns[2:]) for df in frames]
    return named[0].unionByName(named[1]).select(
        "key", "label", F.substring_index("afs_source_code", "_", 1).alias("source"),
        "afs_source_updated_at", F.col("afs_source_ingested_at").try_cast("timestamp").isNotNull().alias("dated"))


@case("source_ingest_log", """
    SELECT * FROM (VALUES ('orders', 'SUCCESS', TRUE, TRUE), ('part', 'SUCCESS', TRUE, TRUE), ('orders', 'SKIPPED', TRUE, TRUE),
        ('nowhere', 'FAILED', FALSE, FALSE)) AS t(source, status, stored, configured)""")
def source_ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _, _ = _ingested(spark, sf_dir)
    written = lake.read(ingest.SOURCE_CONFIG).select("afs_source_code", F.col("afs_source_ingested_at").alias("at"))
    log = lake.read(ingest.SOURCE_LOG).join(written, "afs_source_code", "left")
    return log.select(
        F.substring_index("afs_source_code", "_", 1).alias("source"), "status",
        (F.coalesce("uri", F.lit("")) != "").alias("stored"), F.col("at").isNotNull().alias("configured"))
