"""Areas: joining the reference, and turning area names into M49 codes."""

from __future__ import annotations

import csv
import os
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_blank, strip
from ..session import written
from .area_tokens import codes_by_words
from .reshape import quoted

# M49 region names and their codes.
REGION_CODES = {
    "World": "001",
    "Africa": "002",
    "Northern Africa": "015",
    "Sub-Saharan Africa": "202",
    "Eastern Africa": "014",
    "Middle Africa": "017",
    "Southern Africa": "018",
    "Western Africa": "011",
    "Americas": "019",
    "Latin America and the Caribbean": "419",
    "Caribbean": "029",
    "Central America": "013",
    "South America": "005",
    "Northern America": "021",
    "Asia": "142",
    "Central Asia": "143",
    "Eastern Asia": "030",
    "South-eastern Asia": "035",
    "Southern Asia": "034",
    "Western Asia": "145",
    "Europe": "150",
    "Eastern Europe": "151",
    "Northern Europe": "154",
    "Southern Europe": "039",
    "Western Europe": "155",
    "Oceania": "009",
    "Australia and New Zealand": "053",
    "Melanesia": "054",
    "Polynesia": "061",
}

# Country names told apart by a word they hold and a pattern, with their M49 codes;
# plain spellings are in area_spellings.csv.
COUNTRY_ALIASES = [
    ("bolivia", r"bolivia", "068"),
    ("brunei", r"brunei", "096"),
    ("cape", r"cape verde", "132"),
    ("congo", r"\bdem.*congo|congo.*\bdem|\bdr congo", "180"),
    ("congo", r"^(?!.*dem)(?!.*\bdr\b).*congo", "178"),
    ("ivoire", r"c.te d.ivoire", "384"),
    ("ivory", r"ivory coast", "384"),
    ("czech", r"czech", "203"),
    ("egypt", r"egypt", "818"),
    ("gambia", r"gambia", "270"),
    ("iran", r"\biran\b", "364"),
    ("korea", r"democratic people|north korea|korea,? dem", "408"),
    ("korea", r"^(?!.*(democratic|north|dem\b)).*korea", "410"),
    ("kyrgyz", r"kyrgyz", "417"),
    ("laos", r"\blaos?\b", "418"),
    ("lao", r"\blaos?\b", "418"),
    ("macedonia", r"macedonia", "807"),
    ("micronesia", r"micronesia", "583"),
    ("moldova", r"moldova", "498"),
    ("russia", r"russia", "643"),
    ("russian", r"russia", "643"),
    ("slovak", r"slovak", "703"),
    ("swaziland", r"swaziland", "748"),
    ("syria", r"syria", "760"),
    ("syrian", r"syria", "760"),
    ("tanzania", r"tanzania", "834"),
    ("turkey", r"turkey", "792"),
    ("turkiye", r"turkiye", "792"),
    ("uk", r"\buk\b", "826"),
    ("britain", r"great britain", "826"),
    ("kingdom", r"united kingdom", "826"),
    ("usa", r"\busa\b", "840"),
    ("states", r"^(?!.*(virgin|minor)).*united states", "840"),
    ("venezuela", r"venezuela", "862"),
    ("vietnam", r"vietnam", "704"),
    ("viet", r"viet nam", "704"),
    ("yemen", r"yemen", "887"),
]
# What may stand behind a comma or in parentheses without making another country of it.
ADDITIONS = r"the|rep|republic( of)?( the)?|arab rep|islamic rep|islamic republic of|plurinational state of|bolivarian republic of|fed sts|federated states of|" \
    r"united republic of|rb|china|china sar|sar china|special administrative region of china|kingdom of( the)?|state of|federation"
SPELLINGS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "area_spellings.csv")
# Latin letters with marks and the letters they stand for, in lower case.
_MARKED = "".join(chr(c) for c in range(0xDF, 0x250) if chr(c).islower() and unicodedata.normalize("NFKD", chr(c))[0].isascii() and not chr(c).isascii())
_BARE = "".join(unicodedata.normalize("NFKD", c)[0] for c in _MARKED)
_OTHER = {"ø": "o", "ł": "l", "đ": "d", "ı": "i", "ħ": "h", "ŧ": "t"}


def join_areas(rows: DataFrame, areas: DataFrame, key: Column, on: str) -> DataFrame:
    """Left join the area reference on ``on`` (m49_code or iso3c), adding _m49_code and _iso3c."""
    reference = areas.select(
        F.col("m49_code").cast("string").alias("_m49_code"), F.col("iso3c").cast("string").alias("_iso3c")
    )
    return rows.join(reference, key == F.col(f"_{on}"), "left")


def region_table(spark: SparkSession) -> DataFrame:
    """The fixed region dictionary as (area_name, m49_code)."""
    return spark.createDataFrame(
        pa.table({"area_name": list(REGION_CODES), "m49_code": list(REGION_CODES.values())})
    )


def alias_table(spark: SparkSession) -> DataFrame:
    """The fixed country aliases as (anchor, pattern, m49_code)."""
    anchors, patterns, codes = zip(*COUNTRY_ALIASES)
    return spark.createDataFrame(
        pa.table({"anchor": list(anchors), "pattern": list(patterns), "m49_code": list(codes)})
    )


def spelling_table(spark: SparkSession) -> DataFrame:
    """Spellings that are no reference name word for word, one per line of the data file, as (name, m49_code)."""
    with open(SPELLINGS, encoding="utf-8", newline="") as file:
        rows = list(csv.DictReader(file))
    return spark.createDataFrame(pa.table({"name": [r["name"] for r in rows], "m49_code": [r["m49_code"] for r in rows]}))


def bare_letters(text: Column) -> Column:
    """Lower case without accents and other marks."""
    lowered = F.regexp_replace(F.lower(text), r"\p{M}", "")
    return F.translate(lowered, _MARKED + "".join(_OTHER), _BARE + "".join(_OTHER.values()))


def plain_name(name: Column) -> Column:
    """Lower-case words of a name without marks, one space apart; a leading "st" is "saint", "&" is "and", "U.S." is "us"."""
    joined = F.regexp_replace(bare_letters(name), r"(?U)(?<=\b\p{L})\.(?=\p{L}\b)", "")  # "u.s.a." is "usa."
    words = F.trim(F.regexp_replace(F.replace(joined, F.lit("&"), F.lit(" and ")), r"(?U)[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(words, r"^st ", "saint ")


def short_name(name: Column) -> Column:
    """A name without what is added behind a comma or in parentheses ("Bahamas, The"), as ``plain_name``; NULL where nothing is."""
    bare = bare_letters(name)
    pattern = rf"^([^,(]+?)\s*(?:,|\()\s*(?:{ADDITIONS})\.?\s*\)?\.?$"
    return plain_name(F.nullif(F.regexp_extract(bare, pattern, 1), F.lit("")))


def name_codes(
    df: DataFrame,
    name: str,
    code: str,
    areas: DataFrame,
    regions: DataFrame,
    aliases: DataFrame,
    skip_aggregates: bool = False,
    by_words: bool = False,
) -> DataFrame:
    """(name, code) for every distinct non-blank name of ``df``; NULL code when none or several fit.

    Region names match first and exactly (so "Southern Africa" is no country).
    The rest match a reference name or a listed spelling word for word, accents
    aside, or else an alias pattern; aliases are found by equi-join on a word of the
    name, so no name meets every pattern.  Only names that match nothing so are
    tried without an addition such as ", The" or "(Republic of)", on both sides, and
    with ``by_words`` what is left then by the weight of the words they share with an
    area (``area_tokens``).
    With ``skip_aggregates`` a name holding a colon never matches.

    The names and the finished mapping are written out: the facts are read once
    for their names, and the join of the mapping back to the facts is planned
    from its real size, without shuffling the facts when it is small.
    """
    names = df.select(F.col(quoted(name)).alias("_name")).where(~is_blank(F.col("_name"))).distinct()
    names = written(names, "names").withColumn("_key", F.lower(strip(F.col("_name"))))
    if skip_aggregates:
        names = names.withColumn("_key", F.when(~F.contains(F.col("_name"), F.lit(":")), F.col("_key")))
    region = regions.select(F.lower(strip(F.col("area_name"))).alias("_key"), F.col("m49_code").alias("_region"))
    named = names.join(region, "_key", "left").select("_name", "_key", "_region")
    open_names = named.where("_region IS NULL AND _key IS NOT NULL").select("_name", "_key")

    spellings = spelling_table(df.sparkSession)
    reference = areas.select(plain_name(F.col("area_name")).alias("_plain"), F.col("m49_code").alias("_code"))
    listed = spellings.select(plain_name(F.col("name")).alias("_plain"), F.col("m49_code").alias("_code"))
    known = reference.unionByName(listed.join(reference, "_plain", "left_anti")).distinct()
    exact = (
        open_names.withColumn("_plain", plain_name(F.col("_key")))
        .join(known, "_plain")
        .select("_name", "_code", F.lit(1).alias("_rank"))
    )
    shorter = areas.select(short_name(F.col("area_name")).alias("_plain"), F.col("m49_code").alias("_code")).where("_plain IS NOT NULL")
    short = known.unionByName(shorter.join(known, "_plain", "left_anti")).distinct()
    shortened = (
        open_names.withColumn("_plain", F.explode(F.array(plain_name(F.col("_key")), short_name(F.col("_key")))))
        .join(short, "_plain")
        .select("_name", "_code", F.lit(3).alias("_rank"))
    )
    words = open_names.select(
        "_name", "_key", F.explode(F.array_distinct(F.split(plain_name(F.col("_key")), " "))).alias("anchor")
    )
    by_alias = (
        words.join(aliases, "anchor")
        .where(F.rlike(bare_letters(F.col("_key")), F.col("pattern")) | F.rlike(F.col("_key"), F.col("pattern")))
        .select("_name", F.col("m49_code").alias("_code"), F.lit(2).alias("_rank"))
    )
    found = exact.unionByName(by_alias).unionByName(shortened)
    if by_words:
        found = written(found, "named")
        rest = open_names.join(found, "_name", "left_anti").select("_name", plain_name(F.col("_key")).alias("_plain"))
        found = found.unionByName(codes_by_words(rest, short).withColumn("_rank", F.lit(4)))
    single = (
        found
        .groupBy("_name", "_rank").agg(F.min("_code").alias("_low"), F.max("_code").alias("_high"))
        .groupBy("_name").agg(F.min_by(F.struct("_low", "_high"), "_rank").alias("_c"))
        .where("_c._low = _c._high")
        .select("_name", F.col("_c._low").alias("_country"))
    )
    codes = named.join(single, "_name", "left").select("_name", F.coalesce("_region", "_country").alias("_code"))
    return written(codes, "codes").toDF(name, code)


def unmatched_names(codes: DataFrame, name: str, code: str) -> DataFrame:
    """Names that got no code, sorted."""
    return codes.where(F.col(quoted(code)).isNull()).select(quoted(name)).orderBy(quoted(name))
