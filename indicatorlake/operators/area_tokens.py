"""Area names by their words: an inverted index in which rare words weigh most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short forms in names and what they stand for, and words that tell no area from another.
SHORT_FORMS = {
    "rep": "republic", "dem": "democratic", "fed": "federated", "sts": "states", "is": "islands", "isl": "islands",
    "sar": "special administrative region", "st": "saint", "terr": "territory", "ter": "territory", "brit": "british", "fr": "french",
}
GENERIC = (
    "of", "the", "and", "republic", "democratic", "federal", "federated", "federation", "state", "states", "kingdom", "islamic", "arab", "people",
    "peoples", "s", "plurinational", "bolivarian", "mainland", "special", "administrative", "region", "territory", "commonwealth", "principality", "sultanate",
)
#: A name that shares only words with no other area still has to name this part of the area's own weight.
LEAST_SHARE = 0.5


def _replacing(short: str, parts: Column):
    return lambda w: F.when(w == short, parts).otherwise(F.array(w))


def words_of(plain: Column) -> Column:
    """The distinct words of a plain name, short forms written out."""
    written_out = F.split(plain, " ")
    for short, long in SHORT_FORMS.items():
        parts = F.array(*map(F.lit, long.split(" ")))
        written_out = F.flatten(F.transform(written_out, _replacing(short, parts)))
    return F.array_distinct(F.filter(written_out, lambda w: w != ""))


def _weighed(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(*GENERIC))


def codes_by_words(names: DataFrame, known: DataFrame) -> DataFrame:
    """(_name, _code) for names (_name, _plain) whose words tell one of the known areas (_plain, _code).

    A word weighs the more, the fewer areas use it; a name of an area is an entry of
    its own, all its names together are its vocabulary.  An area is a candidate if its
    vocabulary covers all weighed words of the name, so one word of another area or
    of none rules it out.  Of candidates that have an entry within the name, the one
    whose entry shares most weight with it is taken if it is alone; else the only
    candidate, if the name holds half the weight of one of its entries and a word that
    no other area uses.

    Names meet areas by an equi-join on words, and a generic word is never joined, so
    no name meets all areas.
    """
    entries = known.select("_code", words_of(F.col("_plain")).alias("_words")).distinct()
    entries = entries.select("_code", _weighed(F.col("_words")).alias("_entry")).where(F.size("_entry") > 0)
    by_word = entries.select("_code", F.explode("_entry").alias("_word")).distinct()
    areas = known.agg(F.count_distinct("_code").alias("_areas"))
    weights = by_word.groupBy("_word").agg(F.count("*").alias("_df")).crossJoin(areas).select(
        "_word", (F.col("_df") == 1).alias("_own"), F.log1p(F.col("_areas") / F.col("_df")).alias("_weight"))

    asked = names.select("_name", _weighed(words_of(F.col("_plain"))).alias("_asked")).where(F.size("_asked") > 0)
    words = asked.select("_name", "_asked", F.explode("_asked").alias("_word"))
    covering = words.join(by_word, "_word").groupBy("_name", "_code").agg(F.count("*").alias("_n"), F.first("_asked").alias("_asked")).where(
        F.col("_n") == F.size("_asked"))
    pairs = covering.join(entries, "_code").select("_name", "_code", "_asked", "_entry")
    weighed = pairs.withColumn("_word", F.explode(F.array_union("_asked", "_entry"))).join(weights, "_word")
    in_name, in_entry = (F.array_contains(c, F.col("_word")) for c in ("_asked", "_entry"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_weight")).otherwise(0.0))

    scored = weighed.groupBy("_name", "_code", "_asked", "_entry").agg(
        (total(in_name & in_entry) / F.sum("_weight")).alias("_score"), (total(in_name & in_entry) / total(in_entry)).alias("_share"),
        F.bool_and(in_name | ~in_entry).alias("_within"), F.bool_or(F.col("_own") & in_name & in_entry).alias("_own"))
    best = scored.groupBy("_name", "_code").agg(
        F.max(F.when(F.col("_within"), F.round("_score", 9))).alias("_score"), F.max(F.when(F.col("_own"), F.col("_share"))).alias("_share"))
    told = best.groupBy("_name").agg(
        F.count("*").alias("_codes"), F.max("_score").alias("_top"), F.collect_list(F.struct("_code", "_score", "_share")).alias("_all"))
    at_top = F.filter("_all", lambda c: c["_score"] == F.col("_top"))
    only = F.when((F.col("_codes") == 1) & (F.col("_all")[0]["_share"] >= LEAST_SHARE), F.col("_all")[0]["_code"])
    code = F.when(F.col("_top").isNotNull(), F.when(F.size(at_top) == 1, F.get(at_top, F.lit(0))["_code"])).otherwise(only)
    return told.select("_name", code.alias("_code")).where("_code IS NOT NULL")
