"""From raw documents to piece ids: quality, near-dedup, decontamination, personal data, encoding.

Every stage is a function of (spark, docs, sf_dir) over rows with the columns of
documents, in any order and with others beside them; its result is written as
Parquet in the shared folder and read again as the next stage's docs.  Rows with
nulls, empty texts and repeated rows pass through every stage; each docstring says
how.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake.llm import leaks, nearcopies, pii, quality, subwords
from indicatorlake.llm.queries import ENCODED, tokenizer_path
from indicatorlake.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rule_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go; null and empty texts are too short and go as well."""
    return quality.measure(docs, COLUMNS).where("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays, once.

    SimHash fingerprints over shingles of five words name the first candidates; near
    copies share at least 0.8 of these shingles, by exact count, and those that two
    bits of a fingerprint do not reach are found by MinHash keys.
    A null id counts as larger than others; of rows that share the id the one whose
    text has the smallest hash stays, and of rows that share both any one.  Null and
    empty texts are near copies of each other.
    """
    plain = docs.select(*COLUMNS).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    named = nearcopies.groups(plain, ["doc_id", "mark"])
    kept = written(named.groupBy("root", "doc_id", "mark").agg(F.count("*").alias("rows")).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("at"), "mark", "rows")).alias("k"))
        .select("k.*"), "kept")
    marked = plain.withColumns({"none": F.col("doc_id").isNull(), "at": F.coalesce("doc_id", F.lit(0).cast("long"))})
    once = marked.join(kept.where("rows = 1"), ["none", "at", "mark"], "left_semi").select(*COLUMNS)
    several = kept.where("rows > 1")
    if several.isEmpty():
        return once
    return once.unionAll(marked.join(several, ["none", "at", "mark"], "left_semi").dropDuplicates(["none", "at", "mark"]).select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go; null texts hold none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks.find_leaks(docs, benchmark, COLUMNS).where(F.size("leaks") == 0).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to its kind in brackets, and n_chars follows; a null text stays null."""
    found = pii.detect(docs, COLUMNS)
    masked = pii.redact(F.col("text"), F.col("found"))
    return found.select("doc_id", masked.alias("text"), "lang", "source", "n_chars", "found").select(
        "doc_id", "text", "lang", "source",
        F.when(F.size("found") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its id, source, piece ids and their number; null texts have null ids and none."""
    coded = subwords.encode(docs, ["doc_id", "lang", "source"], tokenizer_path(ENCODED))
    return coded.select("doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids", "restored")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", rule_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("PII", mask_personal_data),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: Fingerprints, edit distances and piece ids are beyond SQL; a brute-force version tests the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
