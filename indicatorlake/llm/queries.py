"""The queries of this subpackage over the driver's tables, and the SQL that some must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, leaks, licenses, neighbours, phrases, pii, quality, quotes, repeats, shards, simhash, sql, subwords, tokens
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Vocabulary files; the package that holds them is installed on every machine.
COUNTED = "word_bpe_49k.json"
ENCODED = "piece_bpe_32k.model"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
SHARDS = 8


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])
    spans = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"]))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(spans, ",").alias("spans"),
                        F.array_max(F.transform("licenses", lambda x: x["coverage"])).alias("coverage"))


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), ["doc_id"], tokenizer_path(COUNTED))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    items = F.transform("leaks", lambda x: F.concat_ws(":", x["item"], x["distance"], x["end"]))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_items"),
                        F.array_join(items, ",").alias("items"))


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = subwords.encode(table(spark, sf_dir, "documents"), ["doc_id"], tokenizer_path(ENCODED))
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids", "restored")


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"), ["doc_id"])


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"), ["doc_id"])
    counts = [pii.number(F.col("found"), kind).alias(f"n_{kind}") for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("found"), *pii.BASE), 256).alias("base_sha256"),
                        pii.listed(F.col("found")).alias("spans"))


@query
def op10_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), ["doc_id"], *map(tokenizer_path, ALIGNED))


ORACLES |= {"op2_substring_dedup": sql.SUBSTRING_DEDUP, "op8_quality_rules": sql.QUALITY_RULES, "op9_pii": sql.PERSONAL_DATA,
            "op11_phrase_collocations": sql.PHRASE_COLLOCATIONS}
