"""Contiguous shards of nearly equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicatorlake.session import written

#: Copies of one text stay in one shard unless together they exceed this share of a shard.
GROUP_SHARE = 0.01


def prefix_sums(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Add ``row`` (rows before) and ``before`` (their summed size) in the order of the given columns.

    The rows are range-partitioned and written with the number of their partition;
    a table of per-partition totals, one row each, gives every partition its offset.
    Only sums inside a partition are sequential.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    stored = written(ranged, "ranges")
    totals = stored.groupBy("part").agg(F.sum(size).alias("bytes"), F.count("*").alias("count"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes"),
                            F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("count"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = stored.withColumn("row", F.count("*").over(inside)).withColumn("before", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return summed.join(offsets, "part").select(
        *rows.columns, (F.col("row") + F.col("count")).alias("row"), (F.col("before") + F.col("bytes")).alias("before"))


def shard_by_bytes(docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for every row: id, size, text_crc32, shard and slot.

    Size is the UTF-8 bytes of the text and one (null or empty: one).  Rows are
    ordered by the smallest id that has their text, so that copies are neighbours;
    a row belongs to the shard its middle byte falls into when the total is cut in
    equal parts, and copies go with the middle of their group while the group is
    small against a shard.  Equal ids are ordered by their text's hash; rows that
    are equal in all are exchangeable.  Null ids come first.  An empty table gives
    no rows; with fewer rows than shards some shards stay empty.
    """
    plain = docs.select(docs[id_column].alias("id"), F.coalesce(F.octet_length(docs[text]).cast("long"), F.lit(0).cast("long")).alias("bytes"),
                        F.crc32(F.coalesce(docs[text], F.lit(""))).alias("crc"), F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("hash"))
    sizes = written(plain.withColumn("size", F.col("bytes") + 1), "sizes")
    copies = sizes.groupBy("hash", "crc", "size").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copies = written(copies, "copies")
    rows = sizes.join(copies, ["hash", "crc", "size"], "left").select(
        "id", "size", "crc", "hash", F.coalesce("first", "id").alias("first"), F.coalesce("copies", F.lit(1)).alias("copies"))
    placed = written(prefix_sums(rows, ["first", "hash", "id"], "size"), "placed")
    total = placed.agg(F.sum("size")).first()[0] or 1
    small = F.col("size") * F.col("copies") <= total * GROUP_SHARE / shards
    heads = written(placed.where("copies > 1").groupBy("hash", "crc", "size").agg(F.min("before").alias("head")), "heads")
    middle = F.when(F.col("head").isNotNull() & small, F.col("head") + F.col("size") * F.col("copies") / 2).otherwise(
        F.col("before") + F.col("size") / 2)
    dealt = placed.join(heads, ["hash", "crc", "size"], "left").withColumn(
        "shard", F.least(F.lit(shards - 1), F.floor(middle * shards / total)).cast("int"))
    dealt = written(dealt.select("id", "size", "crc", "row", "shard"), "dealt")
    first = dealt.groupBy("shard").agg(F.min("row").alias("from"))
    return dealt.join(F.broadcast(first), "shard").select(  # one row a shard
        F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("from")).alias("slot"))
