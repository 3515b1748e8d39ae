"""What several operators share: word arrays over Arrow texts, shipping, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake.session import ship, written  # noqa: F401  (ship is for the operators)

#: Bytes of text that one round of array work handles; a longer single text is a round of its own.
CHUNK_BYTES = 1 << 18
#: Bytes from which on a span is hashed as a whole.
LONG = 256
#: Base of the rolling hashes, odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(docs: DataFrame, keys: list[str], text: str) -> tuple[DataFrame, str]:
    """The named columns and the text, each once, and the keys as the beginning of a schema."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return (docs.select(*[docs[c] for c in dict.fromkeys([*keys, text])]),
            "".join(f"`{k}` {kinds[k]}, " for k in keys))


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``size`` bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(low, high - low)
        low = high
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds no old batches


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of each; a null text is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span; equal contents give equal hashes.

    A sum of powers modulo 2**64 can be made to collide by spans of 1,024 values and
    more; spans of LONG bytes and more are hashed as a whole by XXH3 instead.
    """
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    out = mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if values.dtype == np.uint8:
        data = np.ascontiguousarray(values)
        for k in np.flatnonzero(ends - starts >= LONG).tolist():
            out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return out


def folding(separators: bytes = b" \t\n\r\x0b\x0c") -> np.ndarray:
    """A table from byte to whether it separates words."""
    blank = np.zeros(256, bool)
    blank[list(separators)] = True
    return blank


WHITE = folding()


@dataclass
class Words:
    """The words of a run of texts: byte spans, and for every text its range of words."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        return spans_hash(self.data, self.starts, self.ends)

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value for each word over the words of each text."""
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return np.diff(sums[self.bounds])

    def same_text(self, n: int) -> np.ndarray:
        """For every start of n consecutive words: whether all lie in one text."""
        rows = self.rows
        return rows[: max(0, len(rows) - n + 1)] == rows[n - 1 :]


def words_of(texts: pa.Array, blank: np.ndarray = WHITE) -> Words:
    data, offsets = text_bytes(texts)
    inside = ~blank[data]
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # a word never goes on in the next text
    begin[edges] = inside[edges]
    stop[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive word hashes."""
    count = max(0, len(hashes) - n + 1)
    at = np.arange(count)
    return spans_hash(hashes, at, at + n)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """For every node of the edges the smallest node it is connected with: (node, root).

    Alternating large-star and small-star steps; each is an aggregation with
    map-side reduction and an equi-join of stored tables, so that the edges of a
    node with very many of them can be split over tasks, and a lost executor costs
    one step.  Nothing about the graph reaches the driver but a count and a checksum.
    An empty edge table gives an empty result.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = written(links, "links")
    state = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), "large")
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = large.join(lower, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        links = written(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
