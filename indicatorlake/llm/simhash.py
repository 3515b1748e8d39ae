"""SimHash near-duplicates: fingerprints, Golay-code keys, links and groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatorlake.session import written

from .common import chunks, components, picked, ship

SHINGLE = 3
SEED = 42
#: Most differing bits of linked fingerprints; the keys below are complete up to this.
MOST_BITS = 2
#: The 64 bits are cut in three, each at most 23 bits, the length of the code.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, generator of the perfect binary Golay code.
GENERATOR = 0xC75
#: Buckets with more keys than this are linked through shared neighbour points instead of pairs.
PAIR_BUCKET = 64


def _remainders() -> np.ndarray:
    """x^i modulo the generator, for the 23 positions."""
    out, value = [], 1
    for _ in range(23):
        out.append(value)
        value <<= 1
        if value >> 11:
            value ^= GENERATOR
    return np.array(out, np.int64)


def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """For every remainder its error pattern of weight 3 or less, and its patterns of weight 4 (five or none)."""
    unit = _remainders()
    near, next_ = np.zeros(2048, np.int64), [[] for _ in range(2048)]
    for weight in range(1, 5):
        for places in combinations(range(23), weight):
            rest = int(np.bitwise_xor.reduce(unit[list(places)]))
            bits = sum(1 << p for p in places)
            if weight < 4:
                near[rest] = bits
            else:
                next_[rest].append(bits)
    far = np.full((2048, 5), -1, np.int64)
    for rest, found in enumerate(next_):
        if bin(near[rest]).count("1") == 3:
            far[rest, : len(found)] = found
    return near, far


_tables: dict[str, np.ndarray] = {}


def _remainder(values: np.ndarray) -> np.ndarray:
    if not _tables:
        _tables["near"], _tables["far"] = _patterns()
        unit = _remainders()
        for k in range(3):
            byte = np.arange(256)
            _tables[f"byte{k}"] = np.bitwise_xor.reduce(
                [np.where(byte >> b & 1, unit[8 * k + b] if 8 * k + b < 23 else 0, 0) for b in range(8)])
    return _tables["byte0"][values & 255] ^ _tables["byte1"][values >> 8 & 255] ^ _tables["byte2"][values >> 16 & 255]


def codewords(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of the codeword nearest to each 23-bit value, and of those at distance four (-1: none).

    A value within one bit of another lies within four bits of the other's nearest
    codeword, so the nearest index of one is among all indices of the other.
    """
    rest = _remainder(values)
    near, far = _tables["near"][rest], _tables["far"][rest]
    return (values ^ near) >> 11, np.where(far < 0, -1, (values[:, None] ^ far) >> 11)


def _segment(prints: np.ndarray, k: int) -> np.ndarray:
    low, size = SEGMENTS[k]
    return (prints.view(np.uint64) >> np.uint64(low) & np.uint64((1 << size) - 1)).astype(np.int64)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, nearest) of all keys of the fingerprints.

    Two bits spread over three segments leave one segment equal whose next one
    differs by a bit at most: the key is the equal segment and a codeword index of
    the next.
    """
    rows, keys, nearest = [], [], []
    at = np.arange(len(prints))
    for k in range(3):
        same = (np.int64(k) << np.int64(40)) | (_segment(prints, k) << 12)
        near, far = codewords(_segment(prints, (k + 1) % 3))
        rows.append(at)
        keys.append(same | near)
        nearest.append(np.ones(len(at), bool))
        for column in far.T:
            on = column >= 0
            rows.append(at[on])
            keys.append(same[on] | column[on])
            nearest.append(np.zeros(int(on.sum()), bool))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(nearest)


def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of every text, from its shingles of so many words."""
    hashes: list[int] = []
    bounds = [0]
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= shingle:
            hashes += [digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(shingle))))]
        elif words:
            hashes.append(digest(b" ".join(words), SEED))
        bounds.append(len(hashes))
    bounds = np.array(bounds)
    counts = np.diff(bounds)
    out = np.zeros(len(texts), np.uint64)
    if not hashes:
        return out.view(np.int64)
    bits = np.unpackbits(np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    some = np.flatnonzero(counts)
    sums = np.add.reduceat(bits, bounds[:-1][some], axis=0, dtype=np.int32)
    out[some] = np.packbits(2 * sums > counts[some, None], axis=1).view(">u8").ravel()
    return out.view(np.int64)


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The keys of every row and ``print`` (long, the 64 bits): those set in over half the shingle hashes.

    A-Z are lowered; words are separated by ASCII white space; a null or empty text,
    or one without words, has fingerprint zero.
    """
    ship(docs.sparkSession)
    plain, carried = picked(docs, keys, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                prints = fingerprints_of(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(k) for k in keys] + [pa.array(prints)], [*keys, "print"])

    return plain.mapInArrow(run, carried + "print long")


def links(prints: DataFrame) -> DataFrame:
    """Links that connect what is within two bits: (a, b) of distinct fingerprints (column ``print``).

    Small buckets of a key are joined to pairs and verified.  In a bucket of many
    fingerprints each one names the 65 points within one bit of it: two are within
    two bits exactly when they share a point, and at most 65 share one, so every
    such point links its members to the smallest of them.
    """
    ship(prints.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("print").to_numpy()
            rows, keys, nearest = keys_of(values)
            yield pa.RecordBatch.from_arrays([pa.array(values[rows]), pa.array(keys), pa.array(nearest)], ["print", "key", "nearest"])

    keyed = written(prints.mapInArrow(run, "print long, key long, nearest boolean"), "keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("nearest").alias("met")).where("n > 1 and met")
    shared = written(keyed.join(sizes.select("key", "n"), "key"), "shared")
    quiet = shared.where(F.col("n") <= PAIR_BUCKET)
    left = quiet.where("nearest").select("key", F.col("print").alias("a"))
    right = quiet.select("key", F.col("print").alias("b"))
    pairs = left.join(right, "key").where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS))
    full = shared.where(F.col("n") > PAIR_BUCKET).select("print").distinct()
    points = F.array(F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") for k in range(64)])
    hubs = (full.select("print", F.explode(points).alias("bit"))
            .select("print", F.col("print").bitwiseXOR(F.col("bit")).alias("hub"))
            .groupBy("hub").agg(F.collect_set("print").alias("members")).where(F.size("members") > 1)
            .select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b"))
    return pairs.select("a", "b").unionAll(hubs.select("a", "b"))


def groups(docs: DataFrame, keys: list[str], text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row for every row of docs: its keys, ``print``, ``root`` and ``component_id``.

    root is the smallest fingerprint and component_id the smallest id reachable over links of two bits or fewer.
    Fingerprints are reduced to distinct ones before any join, so that exact copies
    never meet in pairs.  Null ids are not smaller than others; a group of null ids
    alone has a null component_id.  An empty table gives no rows.
    """
    prints = written(fingerprints(docs, keys, text), "fingerprints")
    distinct = written(prints.groupBy("print").agg(F.min(id_column).alias("first")), "distinct")
    roots = components(links(distinct.select("print")), "a", "b")
    placed = written(
        distinct.join(roots, distinct["print"] == roots["node"], "left").select("print", "first", F.coalesce("root", "print").alias("root")), "placed")
    # stored sides, so that the rows of a large group or a common fingerprint can be split over tasks
    smallest = written(placed.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = written(placed.join(smallest, "root").select("print", "root", "component_id"), "named")
    return prints.join(named, "print").select(*keys, "print", "root", "component_id")
