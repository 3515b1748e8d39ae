"""Near copies by their sets of word shingles: SimHash fingerprints and MinHash keys name candidates, exact similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatorlake.session import written

from . import simhash
from .common import chunks, components, mixed, picked, ship, spans_hash, windows, words_of

SHINGLE = 5
#: Near copies share at least this part (numerator, denominator) of the union of their shingles.
SIMILARITY = (4, 5)
#: Every key is made of ROWS smallest hashes.  Two sets of similarity s share none of
#: BANDS keys with a chance of (1 - s^ROWS)^BANDS: 3 in a million at 0.8.
ROWS, BANDS = 5, 32
#: Sets of one key that a task compares with all others of the key.
MET_AT_ONCE = 1024
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, ascending, and the bounds of each text."""
    words = words_of(texts)
    upper = (words.data >= 65) & (words.data <= 90)
    words.data = words.data + np.uint8(32) * upper.astype(np.uint8)
    hashes = words.hashes()
    full = np.flatnonzero(words.same_text(SHINGLE))
    lengths = np.diff(words.bounds)
    short = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
    rows = np.concatenate([words.rows[full], short])
    values = np.concatenate([windows(hashes, SHINGLE)[full], spans_hash(hashes, words.bounds[short], words.bounds[short + 1])])
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return values[fresh], np.searchsorted(rows[fresh], np.arange(len(texts) + 1))


def _sketches(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every set its hash (0: empty), its size and its keys, a row of BANDS."""
    sizes = np.diff(bounds)
    some = np.flatnonzero(sizes)
    prints = np.zeros(len(sizes), np.uint64)
    keys = np.zeros((len(sizes), BANDS), np.uint64)
    if len(some):
        at = bounds[:-1][some]
        prints[some] = mixed(np.add.reduceat(mixed(values), at) + sizes[some].astype(np.uint64))
        for band in range(BANDS):
            key = np.full(len(some), band + 1, np.uint64)
            for factor in _FACTORS[band * ROWS : (band + 1) * ROWS]:
                key = mixed(key + np.minimum.reduceat(values * factor, at))
            keys[some, band] = key
    return prints.view(np.int64), sizes.astype(np.int32), keys.view(np.int64)


def sketches(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The keys of every row, ``print`` (a hash of its shingle set), ``n`` (shingles), ``bands`` (none for an empty set) and ``simhash``.

    A-Z are lowered; words are separated by ASCII white space; a text of fewer words
    than a shingle is one shingle, and null, empty and blank texts have the empty set.
    """
    ship(docs.sparkSession)
    plain, carried = picked(docs, keys, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                prints, sizes, bands = _sketches(*_shingles(part.column(text)))
                ends = np.r_[0, np.cumsum(np.where(sizes > 0, BANDS, 0))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keys), pa.array(prints), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[sizes > 0].ravel())),
                     pa.array(simhash.fingerprints_of(part.column(text).to_pylist(), SHINGLE))],
                    [*keys, "print", "n", "bands", "simhash"])

    return plain.mapInArrow(run, carried + "print long, n int, bands array<long>, simhash long")


def _sets(texts: DataFrame) -> DataFrame:
    """(print, members) of rows of print and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                values, bounds = _shingles(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("print"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))], ["print", "members"])

    return texts.select("print", "text").mapInArrow(run, "print long, members array<long>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; every pair is compared exactly."""
    part, whole = SIMILARITY
    left = pairs.join(sets.select(F.col("print").alias("a"), F.col("members").alias("mine")), "a")
    both = left.join(sets.select(F.col("print").alias("b"), F.col("members").alias("theirs")), "b")
    common = F.size(F.array_intersect("mine", "theirs")).cast("long")
    # common / union >= part / whole, in whole numbers
    return both.where((part + whole) * common >= part * (F.size("mine") + F.size("theirs"))).select("a", "b")


def _may_be_similar(a: str, b: str):
    part, whole = SIMILARITY
    return whole * F.least(a, b).cast("long") >= part * F.greatest(a, b).cast("long")


def _prefixes(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, print, n, root, at): the shingles by which sets of different roots can meet, and their place in their set.

    All sets order their shingles alike, rarest first.  Two sets of similarity s and
    more share one of the first n - ceil(s n) + 1 shingles of each, so these are a set's
    keys; those that no other set holds, or only sets of one root, meet nobody.
    """
    part, whole = SIMILARITY
    members = written(sets.join(rest, "print").select("print", "root", F.size("members").alias("n"), F.explode("members").alias("key")), "members")
    often = written(members.groupBy("key").agg(F.count("*").alias("f")).where("f > 1"), "often")
    common = members.join(often, "key").groupBy("print", "n", "root").agg(F.sort_array(F.collect_list(F.struct("f", "key"))).alias("ordered"))
    # the others come first in the order
    alone = F.col("n") - F.size("ordered")
    length = F.col("n") - F.ceil(F.col("n") * part / whole) + 1
    kept = common.select("print", "n", "root", alone.alias("alone"), F.posexplode(F.slice("ordered", F.lit(1), F.greatest(F.lit(0), length - alone).cast("int"))).alias("at", "k"))
    keyed = written(kept.select("k.key", "print", "n", "root", (F.col("at") + F.col("alone")).alias("at")), "keyed")
    mixed_keys = keyed.groupBy("key").agg(F.count("*").alias("m"), F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key", "m")
    return written(keyed.join(mixed_keys, "key"), "prefixes")


def _prefix_pairs(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of every two sets of different roots that may be similar enough: by size, by their keys, and by what follows a shared key.

    The members of a crowded key are dealt to several tasks, each of which meets all
    the others.
    """
    part, whole = SIMILARITY
    keyed = _prefixes(rest, sets)
    slices = F.ceil(F.col("m") / MET_AT_ONCE).cast("int")
    left = keyed.select("key", F.pmod(F.xxhash64("print"), slices).cast("int").alias("slice"), *[F.col(c).alias(f"{c}_a") for c in ("print", "n", "root", "at")])
    right = keyed.select("key", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), *[F.col(c).alias(f"{c}_b") for c in ("print", "n", "root", "at")])
    left_over = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = (part + whole) * left_over.cast("long") >= part * (F.col("n_a") + F.col("n_b"))
    pairs = left.join(right, ["key", "slice"]).where(
        (F.col("print_a") < F.col("print_b")) & (F.col("root_a") != F.col("root_b")) & _may_be_similar("n_a", "n_b") & enough)
    return pairs.select(F.col("print_a").alias("a"), F.col("print_b").alias("b")).distinct()


def _families(distinct: DataFrame) -> DataFrame:
    """(print, n, hub, hub_n): every set and the smallest of those whose fingerprints are linked with its own, if that is another."""
    roots = components(simhash.links(distinct.select(F.col("simhash").alias("print")).distinct()), "a", "b")
    placed = written(distinct.join(roots, distinct["simhash"] == roots["node"], "left").select(
        "print", "n", F.coalesce("root", "simhash").alias("family")), "families")
    least = placed.groupBy("family").agg(F.min(F.struct("print", "n")).alias("low"), F.count("*").alias("m")).where("m > 1")
    met = placed.join(written(least, "hubs"), "family").select("print", "n", F.col("low.print").alias("hub"), F.col("low.n").alias("hub_n"))
    return written(met.where("print <> hub"), "alike")


def groups(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row for every row of docs: its keys, ``print`` and ``root``, the smallest print it is linked with.

    Rows of equal shingle sets are one set before any join.  SimHash comes first: sets
    whose fingerprints over the same shingles are linked (``simhash.links``) meet the
    smallest set of their family.  Two bits reach the closest copies only, so sets that
    share a MinHash key are candidates as well.  Every set meets the smallest, then the largest set of its
    buckets, so that a large group of near copies becomes one without a square of
    pairs.  Sets that share a bucket with another group by then meet again by their
    rarest shingles, which leaves out no link: see ``_prefixes``.
    """
    plain = docs.select(*[docs[c] for c in keys], docs[text].alias("text"))
    prints = written(sketches(plain, keys), "prints")
    named = F.struct(*[F.struct(F.col(k).isNull(), k) for k in keys])
    distinct = written(prints.where("n > 0").groupBy("print").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min(named).alias("row"), F.min("simhash").alias("simhash")), "distinct")
    keyed = distinct.select("print", "n", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(
        F.count("*").alias("m"), F.min(F.struct("print", "n")).alias("low"), F.max(F.struct("print", "n")).alias("high")).where("m > 1")
    shared = written(keyed.join(written(buckets, "buckets"), "key"), "shared")
    alike = _families(distinct)
    wanted = distinct.join(shared.select("print").unionAll(alike.select("print")).unionAll(alike.select("hub")).distinct(), "print", "left_semi").select(
        "print", *[F.col("row")[f"col{k + 1}"][name].alias(f"key_{k}") for k, name in enumerate(keys)])
    # by the keys of one of its rows; rows that repeat are stored before they become one
    meets = [plain[name].eqNullSafe(F.col(f"key_{k}")) for k, name in enumerate(keys)]
    texts = written(plain.join(wanted, meets).select("print", "text"), "texts")
    sets = written(_sets(texts.dropDuplicates(["print"])), "sets")

    links, roots = None, None
    for hub in ("simhash", "low", "high", None):
        if hub:
            pairs = alike if hub == "simhash" else shared.select("print", "n", F.col(f"{hub}.print").alias("hub"), F.col(f"{hub}.n").alias("hub_n"))
            pairs = pairs.where((F.col("print") != F.col("hub")) & _may_be_similar("n", "hub_n")).select(
                F.least("print", "hub").alias("a"), F.greatest("print", "hub").alias("b")).distinct()
            if roots is not None:
                pairs = (pairs.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
                         .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
                         .where(~F.coalesce("ra", "a").eqNullSafe(F.coalesce("rb", "b"))).select("a", "b"))
        else:
            placed = written(shared.where("m > 2").join(roots, shared["print"] == roots["node"], "left").select(
                "key", "print", F.coalesce("root", "print").alias("root")), "placed")
            open_keys = written(placed.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key"), "open")
            rest = written(placed.join(open_keys, "key").select("print", "root").distinct(), "rest")
            pairs = _prefix_pairs(rest, sets)
        found = written(_verified(written(pairs, "pairs"), sets), "found")
        links = found if links is None else links.unionAll(found)
        roots = written(components(links, "a", "b"), "roots")
    return prints.join(roots, prints["print"] == roots["node"], "left").select(*keys, "print", F.coalesce("root", "print").alias("root"))
