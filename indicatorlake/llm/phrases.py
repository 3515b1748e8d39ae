"""Phrase collocations: phrases grown from their beginnings, best first, until no unseen one can be among the best."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatorlake.session import written

from .common import Words, chunks, folding, mixed, ship, spans_hash, text_bytes, words_of

BEST = 2000
LEAST = 10
#: A phrase goes when a longer candidate around it has at least this percentage of its occurrences.
INSIDE_PERCENT = 50
SCALE = 1_000_000
#: Bytes of text whose phrases are counted together before Spark merges the counts.
BLOCK_BYTES = 1 << 20
#: Rows that a task hands to Spark at a time.
SENT_ROWS = 1 << 15
#: Bits of a filter, a power of two; phrases that share a bit are counted in vain, never missed.
FILTER_BITS = 1 << 25
#: The frontier first reaches the FIRST * BEST-th best pair of words, then FURTHER times as many, and so on.
FIRST, FURTHER = 2, 4
NO_LANGUAGE = "und"
SALTS = 64

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_BLANK = folding(b" \t" + _PIECE_ENDS)
_ENDS = folding(_PIECE_ENDS)


def _split(texts: pa.Array) -> tuple[Words, np.ndarray, pa.DictionaryArray]:
    """Words in small letters, whether each is followed by another of its piece, and their spellings."""
    words = words_of(texts, _BLANK)
    words.data = words.data + np.uint8(32) * ((words.data >= 65) & (words.data <= 90)).astype(np.uint8)
    closed = np.zeros(len(words.data) + 1, np.int32)
    np.cumsum(_ENDS[words.data], out=closed[1:])
    goes_on = np.zeros(len(words.starts), bool)
    goes_on[:-1] = (closed[words.ends[:-1]] == closed[words.starts[1:]]) & (words.rows[:-1] == words.rows[1:])
    ends = np.r_[0, np.cumsum(words.ends - words.starts)]
    letters = words.data[~_BLANK[words.data]]
    spelled = pa.LargeStringArray.from_buffers(len(words.starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters))
    return words, goes_on, spelled.dictionary_encode()


def _languages(langs: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of every row's language in the list of them, and that list."""
    coded = langs.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def _next(so_far: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mixed(so_far * np.uint64(3) + h)


def _joined(language: np.ndarray, *words: np.ndarray) -> np.ndarray:
    out = language
    for h in words:
        out = _next(out, h)
    return out


class Filter:
    """A set of hashes as bits; it may hold more than was put in, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = hashes % np.uint64(FILTER_BITS)
        return (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slot, bit = self.slots(hashes)
        return (self.bits[slot] >> bit & np.uint64(1)).astype(bool)


def _filter(hashes: DataFrame) -> Broadcast:
    """A filter of the hashes of a table (h): FILTER_BITS bits, however many rows there are.

    Spark makes the bits itself: a second Python step in a stage has workers of its own, with their memory.
    """
    bits_of = {"slot": F.expr(f"shiftright(h & {FILTER_BITS - 1}L, 6)"), "bits": F.expr("shiftleft(1L, CAST(h & 63 AS INT))")}
    found = hashes.select("h").withColumns(bits_of).groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def _hashes(phrases: DataFrame) -> DataFrame:
    """The hash (h) of every row (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _, _ = _split(batch.column("phrase"))
            row, langs = _languages(batch.column("lang"))
            parts = words.hashes()
            sizes = np.diff(words.bounds)
            first = words.bounds[:-1]
            out = _language_hash(langs)[row]
            for k in range(int(sizes.max(initial=0))):
                more = sizes > k
                out[more] = _next(out[more], parts[first[more] + k])
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["h"])

    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


def _language_hash(langs: pa.Array) -> np.ndarray:
    data, at = text_bytes(langs)
    return spans_hash(data, at[:-1], at[1:])


def _counted(docs: DataFrame, size: int, keep: Callable[[list[np.ndarray]], np.ndarray], spell: bool = True) -> DataFrame:
    """(lang, phrase, f) of all phrases of ``size`` words that ``keep`` lets through by the hashes of language and words.

    Without ``spell`` they come as (h, f), by a hash that different phrases may share.
    """

    def counts_of(part: pa.RecordBatch) -> pa.RecordBatch:
        words, goes_on, spelled = _split(part.column("text"))
        row, langs = _languages(part.column("lang"))
        kinds, ids = len(spelled.dictionary) or 1, spelled.indices.to_numpy().astype(np.int64)
        lang = row[words.rows].astype(np.int64)
        places = np.arange(len(ids))
        for k in range(1, size):  # phrases that go on
            places = places[goes_on[places + k - 1]]
        hashes = words.hashes()
        kept = keep([_language_hash(langs)[lang[places]], *(hashes[places + k] for k in range(size))])
        places = places[kept]
        number = lang[places]
        for k in range(size):
            number = np.unique(number, return_inverse=True)[1].astype(np.int64) * kinds + ids[places + k]
        _, first, counts = np.unique(number, return_index=True, return_counts=True)
        at, counts = places[first], pa.array(counts.astype(np.int64))
        if not spell:
            h = _joined(_language_hash(langs)[lang[at]], *(hashes[at + k] for k in range(size)))
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), counts], ["h", "f"])
        parts = [spelled.dictionary.take(pa.array(ids[at + k])) for k in range(size)]
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        return pa.RecordBatch.from_arrays([langs.take(pa.array(lang[at])), phrase.cast(pa.string()), counts], ["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", BLOCK_BYTES):
                found = counts_of(part)
                for low in range(0, found.num_rows, SENT_ROWS):
                    yield found.slice(low, SENT_ROWS)

    by = ["lang", "phrase"] if spell else ["h"]
    return docs.mapInArrow(run, "lang string, phrase string, f long" if spell else "h long, f long").groupBy(*by).agg(F.sum("f").alias("f"))


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE a a / (left right)) in whole numbers of up to 38 digits; counts have at most 15."""
    whole = [f"CAST({c} AS DECIMAL(15,0))" for c in (a, a, left, right)]
    return F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * {whole[0]} * {whole[1]}) div ({whole[2]} * {whole[3]})")


def _part(low: int, high: int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), low, high), " ")


def _with_counts(phrases: DataFrame, column: str, name: str, counts: DataFrame) -> DataFrame:
    return phrases.join(counts.select("lang", F.col("phrase").alias(column), F.col("f").alias(name)), ["lang", column])


def _edges(scored: DataFrame, rank: DataFrame) -> DataFrame:
    """(lang, edge): per language the score of the row at its ``rank`` from the top, 0 where there are fewer rows."""
    steps = scored.groupBy("lang", "score").agg(F.count("*").alias("rows"))
    # at most SCALE + 1 scores a language
    above = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    reached = steps.withColumn("upto", above).join(rank, "lang").where("upto >= rank").groupBy("lang").agg(F.max("score").alias("edge"))
    return rank.join(reached, "lang", "left").select("lang", F.coalesce("edge", F.lit(0)).alias("edge"))


def _survivors(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """All triples, and the pairs that no triple around them stands for."""
    around = triples.select("lang", "f", F.explode(F.array("front", "back")).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    alone = pairs.join(around, ["lang", "phrase"], "left").where(f"around IS NULL OR 100 * around < {INSIDE_PERCENT} * f")
    columns = ["lang", "phrase", F.col("f").alias("a"), "l", "r", "score"]
    return alone.select(*columns).unionAll(triples.select(*columns))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", best: int = BEST, least: int = LEAST) -> DataFrame:
    """Per language the ``best`` phrases of two and three words: lang, rank, phrase, a, l, r, n, score.

    Words of a piece are counted, then pairs of words that both occur ``least`` times,
    then triples, which alone could be very many.  A pair xy bounds its triples: the
    score of xyz is at most SCALE f(xy) / f(x), as f(yz) and f(xy) are no less than
    f(xyz).  Pairs stand in the order of the larger of this bound and their own score;
    a round counts the triples around the best of them, down to an edge.  Every pair
    and triple at or above the edge is then known with its fate, so a language with
    ``best`` survivors there is done, ties included; the others go on to a lower edge.

    Counts are exact: a block of texts counts its phrases by their words and Spark
    sums the blocks' counts, so that no phrase is a hot key.  What is looked for goes
    to the tasks as a filter of FILTER_BITS bits; phrases that pass in vain are counted
    and then left out by their counts.

    A null text has no words, a null language is ``und``; empty texts and words of any
    length are handled, repeated rows count each, an empty table gives no rows, and
    other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.coalesce(docs[lang].cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(docs[text], F.lit("")).alias("text"))
    words = written(_counted(plain, 1, lambda h: np.ones(len(h[0]), bool)), "words")
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    often = words.where(F.col("f") >= least)
    frequent = _filter(_hashes(often))

    def of_frequent(h: list[np.ndarray]) -> np.ndarray:
        known = Filter(frequent.value)
        return known.holds(_joined(h[0], h[1])) & known.holds(_joined(h[0], h[2]))

    # most pairs are rare, so they are first counted by their hash, which can only count too many
    likely = _filter(_counted(plain, 2, of_frequent, spell=False).where(F.col("f") >= least))
    frequent.unpersist()
    pairs = written(_counted(plain, 2, lambda h: Filter(likely.value).holds(_joined(*h))).where(F.col("f") >= least), "pairs")
    likely.unpersist()
    sides = pairs.withColumns({"front": _part(1, 1), "back": _part(2, 1)})
    pairs = written(_with_counts(_with_counts(sides, "front", "l", often), "back", "r", often).select(
        "lang", "phrase", "f", "l", "r", _score("f", "l", "r").alias("score")).withColumn(
        "bound", F.greatest("score", _score("f", "f", "l"))), "scored-pairs")  # f f / (f l) is f / l
    known_pairs = _filter(_hashes(pairs))
    open_, rank, above, found = totals.select("lang"), best * FIRST, None, None
    while True:
        edges = written(_edges(pairs, open_.select("lang", F.lit(rank).cast("long").alias("rank"))), "edges")
        frontier = pairs.join(edges, "lang").where("bound >= edge")
        if above is not None:
            frontier = frontier.join(above.withColumnRenamed("edge", "before"), "lang").where("bound < before")
        reached = _filter(_hashes(frontier))

        def around_frontier(h: list[np.ndarray], reached: Broadcast = reached) -> np.ndarray:
            front, back = _joined(h[0], h[1], h[2]), _joined(h[0], h[2], h[3])
            known, wanted = Filter(known_pairs.value), Filter(reached.value)
            return known.holds(front) & known.holds(back) & (wanted.holds(front) | wanted.holds(back))

        triples = written(_counted(plain, 3, around_frontier).where(F.col("f") >= least).withColumns(
            {"front": _part(1, 2), "back": _part(2, 2), "head": _part(1, 1), "tail": _part(3, 1)}), "triples")
        reached.unpersist()
        scored = triples
        for column, name, counts in (("head", "l1", often), ("back", "r1", pairs), ("front", "l2", pairs), ("tail", "r2", often)):
            scored = _with_counts(scored, column, name, counts)
        cuts = scored.withColumns({"s1": _score("f", "l1", "r1"), "s2": _score("f", "l2", "r2")})
        first = F.col("s1") <= F.col("s2")
        scored = cuts.select("lang", "phrase", "f", "front", "back", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                             F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
        # a triple met in two rounds has the same counts in both
        found = written(scored if found is None else found.unionAll(scored).distinct(), "found")
        above = edges if above is None else written(edges.unionAll(above.join(edges, "lang", "left_anti")), "above")
        settled = _survivors(pairs, found).join(above, "lang").where("score >= edge").drop("edge")
        open_ = written(edges.where("edge > 0").join(
            settled.groupBy("lang").agg(F.count("*").alias("rows")).where(F.col("rows") >= best), "lang", "left_anti").select("lang"), "open")
        if open_.isEmpty():
            break
        rank *= FURTHER
    known_pairs.unpersist()
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    final = _edges(settled, totals.select("lang", F.lit(best).cast("long").alias("rank")))
    top = settled.join(final, "lang").where("score >= edge").withColumn("salt", F.xxhash64("phrase") % SALTS)
    for by in (["lang", "salt"], ["lang"]):  # very many ties first in parts
        top = top.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
