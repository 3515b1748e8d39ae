"""Quotation linking: quoted passages are joined to the messages they come from, and threads ordered by reply."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatorlake.session import written

from .common import chunks, ship
from .shards import prefix_sums

_MARK = re.compile(r"[ \t]*>")
_SPACES = re.compile(r"\s+")
#: Between two sentences of a normalised passage.
_SENTENCE_END = re.compile(r"(?<=[.!?…。！？]) ")


def quote_level(line: str) -> tuple[int, str]:
    """How many quotation marks a line begins with, and the rest of it."""
    level = 0
    while found := _MARK.match(line):
        level += 1
        line = line[found.end() :]
    return level, line


def normalised(passage: str) -> str:
    return _SPACES.sub(" ", passage).strip().lower()


def _key(passage: str) -> int:
    value = xxhash.xxh64_intdigest(passage.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def parsed(text: str) -> tuple[str, list[int], list[dict]]:
    """The message's own text, the hashes of its own passages, and its quotes (level, hash, size).

    A passage is a run of lines of one quote level, without blank lines inside; its
    single lines and, however the lines are broken, its sentences count as passages as
    well, so that a quote of part of a paragraph is found.  An attribution line ("... wrote:") right before a quote belongs to it.
    """
    lines = [quote_level(line) for line in text.split("\n")]
    dropped = set()
    for k, (level, rest) in enumerate(lines):
        later = next((n for n in range(k + 1, min(k + 3, len(lines))) if lines[n][1].strip()), None)
        if later is not None and lines[later][0] == level + 1 and rest.rstrip().endswith("wrote:"):
            dropped.add(k)
    runs: list[tuple[int, list[str]]] = []
    for k, (level, rest) in enumerate(lines):
        if k in dropped:
            runs.append((-1, []))
        elif not rest.strip():
            runs.append((-1, []))
        elif runs and runs[-1][0] == level:
            runs[-1][1].append(rest)
        else:
            runs.append((level, [rest]))
    own: set[int] = set()
    quotes: dict[tuple[int, int], int] = {}
    for level, rest in runs:
        if level < 0:
            continue
        whole = normalised(" ".join(rest))
        for passage in {whole, *(normalised(r) for r in rest), *_SENTENCE_END.split(whole)} - {""}:
            if level == 0:
                own.add(_key(passage))
            else:
                quotes[level, _key(passage)] = len(passage)
    kept = "\n".join(rest for k, (level, rest) in enumerate(lines) if level == 0 and k not in dropped)
    kept = re.sub(r"\n\s*\n+", "\n\n", kept).strip() if quotes else text
    return kept, sorted(own), [{"level": lv, "passage": h, "size": n} for (lv, h), n in sorted(quotes.items())]


def _split(messages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                out = [parsed(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv"), part.column("turn"), part.column("role"), pa.array([o[0] for o in out], pa.string()),
                     pa.array([o[1] for o in out], pa.list_(pa.int64())),
                     pa.array([o[2] for o in out], pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.int64()), ("size", pa.int32())])))],
                    ["conv", "turn", "role", "own", "passages", "quotes"])

    return messages.mapInArrow(
        run, "conv long, turn long, role string, own string, passages array<long>, quotes array<struct<level:int,passage:long,size:int>>")


def _roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of every message with a parent, by pointer doubling over written tables."""
    steps = written(parents.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "roots")
    while True:
        up = steps.select("conv", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        steps = written(steps.join(up, ["conv", "root"], "left").select(
            "conv", "turn", F.coalesce("above", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("above").isNotNull().alias("moved")), "roots")
        if steps.where("moved").isEmpty():
            return steps.drop("moved")
        steps = steps.drop("moved")


def reply_order(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for every message, in reply order: conv_id, turn, role, position, parent_turn, root_turn, depth, n_quotes, text, formatted.

    The source of a quoted passage is the first earlier turn of its conversation
    that says it itself.  A message's parent is the source of its least nested
    quotes; of several the one that covers most characters, then the latest.
    Messages without a source begin threads.  Threads are ordered by their first
    turn and messages in a thread by turn, so a reply follows what it answers;
    ``position`` counts all rows in that order, conversations being contiguous, and
    is global so that no conversation is gathered in one task.  ``text`` has no
    quotes; ``formatted`` puts the role's marks around it.

    Null texts are empty, null roles become "user"; rows with a null conversation or
    turn are kept, never linked, and come first.  Equal (conversation, turn) rows
    are kept; as sources they count as one.  An empty table gives no rows.
    """
    ship(messages.sparkSession)
    plain = messages.select(messages[conv].cast("long").alias("conv"), messages[turn].cast("long").alias("turn"), messages[role].alias("role"), messages[text].alias("text"))
    split = written(_split(plain), "messages")
    asked = split.where(F.size("quotes") > 0).select("conv", "turn", F.explode("quotes").alias("q")).select("conv", "turn", "q.*").distinct()
    asked = written(asked, "asked")  # stored, as the other side, so that a passage that many turns quote can be split over tasks
    sources = split.select("conv", "turn", F.explode("passages").alias("passage")).groupBy("conv", "passage").agg(F.min("turn").alias("source"))
    sources = written(sources, "sources")
    linked = asked.join(sources, ["conv", "passage"]).where(F.col("source") < F.col("turn"))
    votes = linked.groupBy("conv", "turn", "source").agg(F.min("level").alias("level"), F.sum("size").alias("size"))
    best = votes.groupBy("conv", "turn").agg(
        F.max_by("source", F.struct(-F.col("level"), "size", "source")).alias("parent"))
    parents = written(best, "parents")
    roots = _roots(parents)
    placed = split.join(parents, ["conv", "turn"], "left").join(roots, ["conv", "turn"], "left")
    rows = placed.select(
        "conv", F.coalesce("root", "turn").alias("root"), "turn", F.coalesce("role", F.lit("user")).alias("role"), F.col("parent").alias("parent_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"), F.size("quotes").cast("long").alias("n_quotes"), F.col("own").alias("text"),
        F.octet_length("own").cast("long").alias("size"))
    ordered = prefix_sums(rows, ["conv", "root", "turn", "role"], "size")
    return ordered.select(
        F.col("conv").alias("conv_id"), "turn", "role", F.col("row").alias("position"), "parent_turn", F.col("root").alias("root_turn"), "depth", "n_quotes",
        "text", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")).alias("formatted"))
