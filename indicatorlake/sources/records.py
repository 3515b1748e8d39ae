"""Records of CSV text: which lines begin and end one, whatever the quotes in it.

A line is met in one of two states: at the beginning of a record, or inside a
quoted cell that an earlier line opened.  Only a quote that begins a cell opens
one; a quote anywhere else in a plain cell is a letter like others.  So a line, and
a split of lines, is known by the two states it would leave, and those are put
together in order over a file.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship, written

# All repetitions are possessive: no way back, so no recursion and linear time on cells of any length.
_INSIDE = r'(?:[^"]++|"")*+'
_QUOTED = rf'"{_INSIDE}"'
#: What follows a closing quote before the next comma is kept with the cell; such a record is malformed.
_LAX_CELL = rf'(?:[^",][^,]*+|{_QUOTED}[^,]*+)'
_CELL = rf'(?:[^",][^,]*+|{_QUOTED})'
_END = r"(?![\s\S])"
#: A line that begins a record and ends inside a quoted cell, and a line that begins and ends inside one.
OPENS = rf'^{_LAX_CELL}?+(?:,{_LAX_CELL}?+)*+"{_INSIDE}{_END}'
STAYS = rf'^{_INSIDE}(?:"[^,]*+(?:,{_LAX_CELL}?+)*+"{_INSIDE})?+{_END}'
#: A whole record without text between a closing quote and the next comma.
WELL_FORMED = rf"^{_CELL}?+(?:,{_CELL}?+)*+\r?{_END}"
#: A quoted cell of a record; the one at the end may lack its closing quote.
QUOTED_CELL = rf'(?<![^,]){_QUOTED}'

SPANS, MALFORMED, UNCLOSED, OTHER_WIDTH = "spans lines", "malformed", "unclosed", "other width"
#: Bytes of lines whose quotes and commas are looked at together.
PART_BYTES = 1 << 21
QUOTE, COMMA, LINE_FEED = b'",\n'
#: Bytes of an open record that are held in memory; a longer one waits in a file.
OPEN_BYTES = 1 << 25
#: A letter that is no white space, as ``is_blank`` has it.
NO_BLANK = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def single_byte_letters(encoding: str) -> tuple[str, str] | None:
    """Latin-1 letters and what they are in an encoding of one byte a letter that begins as ASCII; None for other encodings."""
    every = bytes(range(256))
    try:
        letters = every.decode(encoding, "replace")
    except LookupError:
        return None
    if len(letters) != 256 or letters[:128] != every[:128].decode("ascii"):
        return None
    changed = [k for k in range(128, 256) if letters[k] != chr(k)]
    return "".join(chr(k) for k in changed), "".join(letters[k] for k in changed)


def splittable(encoding: str) -> bool:
    """Whether the lines of a file in this encoding can be told apart before it is decoded."""
    return encoding.upper().replace("_", "-") in ("UTF-8", "UTF8") or single_byte_letters(encoding) is not None


def lines_of(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """(value, file, block, length, line, whole): all lines as text, and where they stand; a split is a file, a block and its length, ``whole`` if there is no other."""
    value = F.col("value")
    if encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        latin, letters = single_byte_letters(encoding)
        value = F.decode(value.cast("binary"), "ISO-8859-1")
        value = F.translate(value, latin, letters) if latin else value
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"), F.monotonically_increasing_id().alias("line"),
        ((F.col("_metadata.file_block_start") == 0) & (F.col("_metadata.file_block_length") == F.col("_metadata.file_size"))).alias("whole"))


def _quoted(value: Column) -> Column:
    return F.contains(value, F.lit('"'))


def _without_pairs(value: Column) -> Column:
    """Without quotes in pairs, which open and close a cell, stand for a letter, or are two: the state a line leaves is the same."""
    return F.replace(value, F.lit('""'), F.lit(""))


def opens(value: Column) -> Column:
    return _quoted(value) & F.rlike(_without_pairs(value), F.lit(OPENS))


def stays(value: Column) -> Column:
    return ~_quoted(value) | F.rlike(_without_pairs(value), F.lit(STAYS))


def malformed(record: Column) -> Column:
    """Whether a quoted cell of a record goes on after its closing quote, or has none."""
    return _quoted(record) & ~F.rlike(record, F.lit(WELL_FORMED))


def needs_records(lines: DataFrame) -> bool:
    """Whether lines are not records, or not good ones, so that a reader of lines would not do."""
    return not lines.where(opens(F.col("value")) | malformed(F.col("value"))).isEmpty()


def _after(start: int, run) -> Column:
    """The state (1: inside quotes) after the steps of a window, begun in ``start``.

    A step keeps the state, turns it round, or leaves one state whatever it was.
    What counts is the last step of the third kind and the turns after it.
    """
    turns = F.coalesce(F.sum(F.col("turn").cast("int")).over(run), F.lit(0))
    fixed = F.last(F.when(F.col("from0") == F.col("from1"), F.struct(F.col("from0").alias("state"), F.col("turns_upto").alias("turns"))), ignorenulls=True).over(run)
    return (F.coalesce(fixed["state"], F.lit(start)) + turns - F.coalesce(fixed["turns"], F.lit(0))) % 2


def _with_states(steps: DataFrame, by: Sequence[str], order: str, *starts: int) -> DataFrame:
    """Adds before0 (and before1): the state before each step when its partition begins outside (inside) quotes."""
    whole = Window.partitionBy(*by).orderBy(order)
    marked = steps.withColumn("turn", (F.col("from0") == 1) & (F.col("from1") == 0)).withColumn(
        "turns_upto", F.sum(F.col("turn").cast("int")).over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    return marked.withColumns({f"before{s}": _after(s, before) for s in starts}).drop("turn", "turns_upto")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about PART_BYTES of lines each, so that work arrays stay small; a longer line is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("value")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PART_BYTES, "right")))
            yield batch.slice(low, high - low)
            low = high


def _runs(batch: pa.RecordBatch, columns: Sequence[str]) -> Iterator[tuple[tuple, int, int]]:
    """(values, from, to) of the rows of a batch that stand together with the same values of some columns."""
    fresh = np.zeros(len(batch), bool)
    fresh[:1] = True
    for c in columns:
        values = batch.column(c)
        coded = pc.dictionary_encode(values).indices if pa.types.is_string(values.type) else values
        coded = coded.to_numpy(zero_copy_only=False)
        fresh[1:] |= coded[1:] != coded[:-1]
    ends = [*np.flatnonzero(fresh), len(batch)]
    for start, end in zip(ends, ends[1:]):
        yield tuple(batch.column(c)[start].as_py() for c in columns), int(start), int(end)


def _bits(found: np.ndarray) -> int:
    """Truth values as one number, the first as its lowest bit: such numbers are added and compared as wholes."""
    return int.from_bytes(np.packbits(found, bitorder="little").tobytes(), "little")


def _places(bits: int, size: int) -> np.ndarray:
    """The bits of a number that are set."""
    eights = np.frombuffer(bits.to_bytes(size // 8 + 1, "little"), np.uint8)
    some = np.flatnonzero(eights != 0)
    which, place = np.nonzero(np.unpackbits(eights[some], bitorder="little").reshape(-1, 8).view(bool))
    return some[which] * 8 + place


class _Lines:
    """Lines as bytes, each with a line feed after it, where each begins, and where odd runs of quotes end.

    An even run leaves the state that it is met in.  An odd one opens a cell that it
    begins, closes one that it is inside of, and is a letter anywhere else: begun
    after a comma or with a line it turns the state round, elsewhere it leaves 0.
    """

    def __init__(self, values: pa.Array):
        values = pa.concat_arrays([pc.fill_null(values, ""), pa.array([""], values.type)])
        sizes = pc.binary_length(values).to_numpy(zero_copy_only=False)[:-1]
        self.starts = np.r_[0, np.cumsum(sizes + 1, dtype=np.int64)]
        self.buffer = _joined(values).buffers()[2]
        self.size = size = int(self.starts[-1])
        self.data = np.frombuffer(self.buffer, np.uint8)[:size]
        self.separators = _bits((self.data == COMMA) | (self.data == LINE_FEED))
        quotes = _bits(self.data == QUOTE)
        begun = quotes & ~(quotes << 1)
        even = int.from_bytes(b"\x55" * (size // 8 + 1), "little")

        def odd_ends(begun: int) -> int:
            """What follows those of some runs that are odd: a bit added to the first quote of a run comes out behind its last one."""
            behind = [(quotes + some) & ~quotes for some in (begun & even, begun & ~even)]
            return (behind[0] & ~even) | (behind[1] & even)

        self.odd_ends = _places(odd_ends(begun), size)
        opening = _places(odd_ends(begun & (self.separators << 1 | 1)), size)
        self.turns = np.isin(self.odd_ends, opening, assume_unique=True).astype(np.int64)

    def states(self, start: int) -> np.ndarray:
        """The state before each odd run, and after the last one, begun in ``start``."""
        return _states(self.turns, np.zeros_like(self.turns), start)

    def begins(self, states: np.ndarray) -> np.ndarray:
        """The lines that begin a record."""
        return np.flatnonzero(states[np.searchsorted(self.odd_ends, self.starts[:-1], "right")] == 0)

    def first_not_blank(self, places: np.ndarray) -> int | None:
        """The place of the first line that is more than white space."""
        for place, low, high in zip(places, self.starts, self.starts[1:]):
            if NO_BLANK.search(self.data[low : high - 1].tobytes().decode(errors="replace")):
                return int(place)
        return None

    def outside(self, states: np.ndarray) -> np.ndarray:
        """Commas and line feeds that end a cell."""
        before, after = np.r_[0, states], np.r_[states, 0]
        at = np.r_[0, self.odd_ends, self.size]
        opened, closed = np.zeros((2, self.size + 1), bool)
        opened[at[before < after]] = True
        closed[at[before > after]] = True
        return _places(self.separators & ~(_bits(closed) - _bits(opened)), self.size)


def _states(from0: np.ndarray, from1: np.ndarray, start: int) -> np.ndarray:
    """The state before each of some steps, and after the last one, begun in ``start``.

    A step keeps the state, turns it round, or leaves one state whatever it was.
    What counts is the last step of the third kind and the turns after it.
    """
    turns = np.cumsum((from0 == 1) & (from1 == 0))
    fixed = np.maximum.accumulate(np.where(from0 == from1, np.arange(len(from0)), -1))
    known = fixed >= 0
    after = (np.where(known, from0[fixed], start) + turns - np.where(known, turns[fixed], 0)) % 2
    return np.r_[start, after]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is known of each split: for both states it may begin in the one it ends in, and where the first and last record begin."""
    names = ["file", "block", "length", "head", *[f"{c}{s}" for s in (0, 1) for c in ("from", "first", "begun")]]
    kinds = [pa.string(), *[pa.int64()] * (len(names) - 1)]
    split, known = None, {}

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip([*split, *(known[n] for n in names[3:])], kinds)], names)

    for batch in _parts(batches):
        places = batch.column("line").to_numpy(zero_copy_only=False)
        for place, start, end in _runs(batch, names[:3]):
            if place != split:
                if split is not None:
                    yield row()
                split, known = place, {**dict.fromkeys(names[3:]), "from0": 0, "from1": 1}
            lines = _Lines(batch.column("value").slice(start, end - start))
            if known["head"] is None:
                known["head"] = lines.first_not_blank(places[start:end])
            for s in (0, 1):
                turned = lines.states(known[f"from{s}"])
                begins = lines.begins(turned)
                if len(begins):
                    known[f"begun{s}"] = int(places[start + begins[-1]])
                    if known[f"first{s}"] is None:
                        known[f"first{s}"] = int(places[start + begins[0]])
                known[f"from{s}"] = int(turned[-1])
    if split is not None:
        yield row()


def _spans(buffer: pa.Buffer, starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> pa.Array:
    """The wanted ones of some stretches of bytes, which ascend, as text; the others are null."""
    bounds = np.stack([starts, ends], 1).ravel().astype(np.int32)
    texts = pa.StringArray.from_buffers(max(len(bounds) - 1, 0), pa.py_buffer(bounds), buffer)
    return texts.take(pa.array(np.arange(len(starts)) * 2, mask=~wanted))


def _cells_of(lines: _Lines, states: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, cells: bool, texts: bool) -> list[pa.Array]:
    """The text of records that end within some lines, whether they are taken apart here, what is wrong with them, and their cells.

    Records of several cells, no more than the header has, are taken apart here.  The
    rest is left to a CSV parser: other widths, bytes that are no text or that end lines or
    texts elsewhere, cells of many quotes alone, and what may be blank.
    """
    data, at = lines.data, np.searchsorted
    separators = np.r_[lines.outside(states), 0]
    low = at(separators[:-1], starts)
    count = at(separators[:-1], ends) - low + 1
    strange = np.flatnonzero((data == 13) | (data == 0))
    done = (count > 1) & (count <= width) & (at(strange, starts) == at(strange, ends))
    if len(data) and data.max() > 127:
        try:
            str(data, "utf-8")
        except UnicodeDecodeError:
            done[:] = False
    odd_ends, opens = np.r_[lines.odd_ends, [lines.size] * 2], np.r_[lines.turns, 0] == 1
    spans, bad = [], np.zeros(len(starts), bool)
    for k in range(width):
        there = count > k
        last = len(separators) - 1
        stop = np.where(there, separators[np.minimum(low + k, last)], ends)
        begin = starts if k == 0 else np.where(there, separators[np.minimum(low + k - 1, last)] + 1, ends)
        quoted = there & (data[begin] == QUOTE)
        first = at(lines.odd_ends, begin, "right")
        opened = quoted & opens[first] & (odd_ends[first] <= stop)
        bad |= opened & ((odd_ends[first + 1] != stop) | (at(lines.odd_ends, stop, "right") - first != 2))
        done &= ~quoted | opened | (stop - begin == 2)
        spans.append((begin + quoted, stop - quoted, quoted, there))
    bad &= done
    good = done & ~bad
    short = good & (count < width)
    kind = pa.array(np.where(bad, MALFORMED, OTHER_WIDTH).astype(object), pa.string(), mask=~(bad | short))
    out = [_spans(lines.buffer, starts, ends, ~good | (short & texts)), pa.array(done), kind]
    for begin, stop, quoted, there in spans if cells else ():
        wanted = good & there & (begin < stop)
        column = _spans(lines.buffer, np.where(wanted, begin, ends), np.where(wanted, stop, ends), wanted)
        quoted &= wanted
        if quoted.any():
            chosen = pa.array(quoted)
            column = pc.replace_with_mask(column, chosen, pc.replace_substring(column.filter(chosen), '""', '"'))
        out.append(column)
    return out


def _joined(lines: pa.Array) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")


class _Open:
    """The lines of a record that the last lines ended in; beyond OPEN_BYTES they wait in a file of the worker."""

    def __init__(self):
        self.held, self.size, self.file = [], 0, None

    def add(self, lines: pa.RecordBatch) -> None:
        self.held.append(lines)
        self.size += lines.nbytes
        if self.size > OPEN_BYTES:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
                self.sink = pa.ipc.new_stream(self.file, lines.schema)
            for batch in self.held:
                self.sink.write_batch(batch)
            self.held, self.size = [], 0

    def taken(self) -> Iterator[pa.RecordBatch]:
        """All lines in order, which are forgotten then."""
        if self.file is not None:
            self.sink.close()
            self.file.seek(0)
            yield from pa.ipc.open_stream(self.file)
            self.file.close()
        yield from self.held
        self.__init__()


def _put_together(width: int, cells: bool, texts: bool, whole: bool):
    """For whole records of lines in order, the first of which begins one; a record has the place of its first line.

    Of ``whole`` files the header is found here, and a record that one ends in is unclosed.
    """
    kept = ["file", "block", "line", "head"]
    names = ["record", "done", "kind", *[f"c{k}" for k in range(width if cells else 0)], *kept]

    def raw(records: pa.Array, kind: str | None, places: Sequence[pa.Array]) -> pa.RecordBatch:
        n, none = len(records), pa.nulls(len(records), pa.string())
        return pa.RecordBatch.from_arrays(
            [records, pa.array(np.zeros(n, bool)), pa.array([kind] * n, pa.string()), *[none] * (len(names) - 3 - len(kept)), *places], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, pending, head = None, 0, _Open(), None

        def unclosed() -> Iterator[pa.RecordBatch]:
            for lines in pending.taken() if whole and state else ():
                yield raw(lines.column("value"), UNCLOSED, [lines.column(c) for c in kept])

        for batch in _parts(batches):
            for here, start, end in _runs(batch, ("file", "block", "length")):
                if here != split:
                    yield from unclosed()
                    split, state, pending, head = here, 0, _Open(), None
                part = batch.slice(start, end - start)
                values = part.column("value")
                lines = _Lines(values)
                if whole:
                    head = lines.first_not_blank(part.column("line").to_numpy()) if head is None else head
                    part = part.append_column("head", pa.array([head] * len(part), pa.int64()))
                turned = lines.states(state)
                begins = lines.begins(turned)
                left, state, upto = state, int(turned[-1]), end - start
                if left:
                    pending.add(part.slice(0, int(begins[0]) if len(begins) else upto))
                    if len(begins) == 0 and state:
                        continue
                    held = list(pending.taken())
                    yield raw(_joined(pa.concat_arrays([x.column("value") for x in held])), None, [held[0].column(c).slice(0, 1) for c in kept])
                if state and len(begins):
                    upto, begins = int(begins[-1]), begins[:-1]
                    pending.add(part.slice(upto))
                if len(begins) == 0:
                    continue
                ends = lines.starts[np.r_[begins[1:], upto]] - 1
                taken = pa.array(begins)
                yield pa.RecordBatch.from_arrays(
                    [*_cells_of(lines, turned, lines.starts[begins], ends, width, cells, texts), *(part.column(c).take(taken) for c in kept)], names)
        yield from unclosed()

    return run


def _splits(lines: DataFrame) -> DataFrame:
    """One row a split, written out: the state it begins in and the one it leaves, where its first and last record begin,
    the record that runs into it, the one no quote closes, and where the file's header stands."""
    ship(lines.sparkSession)
    split = ["file", "block", "length"]
    ends = lines.select("value", *split, "line").mapInArrow(
        _ends, "file string, block long, length long, head long, from0 long, first0 long, begun0 long, from1 long, first1 long, begun1 long")
    turned = _with_states(ends, ["file"], "block", 0).withColumnRenamed("before0", "state")
    chosen = {c: F.when(F.col("state") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("first", "begun", "from")}
    turned = turned.select(*split, "state", chosen["first"].alias("first"), chosen["begun"].alias("begun"), chosen["from"].alias("left"),
                           F.when(F.col("block") == 0, F.struct("block", F.col("head").alias("line"))).alias("head"))
    turned = turned.withColumn("open", F.when(F.col("begun").isNotNull(), F.struct(F.col("block"), F.col("begun").alias("line"))))
    file = Window.partitionBy("file").orderBy("block")
    every = file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return written(turned.select(
        *split, "first", "begun", "left", ((F.col("state") == 1) | (F.col("left") == 1)).alias("cut"), F.last("open", ignorenulls=True).over(file.rowsBetween(Window.unboundedPreceding, -1)).alias("running"),
        # the record that the file ends in, if that is inside quotes
        F.when(F.last("left").over(every) == 1, F.last("open", ignorenulls=True).over(every)).alias("unclosed"),
        F.first("head", ignorenulls=True).over(every).alias("head")), "splits")


def records_of(lines: DataFrame, width: int = 0, *, cells: bool = True, texts: bool = True, whole: bool = False) -> DataFrame:
    """(record, done, kind, c0, c1, ..., file, at, head) of lines as ``lines_of`` gives them; ``at`` is where the record begins, ``head`` where the file's header does.

    The lines of a split are read in order by one task, so nothing of them travels:
    one pass finds what each split does from both states it may begin in; a small
    table, one row a split, then says in which one it does and where the record
    began that runs into it.  A second pass puts records together within their
    split.  Only the lines of a record that a split ends in are joined by where it
    began, in a pass of their own if some split cuts a record.  A quoted cell that no
    later quote closes is not gathered: its lines are records of kind "unclosed",
    one each.  Records with text after a closing quote are "malformed".

    Records that are ``done`` need no parser: they have their ``cells``, those of up to ``width``
    of them, and fewer make the kind "other width".  The text of such a record
    stands beside them if it is malformed, or is of another width and ``texts`` are
    wanted.  The others have their text and no cells, and a kind if their lines have one.

    Files that are read ``whole``, a split each, take one pass: the lines of an open
    record wait until it ends, or the file.
    """
    split = ["file", "block", "length"]
    columns = [f"c{k}" for k in range(width if cells else 0)]
    made = "record string, done boolean, kind string, " + "".join(f"{c} string, " for c in columns) + "file string, block long, line long, head long"
    zero = F.lit(0).cast("long").alias("block")
    shown = ["record", "done", "kind", *columns, "file", F.struct("block", "line").alias("at"), F.struct(zero, F.col("head").alias("line")).alias("head")]
    if whole:
        ship(lines.sparkSession)
        sure = lines.where(F.when(F.col("whole"), F.lit(True)).otherwise(F.raise_error(F.lit("a file was split that was to be read whole")).cast("boolean")))
        return _told(sure.select("value", *split, "line").mapInArrow(_put_together(width, cells, texts, True), made).select(*shown))
    table = _splits(lines).withColumn("known", F.lit(True))
    # told to be broadcast, since a join that shuffles or sorts would bring lines out of their order
    met = lines.join(F.broadcast(table), split, "left").where(F.coalesce("known", F.raise_error(F.lit("files or their splits changed while they were read")).cast("boolean")))
    tail = F.coalesce((F.col("left") == 1) & (F.col("line") >= F.col("begun")), F.lit(False))
    within = F.coalesce(F.col("line") >= F.col("first"), F.lit(False)) & ~tail
    records = met.where(within).select("value", *split, "line", F.col("head.line").alias("head")).mapInArrow(_put_together(width, cells, texts, False), made)
    # no split cuts a record: nothing to join, and Spark leaves this pass out
    cut = lines.join(F.broadcast(table.where("cut")), split).where(~within)
    cut = cut.select("value", *split, "line", "unclosed", "head", F.when(tail, F.struct("block", F.col("begun").alias("line"))).otherwise(F.col("running")).alias("at"))
    lost = F.col("unclosed").isNotNull() & (F.col("at") == F.col("unclosed"))
    cut = cut.withColumn("lost", lost).withColumn("at", F.when(F.col("lost"), F.struct("block", "line")).otherwise(F.col("at")))
    joined = cut.groupBy("file", "at", "head").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n").alias("record"),
        F.when(F.bool_or("lost"), F.lit(UNCLOSED)).alias("kind"))
    every_record = records.select(*shown).unionByName(joined.withColumns({"done": F.lit(False), **dict.fromkeys(columns, F.lit(None).cast("string"))}))
    return _told(every_record)


def _told(records: DataFrame) -> DataFrame:
    """Records with the kind of those that are not done: malformed, if not known yet."""
    told = F.when(~F.col("done") & F.col("kind").isNull() & malformed(F.col("record")), F.lit(MALFORMED)).otherwise(F.col("kind"))
    return records.withColumn("kind", told)
