"""Cross-tokenizer alignment: where the tokens of two vocabularies end together, and which of them meet most."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatorlake.session import written

from .common import chunks, ship
from .tokens import _byte_letters

#: Bytes of text whose pairs of ids are counted together before Spark merges the counts.
BLOCK_BYTES = 1 << 19
#: Blocks of a stored file: a reader holds all rows of one at a time, and a writer too.
FILE_BLOCKS = 32
#: Fixed value: how byte-level files of this kind cut a text before any merge.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

_loaded: dict[tuple[str, str], Pair] = {}


class Pair:
    """Both tokenizers, and for every id of each its bytes.

    A is read from its file and run by tiktoken, which takes its merges as ranks; on
    every code point, in all surroundings the pattern knows, both libraries agree.  A
    file of another kind is run by the library it was written for.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = {letter: value for value, letter in enumerate(_byte_letters())}
        entries = {i: bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
                   for entry, i in {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}.items()}
        self.encode_a = _by_ranks(spec, entries) or _by_its_library(a_path)
        self.a_bytes = pa.array([entries.get(i, b"") for i in range(max(entries) + 1)], pa.large_binary())
        self.b_bytes = pa.array([self._piece(i) for i in range(self.b.get_piece_size())], pa.large_binary())
        digits = max(len(self.a_bytes), len(self.b_bytes))
        #: the decimals of id i before "," "|" ";" and nothing, at 4 i + 0..3
        self.written = pa.array([f"{i}{mark}" for i in range(digits) for mark in (",", "|", ";", "")], pa.large_string())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encoded(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        return _lists(self.encode_a([" " + t for t in texts])), _lists(self.b.encode(texts, num_threads=1))


def _by_ranks(spec: dict, entries: dict[int, bytes]):
    """An encoder for a byte-level file whose ids stand in the order of its merges; None for other files."""
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    ids = model["vocab"]
    made = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if spec["normalizer"] or any(split.get(k) != v for k, v in plain.items()) or made != list(range(256, 256 + len(made))):
        return None
    import tiktoken

    ranks = {entries[i]: i for i in range(256 + len(made))}
    coder = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [coder.encode_ordinary(t) for t in texts]


def _by_its_library(path: str):
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def pair(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Pair(a_path, b_path)
    return _loaded[a_path, b_path]


def _lists(ids: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    flat = np.fromiter((i for row in ids for i in row), np.int32, int(ends[-1]))
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat))


def _large(values: pa.Array | pa.ChunkedArray) -> pa.Array:
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


def _spelled(ids: pa.Array, entries: pa.Array) -> pa.Array:
    """The joined bytes of every list of ids."""
    parts = _large(entries.take(ids.flatten()))
    at = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1] if len(parts) else np.zeros(1, np.int64)
    offsets = at[ids.offsets.to_numpy()]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), parts.buffers()[2] or pa.py_buffer(b"")])


def _ends(ids: pa.Array, entries: pa.Array, first: int) -> pa.Table:
    """A row for every token: its document (counted from ``first``), the offset of its end in it, its id and place."""
    flat, parents = ids.flatten(), pc.list_parent_indices(ids)
    sizes = pc.binary_length(entries).take(flat)
    running = pc.cumulative_sum(sizes.cast(pa.int64()))
    before = np.r_[0, running.to_numpy()][ids.offsets.to_numpy()[:-1]]
    return pa.table({"doc": parents, "end": pc.subtract(running, pa.array(before).take(parents)), "id": flat,
                     "at": pa.array(np.arange(first, first + len(flat)))})


def _groups_text(a: pa.Array, b: pa.Array, a_at: np.ndarray, b_at: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The groups of all documents in one string, and where each document ends in it.

    ``a_at`` and ``b_at`` are the places of the tokens that close a group, ascending;
    a group's A ids are written, then its B ids.
    """
    groups = len(a_at)
    of_a = np.searchsorted(a_at, np.arange(len(a.flatten())))
    of_b = np.searchsorted(b_at, np.arange(len(b.flatten())))
    upto_a, upto_b = a_at + 1, np.r_[0, b_at + 1]  # tokens of A up to a group's end, of B before a group
    place_a = np.arange(len(of_a)) + upto_b[of_a]
    place_b = np.arange(len(of_b)) + upto_a[of_b]
    code_a = a.flatten().to_numpy().astype(np.int64) * 4
    code_b = b.flatten().to_numpy().astype(np.int64) * 4
    code_a[a_at] += 1
    code_b[b_at] += 2
    last = b.offsets.to_numpy()[1:]
    last = last[np.diff(b.offsets.to_numpy()) > 0] - 1
    code_b[last] += 1  # a document's last group ends without a mark
    codes = np.empty(len(code_a) + len(code_b), np.int64)
    codes[place_a], codes[place_b] = code_a, code_b
    parts = _large(words.take(pa.array(codes)))
    assert groups == len(b_at)
    offsets = np.frombuffer(parts.buffers()[1], np.int64)[: len(parts) + 1] if len(parts) else np.zeros(1, np.int64)
    return offsets[a.offsets.to_numpy() + b.offsets.to_numpy()], parts


def _aligned(texts: pa.Array, both: Pair) -> dict:
    """Figures of every text of a block, its links as places in the block's table of id pairs, and that table with counts."""
    texts = pc.fill_null(texts, "")
    a, b = both.encoded(texts.to_pylist())
    wanted = _large(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.cast(pa.large_string()), pa.scalar(" ", pa.large_string())))
    wanted = wanted.cast(pa.large_binary())
    whole = pc.and_(pc.and_(pc.equal(_spelled(a, both.a_bytes), wanted), pc.equal(_spelled(b, both.b_bytes), wanted)),
                    pc.greater(pc.binary_length(texts), 0))
    if not pc.all(whole, min_count=0).as_py():
        none = pa.scalar([], a.type)
        a, b = pc.if_else(whole, a, none), pc.if_else(whole, b, none)
        a, b = (pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(pc.list_value_length(x).to_numpy())]), x.flatten()) for x in (a, b))
    met = _ends(a, both.a_bytes, 0).join(_ends(b, both.b_bytes, 0), ["doc", "end"], join_type="inner", left_suffix="_a", right_suffix="_b", use_threads=False)
    met = met.sort_by("at_a")  # ends ascend within a document, so the places of both sides do
    a_at, b_at = met["at_a"].to_numpy(), met["at_b"].to_numpy()
    ends, written_groups = _groups_text(a, b, a_at, b_at, both.written)
    data = memoryview(written_groups.buffers()[2] or b"")
    links = np.searchsorted(met["doc"].to_numpy(), np.arange(len(texts) + 1))
    coded = _large(pc.dictionary_encode(pc.add(pc.multiply(met["id_a"].cast(pa.int64()), pa.scalar(1 << 32, pa.int64())), met["id_b"].cast(pa.int64()))))
    counted = pa.table({"pair": coded.indices}).group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by("pair")
    pairs = coded.dictionary.to_numpy()
    return {"n_a": np.diff(a.offsets.to_numpy()), "n_b": np.diff(b.offsets.to_numpy()), "n_links": np.diff(links),
            "sha": ["" if low == high else hashlib.sha256(data[low:high]).hexdigest() for low, high in zip(ends[:-1], ends[1:])],
            "links": coded.indices.to_numpy(), "a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "n": counted["pair_count"].to_numpy()}


def _packed(links: np.ndarray, pairs: int) -> bytes:
    """Places in a table of pairs, compressed: a block's row stays far below the size from which a JVM gives an object regions of its own."""
    kind = np.uint16 if pairs <= 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + pa.compress(links.astype(kind).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    size = packed[0]
    return np.frombuffer(pa.decompress(packed[1:], n * size, codec="zstd", asbytes=True), f"u{size}")


def _blocks(docs: DataFrame, keys: list[str], text: str, a_path: str, b_path: str) -> DataFrame:
    """A row for every block of texts: its documents with their figures, its links, and its pairs of ids with their counts."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = [f"key_{k}" for k in range(len(keys))]
    plain = docs.select(*[docs[c].alias(n) for c, n in zip(keys, names)], docs[text].alias("text"))
    schema = "block long, " + "".join(f"{n} array<{kinds[c]}>, " for c, n in zip(keys, names)) + (
        "n_a array<long>, n_b array<long>, n_links array<long>, sha array<string>, links binary, a array<int>, b array<int>, n array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in chunks(batch, "text", BLOCK_BYTES):
                found = _aligned(part.column("text"), both)
                lists = [part.column(n) for n in names] + [
                    pa.array(found[n], kind) for n, kind in (("n_a", pa.int64()), ("n_b", pa.int64()), ("n_links", pa.int64()), ("sha", pa.string()),
                                                             ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()))]
                listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
                listed.insert(-3, pa.array([_packed(found["links"], len(found["a"]))], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), *listed], ["block", *names, "n_a", "n_b", "n_links", "sha", "links", "a", "b", "n"])
                del found, lists, listed  # else they stay beside the next block's
                pa.default_memory_pool().release_unused()
                block += 1

    return plain.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): how many links of all documents hold a pair of ids, and whether no other A id meets that B id more often."""
    held = blocks.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    counts = written(held.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, keys: list[str], a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Per row its keys, the token counts of both vocabularies, groups, links, and how the links stand among those of all rows.

    A (a tokenizers file) reads a space and the text, B (a sentencepiece model) the
    text.  Where tokens of both end at one byte a group ends, and the two tokens are
    linked; ``count_sum`` sums, over a row's links, how many links of all rows hold
    the same two ids, ``n_best`` counts the links whose A id is, ties included, the
    one their B id meets most.  ``groups_sha256`` is the hash of the groups written
    as ``a1,a2|b1;a3|b2,b3``.

    Texts are encoded once, in blocks of ``BLOCK_BYTES`` (a longer text is a block of
    its own, whole).  A block counts its pairs of ids; Spark sums these tables, each
    pair at most once a block, so that no pair is hot, and hands every block the
    counts of its pairs.  Rows that are null, empty, or that one of the tokenizers
    does not spell back have zeros and an empty hash, and give no links; equal rows
    count each.  Other columns of ``docs`` are not read; a key named like a result
    comes back as ``key_<name>``.  An empty table gives no rows.
    """
    ship(docs.sparkSession)
    blocks = written(_blocks(docs, keys, text, a_path, b_path), "alignment", FILE_BLOCKS)
    counts = written(pair_counts(blocks), "pairs")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("block", "at", "p.a", "p.b")
    answers = asked.join(counts, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("answers"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = [f"key_{k}" for k in range(len(keys))]
    joined = blocks.select("block", *names, "n_a", "n_b", "n_links", "sha", "links").join(answers, "block", "left")
    figures = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n).slice(k, 1).flatten() for n in batch.schema.names if n not in ("block", "links")}
                n_links, answer = row["n_links"].to_numpy(), row["answers"]
                links = _unpacked(batch.column("links")[k].as_py(), int(n_links.sum()))
                count, best = np.zeros(len(answer), np.int64), np.zeros(len(answer), np.int64)
                if len(answer):
                    at = answer.field("at").to_numpy()
                    count[at] = answer.field("count").to_numpy()
                    best[at] = answer.field("best").to_numpy(zero_copy_only=False)
                ends = np.r_[0, np.cumsum(n_links)]
                sums = [np.r_[0, np.cumsum(x[links])][ends] for x in (best, count)]
                yield pa.RecordBatch.from_arrays(
                    [*(row[n] for n in names), row["n_a"], row["n_b"], row["n_links"], row["n_links"],
                     *(pa.array(np.diff(s), pa.int64()) for s in sums), row["sha"]], [*names, *RESULTS])

    out = joined.mapInArrow(run, "".join(f"{n} {kinds[c]}, " for c, n in zip(keys, names)) + figures)
    return out.select(*[F.col(n).alias(f"key_{c}" if c in RESULTS else c) for c, n in zip(keys, names)], *RESULTS)
