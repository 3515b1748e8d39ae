"""Long texts that a sum of powers takes for equal are told apart."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline as pipeline
from indicatorlake.llm import leaks, nearcopies, quality, repeats
from indicatorlake.llm.common import spans_hash

from . import brute


def half_and_complement(size):
    """Two texts of a and b, each half the complement of the half before it; their difference sums to 0 modulo 2**64."""
    one = "a"
    while len(one) < size:
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [64, 128, 256, 512, 1024, 4096])
def test_hashes_of_long_spans_differ(size):
    one, other = (np.frombuffer(t.encode(), np.uint8) for t in half_and_complement(size))
    both = np.concatenate([one, other, one])
    hashes = spans_hash(both, np.array([0, size, 2 * size]), np.array([size, 2 * size, 3 * size]))
    assert hashes[0] == hashes[2] != hashes[1]


def test_lines_and_words_of_quality_rules(spark, make_docs):
    one, other = half_and_complement(1024)
    docs = [(0, f"{one}\n{other}"), (1, f"{one}\n{one}"), (2, " ".join(["a b c d"] + [one, other, "e f g h"] * 2)), (3, " ".join([one, "x"] * 5 + [other, "x"] * 5))]
    for r in quality.measure(make_docs(docs), ["doc_id"]).collect():
        assert tuple(r)[1:7] == brute.quality(dict(docs)[r.doc_id])


def test_lines_equal_in_hash_only(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(quality, "spans_hash", lambda values, starts, ends: np.zeros(len(starts), np.uint64))
    text = "p\nq\np\nr\nq\np"
    assert quality._measured(pa.array([text, "p\nq"]))["n_dup_lines"].tolist() == [3, 0]


def test_windows_of_substring_dedup(spark, make_docs):
    one, other = half_and_complement(2048)
    words = [f"w{k}" for k in range(34)]
    docs = [(0, " ".join([*words[:20], one, *words[20:]])), (1, " ".join([*words[:20], other, *words[20:]])), (2, " ".join([*words[:20], one, *words[20:], "end"]))]
    found = {r.doc_id: (r.n_words, r.n_removed) for r in repeats.remove_repeats(make_docs(docs)).collect()}
    assert found == {0: (35, 35), 1: (35, 0), 2: (36, 35)}


def test_items_and_near_copies(spark, make_docs):
    one, other = half_and_complement(1024)
    words = " ".join(f"w{k}" for k in range(8))
    items = spark.createDataFrame([(1, f"{words} {one}")], "item_id long, text string")
    docs = [(0, f"start {words} {one} end"), (1, f"{one}"), (2, f"{other}"), (3, f"{one}")]
    found = {r.doc_id: [x.distance for x in r.leaks] for r in leaks.find_leaks(make_docs(docs), items, ["doc_id"]).collect()}
    assert found[0] == [0] and not found[2]
    roots = {r.doc_id: r.root for r in nearcopies.groups(make_docs(docs), ["doc_id"]).collect()}
    assert roots[1] == roots[3] != roots[2]
    kept = {r.doc_id for r in pipeline.drop_near_copies(spark, make_docs(docs), "").collect()}
    assert kept == {0, 1, 2}
