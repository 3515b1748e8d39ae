"""The pipeline's stages on awkward rows, and its rows against a plain version."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from indicatorlake.llm import leaks, quality, subwords

from . import brute
from .test_operators import ordered, spread

SF = "/root/testdata/sf0.001"


def test_registered():
    assert contract.queries()["pipeline"] is pipeline.run
    assert len([q for q in contract.queries() if re.match(r"op\d+_", q)]) == 13


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stage_takes_awkward_rows(spark, make_docs, awkward, name, stage):
    docs = make_docs(awkward).withColumns({"found": F.lit(1), "mark": F.lit(2), "at": F.lit(3), "none": F.lit(4), "rows": F.lit(5)})
    out = stage(spark, docs, SF)
    out.write.format("noop").mode("overwrite").save()
    if stage is not pipeline.STAGES[-1][1]:
        assert out.columns == pipeline.COLUMNS
    assert stage(spark, docs.where("false"), SF).count() == 0


def shingles(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x.encode()) for x in brute.words(text)]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def near(docs):
    """For every place the smallest id reachable over texts that are alike; null counts as largest."""
    sets, label = [shingles(t) for _, t in docs], list(range(len(docs)))
    for k in range(len(docs)):
        for j in range(k):
            if label[k] != label[j] and alike(sets[k], sets[j]):
                old, new = label[k], label[j]
                label = [new if x == old else x for x in label]
    return [min((docs[k][0] for k in range(len(docs)) if label[k] == x and docs[k][0] is not None), default=None) for x in label]


def test_near_copies_keep_one_row(spark, make_docs, awkward):
    kept = [(r.doc_id, r.text) for r in pipeline.drop_near_copies(spark, make_docs(awkward), SF).collect()]
    assert ordered(i for i, _ in kept) == ordered(set(near(awkward)))
    assert {t for i, t in kept if i == 5} == {dict(awkward)[5]}


def plainly(docs, items):
    """What the stages keep and make, one document after another."""
    docs = [(i, t) for i, t in docs if not brute.quality(t)[-1] and quality._measured(pa.array([t]))["kept"][0]]
    docs = [d for d, label in zip(docs, near(docs)) if d[0] == label]
    hashes = spread(items)
    clean = []
    for (i, t), text in zip(docs, spread([t for _, t in docs])):
        if all(brute.edit_distance_inside(h, text) > len(h) * leaks.EDIT_PERCENT // 100 for h in hashes if set(h) & set(text)):
            clean.append((i, t))
    return clean


def test_rows_equal_a_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = dict(plainly(docs, items))
    found = pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(expected)
    assert 100 < len(found) < len(docs)
    model = subwords.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for r in found:
        text, spans = expected[r.doc_id], brute.personal(expected[r.doc_id])
        restored = model.decode(r.ids)
        if not spans and "token =" not in text:
            assert restored == text
        for kind, start, end in spans:
            assert text[start:end] not in restored or kind == "ip"
        assert r.n_pieces == len(r.ids) and r.restored
    masked = "".join(model.decode(r.ids) for r in found)
    assert "[EMAIL]" in masked and not re.search(brute.PII["email"], masked)


def test_near_copies_of_four_fifths_of_their_shingles_are_linked(spark, make_docs):
    rng = random.Random(12)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for family in range(12):
        base = [f"f{family}w{rng.randrange(500)}" for _ in range(rng.choice([40, 150, 400]))]
        for _ in range(12):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randrange(1 + len(words) // 30)):
                words[at] = f"new{rng.randrange(99999)}"
            docs.append((10000 + len(docs), " ".join(words)))
    docs += [(20000 + k, t) for k, t in enumerate(["a b c", "A  b c", "a b", "", None, "a b c d e", "a b c d e f"])]
    sets = [shingles(t) for _, t in docs]
    labels = list(range(len(docs)))
    pairs = 0
    for k in range(len(docs)):
        for j in range(k):
            if alike(sets[k], sets[j]):
                pairs += bin(brute.fingerprint(docs[k][1]) ^ brute.fingerprint(docs[j][1])).count("1") > 2
                old, new = labels[k], labels[j]
                labels = [min(old, new) if x in (old, new) else x for x in labels]
    assert pairs > 50  # beyond the two bits of op7
    kept = [r.doc_id for r in pipeline.drop_near_copies(spark, make_docs(docs), SF).collect()]
    assert sorted(kept) == sorted(docs[x][0] for x in set(labels))
