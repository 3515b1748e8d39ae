"""Phrases, nearest neighbours and tokenizer alignment against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from indicatorlake.llm import alignment, neighbours, phrases
from indicatorlake.llm.queries import ALIGNED, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Phrases ---------------------------------------------------------------------

def plain_phrases(docs, best=2000, least=10):
    counts = defaultdict(lambda: (Counter(), Counter(), Counter()))
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(3):
                counts["und" if lang is None else lang][k].update(tuple(words[i : i + k + 1]) for i in range(len(words) - k))
    out = []
    for lang, by_size in counts.items():
        f = Counter()
        for c in by_size:
            f.update(c)
        n = sum(by_size[0].values())
        candidates = {p: a for k in (1, 2) for p, a in by_size[k].items() if a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in candidates.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def invented(seed, rows=300):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "É", "ß", "x" * 300, "New", "YORK", "city", "漢字", *(f"w{k}" for k in range(30))]
    fixed = ["new york City", "a a a a", "w1 w2 w3 w4", "b b", "ß 漢字 É"]
    out = []
    for _ in range(rows):
        words = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(25))]
        out.append(("".join(w + rng.choice([" ", " ", "\t", "  ", ", ", ".\n", "\r", "\x0b"]) for w in words), rng.choice(["en", "en", "de", None, ""])))
    return out + [(None, "en"), ("", None), (" \t\n", "fr"), ("only one", "xx"), *[("same text again here", "same")] * 12]


@pytest.mark.parametrize("best, least", [(2000, 10), (5, 3), (1, 10), (40, 2)])
def test_phrases_equal_a_plain_version(spark, best, least):
    docs = invented(best)
    extra = texts_of(spark, docs).withColumns({c: F.lit(1) for c in ("f", "phrase", "score", "rank", "edge", "doc_id")}).repartition(5)
    found = sorted(tuple(r) for r in phrases.collocations(extra, best=best, least=least).collect())
    assert found == plain_phrases(docs, best, least)


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(texts_of(spark, [("a b", "en")]).where("false")).count() == 0
    assert phrases.collocations(texts_of(spark, [("a b", "en")])).count() == 0


def test_phrases_go_on_until_the_last_place_is_settled(spark, monkeypatch):
    """With a short first reach several rounds are needed, and the rows are the same."""
    monkeypatch.setattr(phrases, "FIRST", 1)
    monkeypatch.setattr(phrases, "FURTHER", 2)
    docs = [("w1 w2 w3 " * 40, "en"), ("x y. " * 30 + "x. y. ", "en"), *invented(8, 150)]
    for best in (2, 7):
        found = sorted(tuple(r) for r in phrases.collocations(texts_of(spark, docs), best=best, least=3).collect())
        assert found == plain_phrases(docs, best, 3)


def test_scores_are_whole_number_arithmetic(spark):
    rows = [(a, left, right) for a, left, right in [(10**14, 10**14, 10**14), (10**14 - 1, 10**14, 10**14), (3, 7, 11), (999999999999, 10**12, 999999999999 + 5),
                                                    (10, 10**14, 10**14), (123456789012, 123456789013, 223456789012)]]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", phrases._score("a", "l", "r").alias("s"))
    for r in df.collect():
        assert r.s == 1000000 * r.a * r.a // (r.l * r.r)


def test_a_filter_misses_nothing(spark):
    rows = [("en", f"w{k} v{k % 7}") for k in range(3000)] + [("de", "a b c"), ("", "ß É"), ("und", "x" * 500)]
    held = phrases.Filter(phrases._filter(phrases._hashes(spark.createDataFrame(rows, "lang string, phrase string"))).value)
    import pyarrow as pa
    words, _, _ = phrases._split(pa.array([p for _, p in rows]))
    langs = phrases._language_hash(pa.array([lang for lang, _ in rows]))
    parts, first = words.hashes(), words.bounds
    one = np.array([phrases._joined(langs[k : k + 1], *(parts[i : i + 1] for i in range(first[k], first[k + 1])))[0] for k in range(len(rows))])
    assert held.holds(one).all() and held.holds(one * np.uint64(3)).mean() < 0.01


def test_no_stage_of_the_phrases_runs_two_python_steps(spark, monkeypatch):
    """Each would have a Python worker for every core, beside the other's."""
    plans, plain = [], DataFrame.toArrow

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    monkeypatch.setattr(DataFrame, "toArrow", noted)
    phrases.collocations(texts_of(spark, [("a b c a b c", "en")] * 3), best=5, least=2).count()
    stages = [stage for plan in plans for stage in plan.split("Exchange")]
    assert len(plans) >= 4 and sum("MapInArrow" in stage for stage in stages) >= 4
    assert max(stage.count("MapInArrow") for stage in stages) == 1



# Nearest neighbours ----------------------------------------------------------

VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("first", LongType())])


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def plain_neighbours(rows, every, nearest):
    usable = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = []
    for q, vector in usable:
        if q % every == 0:
            best = sorted((-product(vector, v), i) for i, v in usable if i != q)[:nearest]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_neighbours_on_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in rng.standard_normal(6)]) for k in range(120)]
    rows += [(1000 + k, rows[3][1]) for k in range(70)] + [(2000 + k, [-x for x in rows[5][1]]) for k in range(25)]  # hot vectors
    rows += [rows[0], (7, None), (8, []), (None, rows[1][1]), (60, [0.0] * 6), (63, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (66, [float("nan")] * 6),
             (69, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0]), (72, [-0.0, 1.0, -0.0, 0.0, 0.0, 0.0]), (75, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]), (-40, rows[9][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).repartition(4)
    found = sorted(tuple(r) for r in neighbours.nearest_neighbours(df, "vec_id % 20 = 0").collect())
    assert found == plain_neighbours(rows, 20, 20)
    assert neighbours.nearest_neighbours(df.where("false"), "vec_id % 20 = 0").count() == 0
    lone = neighbours.nearest_neighbours(df.where("vec_id = 20"), "vec_id % 20 = 0")
    assert lone.count() == 0
    short = [(0, [1.0, 2.0]), (1, [3.0]), (2, [0.0, 0.0, 5.0]), (20, [1.0, 1.0, 1.0])]
    found = sorted(tuple(r) for r in neighbours.nearest_neighbours(spark.createDataFrame([(i, v, 1) for i, v in short], VECTORS), "vec_id % 20 = 0").collect())
    assert found == [(0, 1, 1, 3.0), (0, 2, 20, 3.0), (0, 3, 2, 0.0), (20, 1, 2, 5.0), (20, 2, 0, 3.0), (20, 3, 1, 3.0)]


@pytest.mark.parametrize("pages", [8192, 300])
def test_neighbours_are_found_by_nine_in_ten(spark, monkeypatch, pages):
    """On the given table; with small pages too, all of which are entered and whose parts meet every query."""
    monkeypatch.setattr(neighbours, "PAGE_ROWS", pages)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 10 if pages == 300 else neighbours.QUERY_ROWS)
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    found = [tuple(r) for r in QUERIES["op12_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect()]
    matrix = np.array([v for _, v in rows])
    at = {i: k for k, (i, _) in enumerate(rows)}
    truth = {}
    for i in at:
        if i % 20 == 0:
            scores = matrix @ matrix[at[i]]
            scores[at[i]] = -np.inf
            truth[i] = {rows[k][0] for k in np.argsort(-scores)[:20]}
    assert len(found) == 20 * len(truth) and Counter(r[1] for r in found) == {k: len(truth) for k in range(1, 21)}
    hits = sum(vec in truth[q] for q, _, vec, _ in found)
    assert hits >= 0.9 * len(found)
    by_query = defaultdict(list)
    for q, rank, vec, score in found:
        assert score == product(rows[at[q]][1], rows[at[vec]][1]) and q != vec
        by_query[q].append((rank, -score, vec))
    for answers in by_query.values():
        assert [a[1:] for a in sorted(answers)] == sorted(a[1:] for a in answers)


def test_a_queue_enters_leaves_from_near_to_far():
    points = np.random.default_rng(2).standard_normal((500, 8))
    forest = [neighbours.plant(points, 20, np.random.default_rng(k)) for k in range(3)]
    for tree in forest:
        assert sorted(np.concatenate(tree.leaves)) == list(range(500)) and max(map(len, tree.leaves)) <= 20
    margins = [(points[0] @ t.normals.T - t.cuts).tolist() for t in forest]
    order = list(neighbours.entered(forest, margins, 10**9, lambda t, leaf: len(forest[t].leaves[leaf])))
    assert len(order) == len(set(order)) == sum(len(t.leaves) for t in forest)
    assert all(0 in forest[t].leaves[leaf] for t, leaf in order[:3])  # its own leaf of every tree comes first


# Alignment -------------------------------------------------------------------

def plain_alignment(docs):
    both = alignment.pair(*map(public_tokenizers.path, ALIGNED))
    library = alignment._by_its_library(public_tokenizers.path(ALIGNED[0]))
    rows, links = [], Counter()
    for i, text in docs:
        a = library([" " + (text or "")])[0]
        b = both.b.encode(text or "")
        spelled = [[both.a_bytes[k].as_py() for k in a], [both.b_bytes[k].as_py() for k in b]]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            rows.append((i, [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(s) for s in side]).tolist() for side in spelled)
        common = sorted(set(ends_a) & set(ends_b))
        groups = []
        before = 0
        for end in common:
            groups.append(([k for k, e in zip(a, ends_a) if before < e <= end], [k for k, e in zip(b, ends_b) if before < e <= end]))
            before = end
        pairs = [(x[-1], y[-1]) for x, y in groups]
        links.update(pairs)
        rows.append((i, a, b, groups))
    best = Counter()
    for (x, y), n in links.items():
        best[y] = max(best[y], n)
    out = []
    for i, a, b, groups in rows:
        pairs = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(groups), sum(links[p] == best[p[1]] for p in pairs), sum(links[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def test_alignment_equals_a_plain_version(spark, make_docs, awkward, monkeypatch):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 4000]
    docs = awkward + given[:60] + [(70, "a▁b"), (71, "x<|endoftext|>y <s> é 漢字 😀"), (72, "<0x41> \u0000 \n\n\t"), (73, "many   blanks   "), (74, "x" * 3000)]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 3000)
    df = make_docs(docs).withColumns({c: F.lit(1) for c in ("block", "links", "answers", "a", "count")}).repartition(3)
    found = sorted((tuple(r) for r in alignment.align(df, ["doc_id"], *map(public_tokenizers.path, ALIGNED)).collect()), key=repr)
    assert found == plain_alignment(docs)
    assert alignment.align(df.where("false"), ["doc_id"], *map(public_tokenizers.path, ALIGNED)).count() == 0


def test_both_encoders_of_a_agree(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text]
    texts += [f"a{chr(c)}a1{chr(c)}1!{chr(c)}! {chr(c)}{chr(c)} x  {chr(c)}  y'{chr(c)}" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts += ["a" * 500, "aab" * 300, "\n" * 50 + " " * 50, "<|endoftext|>"]
    path = public_tokenizers.path(ALIGNED[0])
    assert alignment.pair(path, public_tokenizers.path(ALIGNED[1])).encode_a(texts) == alignment._by_its_library(path)(texts)


def test_keys_named_like_results(spark, make_docs):
    df = make_docs([(1, "one two"), (2, None)]).withColumnRenamed("doc_id", "n_a")
    out = alignment.align(df, ["n_a", "text"], *map(public_tokenizers.path, ALIGNED))
    assert out.columns == ["key_n_a", "text", *alignment.RESULTS]
    assert {(r.key_n_a, r.text, r.n_b > 0) for r in out.collect()} == {(1, "one two", True), (2, None, False)}


def test_alignment_rows_stay_small_in_a_jvm(spark, make_docs):
    """A row of half a megabyte and more gets regions of the heap of its own; a reader holds a whole file of rows at a time."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    docs = make_docs([" ".join(rng.choices(words, k=300)) for _ in range(1200)]).coalesce(1)
    paths = [*map(public_tokenizers.path, ALIGNED)]
    blocks = alignment._blocks(docs, ["doc_id"], "text", *paths).collect()
    assert sum(len(r.key_0) for r in blocks) == 1200 and len(blocks) > 2
    for r in blocks:
        links = len(r.links) if isinstance(r.links, (bytes, bytearray)) else 4 * len(r.links)
        assert links + 64 * len(r.sha) + 8 * 4 * len(r.n_a) + 16 * len(r.n) < 1 << 19


def test_packed_links_are_the_same(spark):
    for pairs in (1, 1 << 16, (1 << 16) + 1):
        links = np.array([0, pairs - 1, 0, pairs // 2], np.int32)
        assert alignment._unpacked(alignment._packed(links, pairs), 4).tolist() == links.tolist()
    assert len(alignment._unpacked(alignment._packed(np.zeros(0, np.int32), 0), 0)) == 0


def test_large_rows_are_written_to_bounded_files(spark):
    from indicatorlake.session import written

    assert len(written(spark.range(100).coalesce(1), "bounded", 30).inputFiles()) == 4
    assert len(written(spark.range(100).coalesce(1), "unbounded").inputFiles()) == 1
