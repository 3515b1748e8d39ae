"""The operators against plain versions, on awkward rows and on the smallest driver tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from indicatorlake.llm import leaks, licenses, pii, quality, quotes, repeats, shards, simhash, subwords, tokens
from indicatorlake.llm.common import components, repeated, spans_hash, text_bytes, windows, words_of

from . import brute

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def rows(df):
    return [tuple(r) for r in df.collect()]


def ordered(found):
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def sample(spark, awkward):
    """Awkward rows and whole documents of the smallest table."""
    docs = [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return awkward + docs


def test_words_and_hashes_of_array_slices():
    texts = pa.array(["a b", None, "", "ab", " a b a b "]).slice(1)
    w = words_of(texts)
    data, _ = text_bytes(texts)
    assert [bytes(data[s:e]).decode() for s, e in zip(w.starts, w.ends)] == ["ab", "a", "b", "a", "b"]
    assert np.diff(w.bounds).tolist() == [0, 0, 1, 4]
    h = w.hashes()
    assert h[1] == h[3] and h[2] == h[4] and len(set(h.tolist())) == 3
    pairs = windows(h, 2)
    assert pairs[1] == pairs[3] and repeated(pairs).tolist() == [False, True, False, True]
    assert spans_hash(data, np.array([0]), np.array([2]))[0] == h[0]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)] + [(200, k) for k in range(201, 260)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(rows(components(df, "a", "b")))
    assert found == {**{k: 0 for k in range(41)}, 100: 90, 90: 90, 95: 90, **{k: 200 for k in range(200, 260)}}
    assert rows(components(df.where("a < 0"), "a", "b")) == []


def test_quality(spark, make_docs, sample):
    found = quality.measure(make_docs(sample), ["doc_id"]).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert ordered((r.doc_id, *(r[n] for n in names)) for r in found) == ordered((i, *brute.quality(t)) for i, t in sample)
    texts = dict(sample)
    for r in found:
        if r.doc_id is not None and r.doc_id != 6:
            assert r.coverage_4 == pytest.approx(brute.coverage(texts[r.doc_id], 4))
            assert not (r.base_failed and r.kept)
    assert quality.measure(make_docs([]), ["doc_id"]).count() == 0


def test_quality_lines_of_many_texts():
    texts = ["a b\nc\na b\n", "", "x\n\n \nx", None, "\na b\n", "é é\né é"]
    assert quality._measured(pa.array(texts))["n_dup_lines"].tolist() == [1, 0, 1, 0, 0, 1]


def test_golay_code_is_perfect_and_keys_meet():
    near, far = simhash._patterns()
    weights = [bin(x).count("1") for x in near.tolist()]
    assert Counter(weights) == {0: 1, 1: 23, 2: 253, 3: 1771} and ((far >= 0).sum(1) == np.where(np.array(weights) == 3, 5, 0)).all()
    rng = np.random.default_rng(1)
    prints = rng.integers(-(1 << 63), (1 << 63) - 1, 300)
    for flips in range(3):
        other = prints.copy()
        for k in range(len(other)):
            for bit in rng.choice(64, flips, replace=False):
                other[k] ^= np.int64(-(1 << 63)) if bit == 63 else np.int64(1 << int(bit))
        row, key, nearest = simhash.keys_of(prints)
        row2, key2, _ = simhash.keys_of(other)
        mine, theirs = {(r, k) for r, k, n in zip(row, key, nearest) if n}, set(zip(row2, key2))
        assert {r for r, _ in mine & theirs} == set(range(len(prints)))


@pytest.mark.parametrize("bucket", [simhash.PAIR_BUCKET, 1])
def test_simhash_groups(spark, make_docs, sample, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "PAIR_BUCKET", bucket)  # 1: all links by shared neighbour points
    near = [(5000 + k, " ".join(f"word{j}" for j in range(300) if j != 7 * k)) for k in range(20)]
    docs = sample + near
    found = simhash.groups(make_docs(docs), ["doc_id"]).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")), "component_id")
    prints = [brute.fingerprint(t) for _, t in docs]
    labels = brute.grouped(prints, [i for i, _ in docs], 2)
    assert ordered(rows(found)) == ordered((i, f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, labels))
    assert len({c for (i, _), c in zip(docs, labels) if i and i >= 5000}) < 20
    assert simhash.groups(make_docs([]), ["doc_id"]).count() == 0


def copies():
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(60)]
    out = []
    for d in range(60):
        own = [f"d{d}w{rng.randrange(999)}" for _ in range(rng.randrange(5, 90))]
        at = rng.randrange(len(own))
        cut = passage[rng.randrange(12) : rng.randrange(40, 60)]
        out.append(" ".join(own[:at] + cut + own[at:]))
    return out + ["x " * 80, "y " * 35, "z " * 36, out[3], out[3] + " more", " ".join(["q"] * 34 + passage[:35])]


@pytest.mark.parametrize("crowded", [repeats.CROWDED, 2])
def test_repeats(spark, make_docs, sample, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    monkeypatch.setattr(repeats, "SHARD_CONTEXTS", 50)
    docs = sample + [(9000 + k, t) for k, t in enumerate(copies())]
    found = repeats.remove_repeats(make_docs(docs)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert ordered(rows(found)) == ordered((i, *r) for (i, _), r in zip(docs, brute.removed([t for _, t in docs], repeats.WINDOW)))
    assert repeats.remove_repeats(make_docs([])).count() == 0


def test_a_passage_common_to_many_texts_is_no_group_of_rows(spark, make_docs, monkeypatch, tmp_path):
    rng = random.Random(13)
    passage = [f"p{k}" for k in range(60)]
    docs = [" ".join([f"d{rng.randrange(10**6)}" for _ in range(40)] + passage + [f"e{rng.randrange(10**6)}" for _ in range(40)]) for _ in range(700)]
    matched, folder = repeats._matched, str(tmp_path)

    def counting(window):
        inner = matched(window)

        def run(shard):
            import collections
            import uuid

            windows_ = collections.Counter(tuple(w[k : k + window]) for w in map(list, shard["words"]) for k in range(len(w) - window + 1))
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                file.write(str(max(windows_.values(), default=0)))
            return inner(shard)

        return run

    monkeypatch.setattr(repeats, "_matched", counting)
    found = repeats.remove_repeats(make_docs(docs)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert ordered(rows(found)) == ordered((i, *r) for i, r in enumerate(brute.removed(docs, repeats.WINDOW)))
    assert max([0, *(int(f.read_text()) for f in tmp_path.iterdir())]) <= repeats.CROWDED


def test_suffix_automaton_counts():
    rng = random.Random(5)
    texts = [([rng.randrange(3) for _ in range(rng.randrange(1, 30))], rng.randrange(1, 4)) for _ in range(12)]
    automaton = repeats.SuffixAutomaton()
    for t, n in texts:
        automaton.add(t, n)
    automaton.finish()
    counts = Counter()
    for t, n in texts:
        for a in range(len(t)):
            for b in range(a + 1, len(t) + 1):
                counts[tuple(t[a:b])] += n
    for t, _ in texts:
        for times in (2, 5):
            expected = [max((e - s for s in range(e) if counts[tuple(t[s:e])] >= times), default=0) for e in range(1, len(t) + 1)]
            assert automaton.statistics(t, times) == expected


def test_token_counts(spark, make_docs, sample):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    rng = random.Random(2)
    letters = "abcdeflmnrstv'’ \n\t#!?.,0123456789éÉßİΣσς漢字𝛑́ \u0085​\x1c|<>_- "
    odd = [(20000 + k, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for k in range(400)]
    odd += [(30000, "aaaaaaaaaaaaaaaaaaaaaaaaa!!!!!!!!!!!!!!!!!"), (30001, "a<|startoftext|>b<|endoftext|><|endoftext|>"), (30002, "he'll WE'VE it's"),
            (30003, "x" * 30000 + "é" * 5000 + "=" * 9999)]
    docs = sample + odd
    found = tokens.count_tokens(make_docs(docs), ["doc_id"], BPE)
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in docs]
    assert ordered(rows(found)) == ordered((*e, e[2] > 2048) for e in expected)
    assert tokens.count_tokens(make_docs([]), ["doc_id"], BPE).count() == 0


def spread(texts):
    words = [leaks.words_of(leaks.folded(pa.array([t])), leaks.SEPARATORS).hashes().view(np.int64).tolist() for t in texts]
    return words


def test_leaks(spark, make_docs, sample):
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(6)) for _ in range(rng.randrange(3, 40)))) for k in range(30)]
    items += [(30, None), (None, "nothing at all has this id"), (31, ""), (31, items[0][1])]
    docs = list(sample)
    for d in range(150):
        words = items[rng.randrange(30)][1].split()
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.randrange(2)] = ["noise"] * rng.randrange(2)
        docs.append((7000 + d, "Before it, " + ", ".join(words).upper() + " -- after it " * 3))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    hashes = dict(zip((i for i, _ in items if i is not None), spread([t or "" for i, t in items if i is not None])))
    for (i, t), text in zip(docs, spread([t or "" for _, t in docs])):
        found = []
        for item, words in hashes.items():
            if len(words) >= leaks.LEAST_WORDS:
                distance = brute.edit_distance_inside(words, text)
                if distance <= len(words) * leaks.EDIT_PERCENT // 100:
                    found.append((item, distance))
        expected.setdefault(i, []).append(found)
    for bytes_ in (leaks.BLOCK_BYTES, 2000):
        found = leaks.find_leaks(make_docs(docs), benchmark, ["doc_id"], block_bytes=bytes_).collect()
        assert len(found) == len(docs)
        got = {}
        for r in found:
            got.setdefault(r.doc_id, []).append([(x.item, x.distance) for x in r.leaks])
        assert {k: ordered(v) for k, v in got.items()} == {k: ordered(v) for k, v in expected.items()}
    assert sum(bool(f) for v in expected.values() for f in v) > 50
    assert leaks.find_leaks(make_docs([]), benchmark, ["doc_id"]).count() == 0
    none = leaks.find_leaks(make_docs(docs[:9]), benchmark.where("item_id < 0"), ["doc_id"]).collect()
    assert len(none) == 9 and not any(r.leaks for r in none)


def check_shards(found, docs, n):
    assert ordered((r.doc_id, r.size, r.text_crc32) for r in found) == ordered((i, len((t or "").encode()) + 1, brute.crc(t)) for i, t in docs)
    for s in range(n):
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots)))
    return [sum(r.size for r in found if r.shard == s) for s in range(n)]


def test_shards(spark, make_docs, sample):
    check_shards(shards.shard_by_bytes(make_docs(sample), 8).collect(), sample, 8)
    rng = random.Random(6)
    docs = [(k, "x" * rng.randrange(200)) for k in range(3000)] + [(5000 + k, "copy of a text, of which there are many") for k in range(1500)]
    found = shards.shard_by_bytes(make_docs(docs), 8).collect()
    sizes = check_shards(found, docs, 8)
    assert max(sizes) - min(sizes) <= 600
    few = [(k, "abc" * k) for k in range(3)]
    check_shards(shards.shard_by_bytes(make_docs(few), 8).collect(), few, 8)
    assert shards.shard_by_bytes(make_docs([]), 8).count() == 0


def best_score(model, marked):
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        for begin in range(end):
            i = model.ids.get(marked[begin:end])
            if i is not None:
                best[end] = max(best[end], best[begin] + model.scores[i])
        if marked[end - 1] not in model.ids:
            best[end] = max(best[end], best[end - 1] + model.byte_score * len(marked[end - 1].encode()))
    return best[-1]


def test_subwords(spark, make_docs, sample):
    model = subwords.pieces(PIECE)
    model.ids = {t: i for i, t in enumerate(model.texts) if t}
    coded = subwords.encode(make_docs(sample), ["doc_id"], PIECE)
    found = coded.collect()
    texts = Counter((i, t) for i, t in sample)
    again = Counter((r.doc_id, r.text) for r in subwords.decode(coded, ["doc_id"], PIECE).collect())
    assert again == texts and all(r.restored in (True, None) for r in found)
    by_id = dict(sample)
    for r in [r for r in found if r.ids and len(by_id[r.doc_id] or "") < 400][:40]:
        text = by_id[r.doc_id]
        if r.doc_id is None:
            continue
        value = sum(model.scores.get(i, model.byte_score) for i in r.ids)
        assert value == pytest.approx(best_score(model, "▁" + text.replace(" ", "▁")))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for r in [r for r in found if r.ids and "\x00" not in (by_id[r.doc_id] or "")][:60]:
        if r.doc_id is not None and r.doc_id != 6:
            assert library.decode(list(r.ids)) == by_id[r.doc_id]
    assert subwords.encode(make_docs([]), ["doc_id"], PIECE).count() == 0


def found_personal(df):
    return [(r.doc_id, r.base) for r in df.select("doc_id", pii.listed(F.col("found"), *pii.BASE).alias("base")).collect()]


def test_personal_data(spark, make_docs, sample):
    rng = random.Random(8)
    bits = ["a.b@c.d", "x@y", "@", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "0001.002.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100",
            "+12", "é", " ", ".", "-", "+", "5", "37", "  ", "a@b.com_c@d.com.x@e.f", "00000000000000", "\n", "１２"]
    odd = [(40000 + k, "".join(rng.choice(bits) for _ in range(rng.randrange(14)))) for k in range(500)]
    odd += [(50000, "a" * 60000 + "@" + "b." * 3000), (50001, "1" * 50000 + " 2" * 20000), (50002, "+1" + "(" * 30000 + "9"), (50003, "1.2.3.4 " * 2000)]
    docs = sample + odd
    expected = [(i, ",".join(f"{k}:{s}:{e}" for k, s, e in brute.personal(t))) for i, t in docs]
    assert ordered(found_personal(pii.detect(make_docs(docs), ["doc_id"]))) == ordered(expected)
    assert pii.detect(make_docs([]), ["doc_id"]).count() == 0


def test_personal_data_of_the_method(spark, make_docs):
    texts = ["pay to GB82 WEST 1234 5698 7654 32 now", "GB82WEST12345698765433", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" x",
             "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "mail a.b@c.de and b@c.de, card 4111 1111 1111 1111"]
    found = pii.detect(make_docs(texts), ["doc_id", "text"]).select("doc_id", pii.listed(F.col("found")), pii.redact(F.col("text"), F.col("found"))).collect()
    got = {r[0]: (r[1], r[2]) for r in found}
    assert got[0] == ("iban:7:34", "pay to [IBAN] now") and got[1][0] == "" and got[3][0] == ""
    assert got[2] == ("secret:9:49", 'token = "[SECRET]" x')
    assert got[4][1] == "mail [EMAIL] and [EMAIL], card [CARD]"


def test_no_clash_with_other_columns(spark, make_docs, awkward):
    docs = make_docs(awkward).withColumns({"found": F.lit(1), "own_1": F.lit(2), "key": F.lit(3), "print": F.lit(4), "mark": F.lit(5), "size": F.lit(6)})
    assert pii.detect(docs, ["doc_id", "own_1", "text"]).columns == ["doc_id", "own_1", "text", "found"]
    n = len(awkward)
    assert repeats.remove_repeats(docs).count() == simhash.groups(docs, ["doc_id"]).count() == shards.shard_by_bytes(docs, 3).count() == n
    assert leaks.find_leaks(docs, docs.select(F.col("doc_id").alias("item_id"), "text"), ["doc_id"]).count() == n


def test_patience_alignment():
    rng = random.Random(9)
    assert licenses.longest_increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 4)]) == [(1, 1), (2, 2), (4, 4)]
    for _ in range(200):
        b = [rng.randrange(40) for _ in range(25)]
        a = [w for w in b if rng.random() < 0.9]
        for _ in range(3):
            a.insert(rng.randrange(len(a) + 1), 99)
        pairs = licenses.align(a, b)
        assert all(a[x] == b[y] for x, y in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x, w in enumerate(a):
            for y, v in enumerate(b):
                table[x + 1][y + 1] = table[x][y] + 1 if w == v else max(table[x][y + 1], table[x + 1][y])
        assert len(pairs) <= table[-1][-1]
    once = rng.sample(range(100), 30)
    cut = [w for k, w in enumerate(once) if k % 5]
    assert len(licenses.align(cut, once)) == len(cut)  # words that are unique on both sides: a longest common subsequence


def test_licenses(spark, make_docs, awkward):
    line = licenses.TEMPLATES["MIT-line"]
    noise = "some words of no meaning here " * 30
    texts = {100: noise + licenses.TEMPLATES["MIT"] + noise, 101: noise + line + "\n" + line + " " + line.upper() + noise, 102: noise,
             103: "Licensed under the Apache License, Version 2.0.\n" + noise + licenses.TEMPLATES["BSD-3-Clause"].replace("source", "original", 1),
             104: licenses.TEMPLATES["Apache-2.0-notice"], 105: "under the license of the version", 106: line}
    found = {r.doc_id: [(x.license, round(x.coverage, 4)) for x in r.licenses] for r in licenses.scan_licenses(
        make_docs(awkward + list(texts.items())), ["doc_id"]).collect()}
    assert [n for n, _ in found[100]] == ["MIT"] and [n for n, _ in found[101]] == ["MIT-line"] * 3 and found[102] == [] and found[105] == []
    assert [n for n, _ in found[103]] == ["Apache-2.0-line", "BSD-3-Clause"] and found[103][1][1] < 1
    assert [n for n, _ in found[104]] == ["Apache-2.0-notice"] and found[106] == [("MIT-line", 1.0)]
    assert all(found[i] == [] for i, _ in awkward)
    assert licenses.scan_licenses(make_docs([]), ["doc_id"]).count() == 0


CHAT = "conv_id long, turn long, role string, text string"


def test_quotation_linking(spark):
    chat = [
        (1, 0, "user", "How do I sort a list?\n\nAnd how fast is it?"),
        (1, 1, "assistant", "On Monday, A wrote:\n> How do I sort a list?\n\nUse sorted()."),
        (1, 2, "user", "> And how   FAST\n> is it?\n\nNobody said."),
        (1, 3, "assistant", ">> How do I sort a list?\n> Use sorted().\n\nIt is stable too."),
        (1, 4, None, "> never said by anyone\nA stray remark"),
        (2, 0, "user", "How do I sort a list?"),
        (2, 1, "assistant", None),
        (None, 0, "user", "> How do I sort a list?"),
        (1, 3, "assistant", ">> How do I sort a list?\n> Use sorted().\n\nIt is stable too."),
    ]
    found = quotes.reply_order(spark.createDataFrame(chat, CHAT)).orderBy("position").collect()
    assert [r.position for r in found] == list(range(len(chat)))
    one = [(r.turn, r.parent_turn, r.root_turn, r.depth, r.text) for r in found if r.conv_id == 1]
    assert one == [(0, None, 0, 0, chat[0][3]), (1, 0, 0, 1, "Use sorted()."), (2, 0, 0, 1, "Nobody said."), (3, 1, 0, 2, "It is stable too."),
                   (3, 1, 0, 2, "It is stable too."), (4, None, 4, 0, "A stray remark")]
    assert [(r.conv_id, r.role) for r in found][0] == (None, "user") and found[-1].text == ""
    assert found[1].formatted == "<|user|>\n" + chat[0][3] + "\n<|end|>\n"
    assert quotes.reply_order(spark.createDataFrame([], CHAT)).count() == 0


def test_long_reply_chains_and_one_large_conversation(spark):
    chat = [(5, k, "user", f"> message number {k - 1} of all\n\nmessage number {k} of all" if k else "message number 0 of all") for k in range(70)]
    chat += [(6, k, "user", "> ok\nok\nthe same" if k % 2 else "ok") for k in range(300)]
    found = quotes.reply_order(spark.createDataFrame(chat, CHAT)).collect()
    assert {r.turn: r.depth for r in found if r.conv_id == 5} == {k: k for k in range(70)}
    assert {r.parent_turn for r in found if r.conv_id == 6 and r.turn % 2} == {0}
    assert "> " not in "".join(r.text for r in found)


def test_sha_of_queries_is_hexadecimal(spark):
    from indicatorlake.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op9_pii"](spark, SF).collect()}
    for i, t in docs.items():
        base = brute.personal(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(k == n for k, _, _ in base) for n in pii.BASE)
