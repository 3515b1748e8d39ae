"""Shards by bytes against a plain pass over the rows in order."""

from __future__ import annotations

from collections import defaultdict

import pytest

from indicatorlake.llm import shards


def plain_shards(docs, n):
    """{id: (size, shard)} for rows of different ids: in the order of the first id of a text, by the middle byte, small groups of copies together."""
    by_text = defaultdict(list)
    for i, text in docs:
        by_text[text or ""].append(i)
    order = [(i, text) for text, ids in sorted(by_text.items(), key=lambda x: min(x[1])) for i in sorted(ids)]
    total, before, out = sum(len(t.encode()) + 1 for _, t in order), 0, {}
    for text in dict.fromkeys(t for _, t in order):
        ids, size = sorted(by_text[text]), len(text.encode()) + 1
        group = size * len(ids)
        for k, i in enumerate(ids):
            middle = before + group / 2 if group <= total * shards.GROUP_SHARE / n and len(ids) > 1 else before + k * size + size / 2
            out[i] = (size, min(n - 1, int(middle * n // total)))
        before += group
    return order, out


@pytest.mark.parametrize("n", [3, 8])
def test_shards_equal_a_plain_pass(spark, make_docs, n):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6 + k, docs[k % 7][1]) for k in range(40)] + [(2 * 10**6 + k, None if k % 2 else "") for k in range(30)]
    docs += [(3 * 10**6 + k, "a hot text " * 900) for k in range(60)]
    order, expected = plain_shards(docs, n)
    found = shards.shard_by_bytes(make_docs(docs), n).collect()
    assert {r.id if hasattr(r, "id") else r.doc_id: (r.size, r.shard) for r in found} == expected
    dealt = [expected[i][1] for i, _ in order]
    sums = [sum(size for size, s in expected.values() if s == k) for k in range(n)]
    widest = max(size for size, _ in expected.values())
    target = sum(sums) / n
    assert max(sums) - min(sums) <= 2 * (widest + shards.GROUP_SHARE * target)
    for text, ids in {t: [i for i, x in docs if (x or "") == t] for t in {t or "" for _, t in docs}}.items():
        if len(ids) * (len(text.encode()) + 1) <= target * shards.GROUP_SHARE:
            assert len({expected[i][1] for i in ids}) == 1
    assert sum(a > b for a, b in zip(dealt, dealt[1:])) <= 2 * n  # contiguous, but for a group of copies at a cut
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
