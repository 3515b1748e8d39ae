"""Every template, planted in the given texts with words changed, is found under its own name at its place."""

from __future__ import annotations

import random
import re
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa

from indicatorlake.llm import leaks, licenses

LINES = {n for n, t in licenses.TEMPLATES.items() if len(t.split()) < 16}


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())


def test_every_template_is_found_with_words_changed(spark, make_docs):
    rng = random.Random(3)
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text and "licen" not in r.text.lower()][:60]
    docs, planted = [], {}
    for k, (name, template) in enumerate(sorted(licenses.TEMPLATES.items()) * 3):
        text = template.split()
        for at in rng.sample(range(len(text)), len(text) * (k // len(licenses.TEMPLATES)) // 16):
            text[at] = f"other{rng.randrange(999)}"
        around = rng.choice(given).split()
        cut = rng.randrange(len(around) + 1)
        docs.append((k, " ".join([*around[:cut], "\n\n", *text, "\n", *around[cut:]])))
        planted[k] = (name, words(" ".join(around[:cut])), words(" ".join(text)))
    docs += [(1000 + k, t) for k, t in enumerate(given)]
    found = {r.doc_id: r.licenses for r in licenses.scan_licenses(make_docs(docs), ["doc_id"]).collect()}
    for k, (name, before, text) in planted.items():
        template = words(licenses.TEMPLATES[name])
        hits = [x for x in found[k] if x.license == name]
        assert len(hits) == 1, (name, found[k])
        same = sum(m.size for m in SequenceMatcher(None, text, template, autojunk=False).get_matching_blocks())
        assert abs(hits[0].coverage - same / len(template)) <= 0.05 and hits[0].coverage <= 1
        assert abs(hits[0].start - len(before)) <= len(text) - same + 1 and abs(hits[0].end - len(before) - len(text)) <= len(text) - same + 1
        assert [x.license for x in found[k]] == [name]
    assert not any(found[1000 + k] for k in range(len(given)))


def test_words_agree_with_the_operator():
    texts = [*licenses.TEMPLATES.values(), "É-ß 漢字, x1_y"]
    table = leaks.words_of(leaks.folded(pa.array(texts)), leaks.SEPARATORS)
    assert [int(n) for n in table.bounds[1:] - table.bounds[:-1]] == [len(words(t)) for t in texts]
    assert len(licenses.TEMPLATES) == 19 and len(LINES) == 6


def test_hints_miss_no_place(spark):
    """With every word of the templates as a hint the same places are found."""
    rng = random.Random(8)
    given = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:40]
    for template in licenses.TEMPLATES.values():
        text = [w for w in template.split() if rng.random() < 0.8]
        given.append("some words " + " ".join(text) + " and more")
    known, every = licenses.Templates(licenses.TEMPLATES), licenses.Templates(licenses.TEMPLATES)
    every.telling = np.unique(np.concatenate([np.array(w) for w in every.words.values()]))
    assert len(known.telling) < len(every.telling)
    texts = pa.array(given)
    assert licenses._scan(known, texts, licenses.COVERAGE) == licenses._scan(every, texts, licenses.COVERAGE)
    assert sum(bool(f) for f in licenses._scan(known, texts, licenses.COVERAGE)) > 15
