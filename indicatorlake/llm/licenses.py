"""License scans: patience alignment of texts with license templates."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, picked, ship, words_of
from .leaks import SEPARATORS, folded
from .license_texts import TEMPLATES

#: Share of a template's words that a stretch must align with.
COVERAGE = 0.7
#: Words too common to point at a license, as far as a template has others.
COMMON = frozenset("a all an and any are as at be by can for from if in is it may no not of on or such that the this to under use was where which "
                   "with without work you your".split())


def _unique_in_both(a: list[int], b: list[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Pairs of places of the words that stand once in each stretch, by place in a."""
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    place = {w: k for k, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
    return [(k, place[w]) for k, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, in order of the first place, whose second places grow: patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, value) in enumerate(pairs):
        pile = bisect_left(tops, value)
        before[k] = piles[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(value)
            piles.append(k)
        else:
            tops[pile], piles[pile] = value, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of equal words that patience alignment matches, in order.

    Equal beginnings and ends are matched first; then words unique to both sides
    anchor the rest, and the gaps between anchors are aligned in the same way.
    """
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = longest_increasing(_unique_in_both(a, b, a0, a1, b0, b1))
        out += anchors
        if anchors:
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            work += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:])]
    return sorted(out)


class Templates:
    """Word sequences of the templates and the words that hint at each.

    A template's longest words hint at it, so many that the others make up less than
    the share that must align: no place can be covered enough without one of them.
    """

    def __init__(self, texts: dict[str, str], least: float = COVERAGE):
        names = sorted(texts)
        table = words_of(folded(pa.array([texts[n] for n in names], pa.string())), SEPARATORS)
        hashes = table.hashes().view(np.int64)
        common = set(words_of(pa.array(sorted(COMMON), pa.string())).hashes().view(np.int64).tolist())
        self.words = {n: hashes[table.bounds[k] : table.bounds[k + 1]].tolist() for k, n in enumerate(names)}
        lengths, telling = (table.ends - table.starts).tolist(), set()
        for k in range(len(names)):
            low, high = int(table.bounds[k]), int(table.bounds[k + 1])
            counts, size = Counter(hashes[low:high].tolist()), dict(zip(hashes[low:high].tolist(), lengths[low:high]))
            rest = high - low
            for word in sorted(counts, key=lambda w: (w in common, -size[w], w)):
                if rest < least * (high - low):
                    break
                telling.add(word)
                rest -= counts[word]
        self.telling = np.array(sorted(telling), np.int64)
        self.longest = max((len(w) for w in self.words.values()), default=0)

    def stretches(self, places: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
        """Stretches of a text around its telling words, wide enough for the longest template on either side."""
        if len(places) == 0:
            return
        cuts = np.flatnonzero(np.diff(places) > self.longest) + 1
        for run in np.split(places, cuts):
            yield max(low, int(run[0]) - self.longest), min(high, int(run[-1]) + 1 + self.longest)

    def found(self, text: list[int], name: str, least: float) -> Iterator[tuple[int, int, float]]:
        """(first word, last word + 1, coverage) of every place in the stretch that aligns with the template."""
        template = self.words[name]
        size = len(template)
        needed = Counter(template)
        work = [(0, len(text))]
        while work:
            low, high = work.pop()
            part = text[low:high]
            if sum((Counter(part) & needed).values()) < least * size:
                continue
            matched = align(part, template)
            # words matched far away from the rest do not belong to the place
            core = _densest([m[0] for m in matched], 2 * size)
            if core and core[2] >= least * size:
                yield low + core[0], low + core[1], core[2] / size
                work += [(low, low + core[0]), (low + core[1], high)]
            elif high - low > size + size // 4:
                middle, reach = (low + high) // 2, (size + 1) // 2
                work += [part for part in ((low, middle + reach), (middle - reach, high)) if part[1] - part[0] < high - low]


def _densest(places: list[int], reach: int) -> tuple[int, int, int] | None:
    """(first, last + 1, count) of the most places within ``reach`` words; the first of equals."""
    best, low = None, 0
    for high in range(len(places)):
        while places[high] - places[low] >= reach:
            low += 1
        if best is None or high - low + 1 > best[2]:
            best = (places[low], places[high] + 1, high - low + 1)
    return best


def _scan(templates: Templates, texts: pa.Array, least: float) -> list[list[dict]]:
    words = words_of(folded(texts), SEPARATORS)
    hashes = words.hashes().view(np.int64)
    place = np.minimum(np.searchsorted(templates.telling, hashes), max(0, len(templates.telling) - 1))
    telling = np.flatnonzero(templates.telling[place] == hashes) if len(templates.telling) else np.zeros(0, np.int64)
    rows = np.searchsorted(words.bounds, telling, "right") - 1
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for row in np.unique(rows).tolist():
        low, high = int(words.bounds[row]), int(words.bounds[row + 1])
        found = []
        for begin, stop in templates.stretches(telling[rows == row], low, high):
            text = hashes[begin:stop].tolist()
            for name in templates.words:
                found += [(begin - low + s, begin - low + e, c, name) for s, e, c in templates.found(text, name, least)]
        # of overlapping places the one that aligns most words stays, then the better covered
        taken: list[tuple[int, int, float, str]] = []
        for s, e, c, name in sorted(found, key=lambda f: (-round(f[2] * len(templates.words[f[3]])), -f[2], f[0], f[3])):
            if all(e <= t[0] or s >= t[1] for t in taken):
                taken.append((s, e, c, name))
        out[row] = [{"license": name, "start": s, "end": e, "coverage": c} for s, e, c, name in sorted(taken)]
    return out


def scan_licenses(docs: DataFrame, keys: list[str], text: str = "text", templates: dict[str, str] | None = None, least: float = COVERAGE) -> DataFrame:
    """The keys of every row and ``licenses``: an array of (license, start, end, coverage) in text order.

    Words are compared without case and punctuation; start and end count words.
    Coverage is the share of the template's words that patience alignment matches.
    All places count, also repeated ones; of overlapping ones the larger stays.  A
    null or empty text has none; long texts are scanned whole, around the words that
    hint at a template.  Each row is scanned alone, without a shuffle; the templates
    are part of the code and small.
    """
    ship(docs.sparkSession)
    plain, carried = picked(docs, keys, text)
    texts = TEMPLATES if templates is None else templates
    shape = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(texts, least)
        for batch in batches:
            for part in chunks(batch, text):
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys] + [pa.array(_scan(known, part.column(text), least), shape)], [*keys, "licenses"])

    return plain.mapInArrow(run, carried + "licenses array<struct<license:string,start:int,end:int,coverage:double>>")
