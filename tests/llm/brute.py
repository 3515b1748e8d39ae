"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def removed(texts, window):
    """(n_words, n_removed, sha) of every text."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def quality(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    inside = set()
    for k in range(len(w) - 4):
        if grams[tuple(w[k : k + 5])] > 1:
            inside.update(range(k, k + 5))
    lines = [line for line in text.split("\n") if words(line)]
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed)


def coverage(text, n):
    w = words(text)
    grams = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    inside = set()
    for k in range(len(w) - n + 1):
        if grams[tuple(w[k : k + n])] > 1:
            inside.update(range(k, k + n))
    return sum(len(w[k]) for k in inside) / max(1, sum(map(len, w)))


def fingerprint(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x.encode()) for x in words(text)]
    shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def grouped(prints, ids, bits):
    """The smallest id reachable from every place over fingerprints within ``bits``."""
    label = list(range(len(prints)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= bits:
                label[max(root(a), root(b))] = min(root(a), root(b))
    members = {}
    for k in range(len(prints)):
        members.setdefault(root(k), []).append(ids[k])
    return [min((i for i in members[root(k)] if i is not None), default=None) for k in range(len(prints))]


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    """(kind, start, end) of the base kinds, by start, then kind."""
    out = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def edit_distance_inside(pattern, text):
    """The smallest edit distance of the pattern to any part of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for word in text:
        before, row[0] = row[0], 0
        for k, p in enumerate(pattern, 1):
            before, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, before + (p != word))
        best = min(best, row[-1])
    return best


def crc(text):
    return zlib.crc32((text or "").encode())
