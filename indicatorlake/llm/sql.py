"""DuckDB SQL that must give the rows of the queries that SQL can express."""

from __future__ import annotations

from .pii import BASE, CONTEXT, KINDS, LEAST_SCORE
from .quality import BASE_NGRAM, BASE_SHARE, COVERAGE, LINE_COVERAGE, MIN_WORDS
from .repeats import WINDOW

WORDS = r"""d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
t AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d)"""

SUBSTRING_DEDUP = f"""WITH {WORDS},
win AS (SELECT rid, p, array_to_string(w[p:p + {WINDOW - 1}], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM d WHERE len(w) >= {WINDOW})),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + {WINDOW})) AS k FROM win SEMI JOIN twice USING (s)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY k) AS words, count(*) AS n FROM t ANTI JOIN gone USING (rid, k) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""


def _quality() -> str:
    lengths = sorted({*COVERAGE, BASE_NGRAM})
    ctes, joins = [], []
    for n in lengths:
        ctes.append(f"""win{n} AS (SELECT rid, p, array_to_string(w[p:p + {n - 1}], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - {n - 2})) AS p FROM d WHERE len(w) >= {n})),
twice{n} AS (SELECT rid, s FROM win{n} GROUP BY ALL HAVING count(*) > 1),
in{n} AS (SELECT DISTINCT rid, unnest(range(p, p + {n})) AS k FROM win{n} SEMI JOIN twice{n} USING (rid, s)),
sum{n} AS (SELECT rid, count(*) AS words{n}, sum(length(word)) AS chars{n} FROM t JOIN in{n} USING (rid, k) GROUP BY rid)""")
        joins.append(f"LEFT JOIN sum{n} USING (rid)")
    shares = ", ".join(f"coalesce(chars{n}, 0) / greatest(word_chars, 1) AS coverage_{n}" for n in COVERAGE)
    kept = " AND ".join(f"coverage_{n} <= {most}" for n, most in COVERAGE.items())
    return f"""WITH {WORDS},
chars AS (SELECT rid, sum(length(word)) AS c FROM t GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
same AS (SELECT rid, line, count(*) - 1 AS more, list_sum(list_transform(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), lambda x: length(x))) AS c
    FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid, line),
again AS (SELECT rid, sum(more) AS more, sum(more * c) AS c FROM same GROUP BY rid),
{", ".join(ctes)},
base AS (
    SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(chars.c, 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(more, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(words{BASE_NGRAM}, 0) AS BIGINT) AS n_repeat_words, coalesce(again.c, 0) AS line_chars, {", ".join(f"chars{n}" for n in COVERAGE)}
    FROM d LEFT JOIN chars USING (rid) LEFT JOIN again USING (rid) {" ".join(joins)}),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_SHARE} * n_words AS base_failed,
    line_chars / greatest(word_chars, 1) AS line_coverage, {shares} FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND line_coverage <= {LINE_COVERAGE} AND {kept} AS kept, line_coverage, {", ".join(f"coverage_{n}" for n in COVERAGE)}
FROM judged"""


QUALITY_RULES = _quality()

_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
#: Kind -> (pattern, test of a match m).
_CASES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(x, '0') AS BIGINT), 0) <= 255))"),
    "card": (r"[0-9]([\x20-]?[0-9])+", f"""length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
        CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS})[i] AS INT) ELSE CAST(reverse({_DIGITS})[i] AS INT) * 2 - CASE WHEN CAST(reverse({_DIGITS})[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    "iban": (KINDS[4].pattern, """length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce([CAST(0 AS BIGINT)] || list_transform(
        string_split(replace(m, ' ', '')[5:] || replace(m, ' ', '')[:4], ''), lambda c: CAST(CASE WHEN c < 'A' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT)),
        lambda a, x: CASE WHEN x > 9 THEN (a * 100 + x) % 97 ELSE (a * 10 + x) % 97 END) = 1"""),
    "secret": (r"[0-9A-Za-z]{32,}", f"regexp_matches(m, '^[0-9a-f]{{32,64}}$') AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-f]') AND "
               f"{KINDS[5].score} + CASE WHEN regexp_matches(lower(right(before, {CONTEXT})), '{KINDS[5].words}') THEN 0.4 ELSE 0 END >= {LEAST_SCORE}"),
}


def _personal() -> str:
    parts = []
    for rank, (kind, (pattern, test)) in enumerate(_CASES.items()):
        pattern = pattern.replace("(?:", "(")
        parts.append(f"""SELECT rid, {rank} AS rank, '{kind}' AS kind, start, start + length(m) AS stop FROM (
    SELECT rid, found[i] AS m, rest[i] AS before, list_sum(list_transform(rest[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT rid, found, rest, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS rest FROM p))) WHERE {test}""")
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in BASE)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    spans = "\nUNION ALL\n".join(parts)
    return f"""WITH p AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({spans})
SELECT doc_id, {counts}, sha256(coalesce({listed[:-1]}) FILTER (rank < {len(BASE)}), '')) AS base_sha256, coalesce({listed}, '') AS spans
FROM p LEFT JOIN s USING (rid) GROUP BY rid, doc_id"""


PERSONAL_DATA = _personal()

PHRASE_COLLOCATIONS = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
    FROM documents),
split AS (SELECT row_number() OVER () AS piece_id, lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
placed AS (SELECT piece_id, lang, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM split),
followed AS (
    SELECT lang, x, lead(x, 1) OVER following AS y, lead(x, 2) OVER following AS z
    FROM placed WINDOW following AS (PARTITION BY piece_id ORDER BY i)),
phrases AS (
    SELECT lang, 1 AS k, x AS phrase FROM followed
    UNION ALL SELECT lang, 2, x || ' ' || y FROM followed WHERE y IS NOT NULL
    UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM followed WHERE z IS NOT NULL),
found AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM found WHERE k = 1 GROUP BY lang),
cuts AS (
    SELECT c.lang, c.k, c.phrase, c.f, s.head_words,
           array_to_string(string_split(c.phrase, ' ')[: s.head_words], ' ') AS head, array_to_string(string_split(c.phrase, ' ')[s.head_words + 1 :], ' ') AS tail
    FROM found AS c JOIN (VALUES (1), (2)) AS s(head_words) ON s.head_words < c.k
    WHERE c.k > 1 AND c.f >= 10),
scored AS (
    SELECT cuts.lang, cuts.k, cuts.phrase, cuts.f, l.f AS l, r.f AS r, 1000000 * cuts.f * cuts.f // (l.f * r.f) AS score, cuts.head_words
    FROM cuts
    JOIN found AS l ON l.lang = cuts.lang AND l.phrase = cuts.head
    JOIN found AS r ON r.lang = cuts.lang AND r.phrase = cuts.tail),
candidates AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, head_words) = 1),
inside AS (
    SELECT lang, phrase, max(f) AS longest FROM (
        SELECT lang, f, array_to_string(string_split(phrase, ' ')[:2], ' ') AS phrase FROM candidates WHERE k = 3
        UNION ALL
        SELECT lang, f, array_to_string(string_split(phrase, ' ')[2:], ' ') FROM candidates WHERE k = 3)
    GROUP BY lang, phrase),
alive AS (
    SELECT c.* FROM candidates AS c LEFT JOIN inside AS i ON i.lang = c.lang AND i.phrase = c.phrase
    WHERE i.longest IS NULL OR 100 * i.longest < 50 * c.f)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase,
       f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM alive JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
