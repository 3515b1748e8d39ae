"""Personal data with built-in SQL functions: patterns propose, checksums confirm, context words score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before a match in which a context word counts.
CONTEXT = 48
#: Spans of the kinds that are not in BASE need this score; base spans always stay.
LEAST_SCORE = 0.6
BASE = ("email", "ip", "card", "phone")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


def luhn(match: Column) -> Column:
    """12 to 19 digits whose Luhn sum is a multiple of ten."""
    figures = F.split(F.reverse(_digits(match)), "")
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda sum_, d: sum_ + F.coalesce(d, F.lit(0)))
    return _between(F.length(_digits(match)), 12, 19) & (total % 10 == 0)


def mod_97(match: Column) -> Column:
    """The first four characters moved to the end, letters as 10 to 35, leave 1 modulo 97."""
    plain = F.replace(match, F.lit(" "))
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), "")
    rest = F.aggregate(turned, F.lit(0), lambda rest, c: F.when(c == "", rest).when(c < "A", (rest * 10 + c.cast("int")) % 97).otherwise(
        (rest * 100 + F.ascii(c) - 55) % 97))
    return _between(F.length(plain), 15, 34) & (rest == 1)


def small_parts(match: Column) -> Column:
    """Every dotted part is at most 255, whatever zeros it starts with."""
    return F.forall(F.split(match, r"\."), lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3) & (
        F.coalesce(F.substr(F.ltrim(part, F.lit("0")), F.lit(1), F.lit(3)).try_cast("int"), F.lit(0)) <= 255))


@dataclass(frozen=True)
class Kind:
    """A pattern, the test that drops its matches, and the words that raise its score.

    Patterns are possessive and never start anew inside a run they have given up,
    so that their time is linear in the text.  ``hint``, where there is one, is a
    string without which no match exists.
    """

    name: str
    pattern: str
    confirm: Callable[[Column], Column] | None = None
    words: str = ""
    hint: str = ""
    score: float = 0.5


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, "mail|contact|write", "@", 0.8),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", small_parts, r"\bip\b|host|server|address|login", "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", luhn, "card|visa|master|credit|debit|account|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: _between(F.length(_digits(m)), 9, 15), "phone|tel|call|mobile|fax", "+"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})", mod_97, "iban|bank|account|konto|transfer", "", 0.7),
    Kind("secret", r"[0-9A-Za-z]{32,}+", lambda m: m.rlike("^[0-9a-f]{32,64}$") & m.rlike("[0-9]") & m.rlike("[a-f]"),
         "token|secret|key|password|passwd|auth", "", 0.3),
)


def detect(docs: DataFrame, keys: list[str], kinds: tuple[Kind, ...] = KINDS, text: str = "text") -> DataFrame:
    """The keys of every row and ``found``: an array of (start, rank, end, kind, score, match), by start, then kind.

    Positions count code points, the end exclusive.  Matches of one kind are leftmost
    and do not overlap; those of different kinds may.  A failing match is dropped
    without another try.  A null or empty text has none.  Each row is worked on
    alone and whole, so there is no shuffle.
    """
    held = {c: f"own_{k}" for k, c in enumerate(dict.fromkeys([*keys, text]))}  # columns of the input cannot clash with those made here
    out = docs.select(*[docs[c].alias(own) for c, own in held.items()])
    whole = F.coalesce(F.col(held[text]), F.lit(""))
    none = F.array().cast("array<string>")

    def matches(kind: Kind) -> Column:
        all_of = F.regexp_extract_all(whole, F.lit(kind.pattern), F.lit(0))
        return F.when(F.contains(whole, F.lit(kind.hint)), all_of).otherwise(none) if kind.hint else all_of

    out = out.select("*", *[matches(k).alias(f"match_{k.name}") for k in kinds])
    out = out.select("*", *[F.when(F.size(f"match_{k.name}") > 0, F.split(whole, k.pattern, -1)).alias(f"rest_{k.name}") for k in kinds])

    def spans(kind: Kind, rank: int) -> Column:
        """Lengths of what lies before and of the matches, summed up, give the positions."""
        match, rest = F.col(f"match_{kind.name}"), F.col(f"rest_{kind.name}")
        pairs = F.zip_with(F.slice(rest, F.lit(1), F.size(match)), match, lambda before, m: F.struct(before.alias("before"), m.alias("m")))
        shape = "array<struct<start:int,rank:int,end:int,kind:string,score:double,match:string>>"

        def grow(state: Column, pair: Column) -> Column:
            start = state["at"] + F.length(pair["before"])
            end = start + F.length(pair["m"])
            near = F.lower(F.right(pair["before"], F.lit(CONTEXT)))
            score = F.lit(kind.score) + F.when(near.rlike(kind.words), F.lit(0.2 if kind.confirm is None or kind.score >= 0.5 else 0.4)).otherwise(F.lit(0.0))
            sure = kind.confirm(pair["m"]) if kind.confirm else F.lit(True)
            sure = sure & (F.lit(kind.name in BASE) | (score >= LEAST_SCORE))
            one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"),
                           score.alias("score"), pair["m"].alias("match"))
            return F.struct(end.alias("at"), F.when(sure, F.concat(state["out"], F.array(one))).otherwise(state["out"]).cast(shape).alias("out"))

        first = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("out"))
        return F.when(F.size(match) > 0, F.aggregate(pairs, first, grow, lambda state: state["out"])).otherwise(F.array().cast(shape))

    found = F.array_sort(F.concat(*[spans(k, i) for i, k in enumerate(kinds)]))
    return out.select(*[F.col(held[c]).alias(c) for c in keys], found.alias("found"))


def listed(found: Column, *names: str) -> Column:
    """The spans of the named kinds (of all, without names) as kind:start:end, comma-joined."""
    chosen = F.filter(found, lambda s: s["kind"].isin(*names)) if names else found
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number(found: Column, kind: str) -> Column:
    """How many spans of a kind there are."""
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def redact(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named after the first."""

    def step(state: Column, span: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.when(
            span["start"] >= state["at"], F.concat(state["out"], gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(
        found, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1))))
