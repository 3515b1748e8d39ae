"""An index of predicates: rows meet the indicators they may belong to by an equi-join, however many there are."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Functions that give a value, or NULL, for every row, so that they may run on rows the rest of a predicate keeps out.
TOTAL = {"get_json_object", "lower", "upper", "trim", "ltrim", "rtrim", "coalesce", "concat", "concat_ws", "nullif", "ifnull"}
TEXT, WHOLE = ("string",), ("tinyint", "smallint", "int", "bigint")
#: Rests that one CASE tells apart; more of them are told apart in two steps.
RESTS_TOGETHER = 64
_MARK = "\x02"
_MARKED = re.compile(f"{_MARK}([0-9]+){_MARK}")


@dataclass(frozen=True)
class Atom:
    """left = value, or left IN (values): SQL text, and the values as text with their types."""

    text: str
    left: str
    values: tuple[str, ...]
    kinds: tuple[str, ...]


@dataclass(frozen=True)
class Split:
    """A predicate as equality atoms and what is left of it, all joined by AND."""

    atoms: tuple[Atom, ...]
    rest: str | None


def _name(node) -> str:
    return node.getClass().getSimpleName()


def _children(node) -> list:
    found = node.children()
    return [found.apply(k) for k in range(found.size())]


def _total(node) -> bool:
    name = _name(node)
    if name in ("UnresolvedAttribute", "Literal"):
        return True
    return name == "UnresolvedFunction" and node.prettyName().lower() in TOTAL and all(map(_total, _children(node)))


def _conjuncts(node) -> list:
    return [c for side in _children(node) for c in _conjuncts(side)] if _name(node) == "And" else [node]


def _atom(node) -> Atom | None:
    if _name(node) not in ("EqualTo", "In"):
        return None
    left, *values = _children(node)
    if _name(node) == "EqualTo" and _name(left) == "Literal":
        left, values = values[0], [left]
    if _name(left) == "Literal" or not _total(left) or any(_name(v) != "Literal" for v in values):
        return None
    kinds = tuple(v.dataType().simpleString() for v in values)
    if not values or not (set(kinds) <= set(TEXT) or set(kinds) <= set(WHOLE)):
        return None
    return Atom(node.sql(), left.sql(), tuple(dict.fromkeys(str(v.value()) for v in values)), kinds)


def split(spark: SparkSession, condition: str) -> Split:
    """A predicate taken apart by Spark's own parser; where its text cannot be given back piece by piece, it is all rest."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    pieces = _conjuncts(parser.parseExpression(condition))
    if any(not parser.parseExpression(p.sql()).equals(p) for p in pieces):
        return Split((), condition)
    atoms = [(_atom(p), p.sql()) for p in pieces]
    rest = " AND ".join(f"({text})" for atom, text in atoms if atom is None)
    return Split(tuple(atom for atom, _ in atoms if atom is not None), rest or None)


def _template(condition: str) -> tuple[str, list[str]]:
    """A predicate with marks in place of its texts, and the texts; as it is where quoting is not plain."""
    if any(c in condition for c in ("\\", '"', "`", "''", "--", "/*", _MARK)):
        return condition, []
    if any(condition[: m.start()][-1:].isalnum() for m in re.finditer(r"'[^']*'", condition)):  # a prefix gives the text another meaning
        return condition, []
    texts: list[str] = []

    def mark(found: re.Match) -> str:
        texts.append(found[1])
        return f"'{_MARK}{len(texts) - 1}{_MARK}'"

    return re.sub(r"'([^']*)'", mark, condition), texts


def _filled(shape: Split, texts: list[str]) -> Split:
    """The parts of a template with the texts in place of the marks."""

    def put(text: str) -> str:
        return _MARKED.sub(lambda m: texts[int(m[1])], text)

    atoms = tuple(Atom(put(a.text), put(a.left), tuple(dict.fromkeys(map(put, a.values))), a.kinds) for a in shape.atoms)
    return Split(atoms, put(shape.rest) if shape.rest else None)


class Index:
    """The predicates of many indicators over one view.

    Each indicator with an equality is found by one of its atoms, the one whose left
    side tells most indicators apart.  A row gives the value of every such left side,
    and an equi-join with the small table (left, value, indicator) names its
    candidates; only these check the other atoms, as data, and the rest of the
    predicate.  The cost of a row follows the indicators it hits, not their number.
    """

    def __init__(self, view: DataFrame, wanted: Iterable[tuple[str, str]]):
        self.view = view
        # predicates that differ in their texts only are parsed and analysed once
        forms = [(uid, condition, *_template(condition)) for uid, condition in wanted]
        shapes = {form: split(view.sparkSession, form) for form in dict.fromkeys(form for _, _, form, _ in forms)}
        self._check(list({form: condition for _, condition, form, _ in forms}.values()))
        parts = [(uid, condition, _filled(shapes[form], texts) if texts else shapes[form]) for uid, condition, form, texts in forms]
        self.kinds = self._kinds({a.left for _, _, s in parts for a in s.atoms})
        self.found, self.others = [], []
        for uid, condition, s in parts:
            usable = [a for a in s.atoms if set(a.kinds) <= set(TEXT if self.kinds[a.left] in TEXT else WHOLE if self.kinds[a.left] in WHOLE else ())]
            if not usable:
                self.others.append((uid, condition))
                continue
            rest = " AND ".join([*(a.text for a in s.atoms if a not in usable), *([s.rest] if s.rest else [])])
            self.found.append((uid, usable, rest or None))

    def _check(self, conditions: list[str]) -> None:
        """Every predicate is analysed, so that a wrong one shows before anything runs."""
        schema = self.view.select(*[F.expr(c).alias(f"p{k}") for k, c in enumerate(conditions)]).schema
        for field, condition in zip(schema, conditions):
            if not isinstance(field.dataType, (T.BooleanType, T.NullType)):
                raise ValueError(f"not a predicate: {condition}")

    def _kinds(self, lefts: set[str]) -> dict[str, str]:
        ordered = sorted(lefts)
        schema = self.view.select(*[F.expr(left).alias(f"l{k}") for k, left in enumerate(ordered)]).schema if ordered else []
        return {left: field.dataType.simpleString() for left, field in zip(ordered, schema)}

    def select(self, hits: Sequence[Column]) -> DataFrame:
        """afs_uid and the view's columns; ``hits`` are arrays of the uids of other indicators that a row belongs to."""
        told: dict[str, set] = {}
        for _, atoms, _ in self.found:
            for a in atoms:
                told.setdefault(a.left, set()).update(a.values)
        lefts = sorted(told, key=lambda left: (-len(told[left]), left))
        number = {left: k for k, left in enumerate(lefts)}
        rests = list(dict.fromkeys(rest for _, _, rest in self.found if rest))
        rows, entrances = [], {}
        for uid, atoms, rest in self.found:
            door, *more = sorted(atoms, key=lambda a: number[a.left])
            needs = [{"no": number[a.left], "among": list(a.values)} for a in more]
            entrances.setdefault(door.left, set()).update(door.values)
            rows += [(number[door.left], value, uid, needs, rests.index(rest) if rest else -1) for value in door.values]
        rows += [(-1, uid, uid, [], -1) for uid, _ in self.others]
        kinds = [pa.int32(), pa.string(), pa.string(), pa.list_(pa.struct([("no", pa.int32()), ("among", pa.list_(pa.string()))])), pa.int32()]
        table = self.view.sparkSession.createDataFrame(pa.table(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=["_no", "_value", "afs_uid", "_needs", "_rest"]))
        view = self.view
        if not self.others and all(left.isidentifier() for left in entrances):  # plain columns, which scans can filter on
            view = view.where(" OR ".join(f"{left} IN ({', '.join(self._literal(left, v) for v in sorted(among))})" for left, among in entrances.items()))
        values = F.array(*[F.expr(left).cast("string") for left in lefts])
        doors = F.array(*[F.struct(F.lit(number[left]).alias("_no"), F.col("_values")[number[left]].alias("_value")) for left in sorted(entrances, key=number.get)])
        others = [F.transform(h, lambda uid: F.struct(F.lit(-1).alias("_no"), uid.alias("_value"))) for h in hits]
        asked = view.withColumn("_values", values).select("*", F.explode(F.concat(doors, *others)).alias("_door"))
        met = asked.join(table, (F.col("_door._no") == F.col("_no")) & (F.col("_door._value") == F.col("_value")))
        holds = F.forall("_needs", lambda need: F.coalesce(F.array_contains(need["among"], F.element_at("_values", need["no"] + 1)), F.lit(False)))
        met = met.where(holds)
        if rests:
            met = met.where(F.when(F.col("_rest") < 0, F.lit(True)).otherwise(self._rest(rests)))
        return met.select("afs_uid", *self.view.columns)

    def _literal(self, left: str, value: str) -> str:
        if self.kinds[left] in WHOLE:
            return value
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    @staticmethod
    def _rest(rests: list[str]) -> Column:
        """The rest of a candidate's predicate, told by its number, in two steps so that a row passes few of them."""
        number, steps = F.col("_rest"), []
        for low in range(0, len(rests), RESTS_TOGETHER):
            together = range(low, min(low + RESTS_TOGETHER, len(rests)))
            steps.append((number < together.stop, _first([(number == k, F.expr(rests[k])) for k in together])))
        return _first(steps)


def _first(cases: list[tuple[Column, Column]]) -> Column:
    """The value of the first case that holds."""
    out = F
    for condition, value in cases:
        out = out.when(condition, value)
    return out
