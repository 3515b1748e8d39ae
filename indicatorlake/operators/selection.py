"""Rows per indicator: each indicator is a predicate over a view, maybe with a query on top."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .predicates import Index

# Characters of predicates that one pass evaluates: Spark compiles expressions of
# about this size; more of them take another scan.
PREDICATE_TEXT = 8000
SEPARATOR = "\x01"
# A predicate without a function call: plain columns, which scans can filter on.
CALL = re.compile(r"\b(?!(?:and|or|not|in|between|like|is|case|when|then|else|end)\b)[a-z_]\w*\s*\(", re.IGNORECASE)


@dataclass(frozen=True)
class Indicator:
    uid: str
    condition: str  # SQL predicate; TRUE selects every row
    pre_process: str | None = None  # SQL query over a relation called input

    @property
    def query(self) -> str:
        return (self.pre_process or "").strip().rstrip(";").strip()


def indicators(config: DataFrame) -> dict[str, list[Indicator]]:
    """Config rows as query text, by source.  This is control data: the plans are built from it."""
    has_query = "pre_process" in config.columns
    query = F.col("pre_process") if has_query else F.lit(None).cast("string")
    rows = config.select("afs_source_code", "afs_uid", "filter_string", query.alias("q")).collect()
    found: dict[str, list[Indicator]] = {}
    for r in sorted(rows, key=lambda r: (r.afs_source_code, r.afs_uid)):
        found.setdefault(r.afs_source_code, []).append(Indicator(r.afs_uid, r.filter_string.strip(), r.q))
    return found


def _check_uids(wanted: Iterable[Indicator]) -> None:
    if any(SEPARATOR in i.uid or not i.uid for i in wanted):
        raise ValueError("uids must be non-empty and free of control characters")


def fan_out(view: DataFrame, wanted: Iterable[Indicator]) -> DataFrame:
    """Rows of ``view`` once per matching indicator, with ``afs_uid`` in front.

    One scan: every row gets the joined uids whose predicate holds, split and
    exploded.  The same rows as one filtered scan per indicator, unioned.  The
    uids are made in a projection, where Spark evaluates what the predicates
    have in common (say, one JSON key they all look up) once per row; a filter
    on these beforehand would evaluate each predicate on its own again.  Only where
    no predicate calls a function is their disjunction put below, where the scan can
    use it.
    """
    batch = list(wanted)
    _check_uids(batch)
    hits = _uids(batch)
    split = F.explode(F.split("_uids", SEPARATOR)).alias("afs_uid")
    plain = [i.condition for i in batch]
    if not any(CALL.search(c) or c.strip().upper() == "TRUE" for c in plain):
        view = view.where(reduce(lambda a, b: a | b, [F.expr(c) for c in plain]))
    return view.withColumn("_uids", hits).select(split, *view.columns).where("afs_uid <> ''")


def _queried(selected: DataFrame, indicator: Indicator) -> DataFrame:
    """The result of an indicator's own SQL over its selected rows."""
    text = indicator.query.replace("{", "{{").replace("}", "}}")
    # a relation of this one statement, whatever views the session has
    return selected.sparkSession.sql(f"WITH input AS (SELECT * FROM {{selected}})\nSELECT * FROM (\n{text}\n)", selected=selected)


def processed(view: DataFrame, indicator: Indicator) -> DataFrame:
    """Run an indicator's own SQL over its selected rows and re-select the view's columns by name."""
    rows = view.where(F.expr(indicator.condition)).select(F.lit(indicator.uid).alias("afs_uid"), "*")
    return _queried(rows, indicator).select("afs_uid", *view.columns)


def batches(wanted: Iterable[Indicator]) -> Iterator[list[Indicator]]:
    """Indicators in groups of a bounded length of predicate text; a longer single predicate is a group of its own."""
    batch: list[Indicator] = []
    size = 0
    for i in wanted:
        if batch and size + len(i.condition) > PREDICATE_TEXT:
            yield batch
            batch, size = [], 0
        batch.append(i)
        size += len(i.condition)
    if batch:
        yield batch


def _uids(batch: list[Indicator]) -> Column:
    """The uids whose predicate holds, as one text."""
    return F.concat_ws(SEPARATOR, *[F.when(F.expr(i.condition), F.lit(i.uid)) for i in batch])


def selected(view: DataFrame, wanted: Iterable[Indicator]) -> DataFrame:
    """Rows of ``view`` once per matching indicator, with ``afs_uid`` in front, in one scan.

    Indicators with an equality in their predicate are found through an index; the
    predicates of the others run on every row, beside it.  Where there are others and
    all predicates together are no more than one pass evaluates, that pass costs less
    than the index, which copies a row for every left side it asks; the equalities
    still come first, so that the rest of a predicate only sees rows that have them.
    """
    wanted = list(wanted)
    _check_uids(wanted)
    index = Index(view, [(i.uid, i.condition) for i in wanted])
    if not index.found:
        return reduce(DataFrame.unionByName, [fan_out(view, batch) for batch in batches(wanted)])
    direct = [Indicator(uid, " AND ".join(f"({text})" for text in [*(a.text for a in atoms), *([rest] if rest else [])])) for uid, atoms, rest in index.found]
    direct += [Indicator(uid, condition) for uid, condition in index.others]
    if index.others and sum(len(i.condition) for i in direct) <= PREDICATE_TEXT:
        return fan_out(view, direct)
    others = {uid for uid, _ in index.others}
    beside = batches(i for i in wanted if i.uid in others)
    return index.select([F.split(_uids(batch), SEPARATOR) for batch in beside])


def processed_together(view: DataFrame, wanted: Iterable[Indicator]) -> list[DataFrame]:
    """The results of several indicators' queries, over rows that are selected and stored once.

    The view is scanned once for all of them.  Their rows lie in one folder for each
    uid, and a query reads its own; a uid with a great share of the rows is spread over
    files.  Every query is analysed first, so that a wrong one shows before anything runs.
    """
    wanted = list(wanted)
    if len(wanted) < 2:
        return [processed(view, i) for i in wanted]
    for i in wanted:
        processed(view, i)
    spark, rows = view.sparkSession, selected(view, wanted)
    folder = scratch_folder(spark, "selected")
    rows.hint("rebalance", "afs_uid").write.partitionBy("afs_uid").parquet(folder)
    # with the schema, or else uids that look like numbers would become such
    stored = spark.read.schema(rows.schema).parquet(folder)
    return [_queried(stored.where(F.col("afs_uid") == i.uid).select("afs_uid", *view.columns), i).select("afs_uid", *view.columns) for i in wanted]


def select_indicators(view: DataFrame, wanted: Iterable[Indicator]) -> DataFrame:
    """All indicators of one view as one stage frame (afs_uid + the view's columns)."""
    wanted = list(wanted)
    plain, queries = [i for i in wanted if not i.query], [i for i in wanted if i.query]
    branches = [selected(view, plain)] if plain else []
    branches += processed_together(view, queries)
    if not branches:
        raise ValueError("no indicator to select")
    return reduce(DataFrame.unionByName, branches)
