"""Flat JSON objects of text values, one per kind of metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bag(entries: dict[str, Column]) -> Column:
    """JSON text holding the non-NULL entries in the given order; ``{}`` when there are none."""
    if not entries:
        return F.lit("{}")
    return F.to_json(F.struct(*[value.alias(key) for key, value in entries.items()]))
