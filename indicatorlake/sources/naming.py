"""Column names of a source table, and the closing steps every source shares."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lineage columns, and letters and signs that do not decompose into ASCII.
LINEAGE = ("afs_source_code", "afs_source_updated_at", "afs_source_ingested_at")

FOLDED = str.maketrans({"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D",
                        "ð": "d", "þ": "th", "ł": "l", "Ł": "L", "ı": "i", "°": "deg", "€": "EUR"})


def slug(name: str) -> str:
    """Lower-case ASCII words joined by underscores."""
    text = html.unescape(name.replace("\x00", "").strip())
    text = unicodedata.normalize("NFKD", text.translate(FOLDED)).encode("ascii", "ignore").decode().lower()
    text = re.sub(r"(?<=\d),(?=\d)", "", text)
    return re.sub(r"[^a-z0-9]+", "_", text).strip("_")


def slug_names(names: Sequence[str | None]) -> list[str]:
    """Unique slugs: blanks become ``unnamed_{i}``, repeats get the next free ``_1``, ``_2``."""
    taken: set[str] = set()
    result = []
    for i, name in enumerate(names):
        base = slug(name or "") or f"unnamed_{i}"
        candidate, n = base, 0
        while candidate in taken:
            n += 1
            candidate = f"{base}_{n}"
        taken.add(candidate)
        result.append(candidate)
    return result


def source_table(df: DataFrame, lineage: dict[str, str]) -> DataFrame:
    """Slugged names, all columns as text, lineage columns added or overwritten."""
    named = df.toDF(*slug_names(df.columns))
    text = named.select([F.col(c).cast("string").alias(c) for c in named.columns])
    return text.withColumns({k: F.lit(v).cast("string") for k, v in lineage.items()})
