from .bags import bag
from .scalars import (
    extract,
    is_blank,
    m49_key,
    na_to_null,
    pad_m49,
    publish_date,
    safe_double,
    safe_int,
    source_version,
    strict_timestamp,
    strip,
    strip_dot_zero,
    strip_quote,
    text_out,
)
from .years import YEAR_RULES, afs_year

__all__ = [
    "YEAR_RULES",
    "afs_year",
    "bag",
    "extract",
    "is_blank",
    "m49_key",
    "na_to_null",
    "pad_m49",
    "publish_date",
    "safe_double",
    "safe_int",
    "source_version",
    "strict_timestamp",
    "strip",
    "strip_dot_zero",
    "strip_quote",
    "text_out",
]
