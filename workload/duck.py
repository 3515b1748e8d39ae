"""DuckDB spellings of the shared building blocks, written apart from the library."""

from __future__ import annotations

from indicatorlake.plans.specs import BAGS, SPECS

from .standins import AREAS, INGESTED_AT, OBSERVATIONS, UPDATED_AT, raw_cells


def safe_int(x: str) -> str:
    return rf"CASE WHEN regexp_full_match({x}, '\s*[+-]?\d+\s*') THEN TRY_CAST({x} AS BIGINT) END"


def safe_double(x: str) -> str:
    pattern = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
    return f"CASE WHEN regexp_full_match({x}, '{pattern}') THEN TRY_CAST({x} AS DOUBLE) END"


def bag(entries: list[tuple[str, str]]) -> str:
    if not entries:
        return "'{}'"
    pairs = ", ".join(f"'{key}', {value}" for key, value in entries)
    return f"CAST(json_merge_patch('{{}}', json_object({pairs})) AS VARCHAR)"


YEARS = {
    "plain": lambda a: safe_int(a),
    "last_four": lambda a: safe_int(f"right({a}, 4)"),
    "range_end": lambda a: safe_int(rf"nullif(regexp_extract({a}, '(\d{{4}})\s*$', 1), '')"),
    "leading": lambda a: safe_int(rf"nullif(regexp_extract({a}, '^(\d{{4}})', 1), '')"),
    "end_or_start": lambda a, b: f"coalesce({safe_int(a)}, {safe_int(b)})",
    "census": lambda a: f"""CASE WHEN length({a}) = 4 THEN CAST({a} AS BIGINT)
        WHEN {a} IS NOT NULL THEN CAST(CAST(CAST({a}[1:2] AS BIGINT)
             + CASE WHEN CAST({a}[5:6] AS BIGINT) < CAST({a}[3:4] AS BIGINT) THEN 1 ELSE 0 END AS VARCHAR)
             || {a}[5:6] AS BIGINT) END""",
}


def quoted(name: str) -> str:
    return f'"{name}"'


def source_sql(code: str) -> str:
    """WITH-clause body: obs, raw and areas for one view."""
    cells = ", ".join(f"{e} AS {quoted(n)}" for n, e in raw_cells(SPECS[code]).items())
    return f"obs AS ({OBSERVATIONS}), raw AS (SELECT {cells} FROM obs), areas AS ({AREAS})"


def view_sql(code: str) -> str:
    """SELECT text of one harmonised view over the relations of ``source_sql``."""
    spec = SPECS[code]
    rows = "raw"
    if spec.measures:
        rest = ", ".join(quoted(c) for c in raw_cells(spec) if c not in spec.measures)
        parts = [
            f"SELECT {rest}, '{m}' AS measure, {quoted(m)} AS value FROM raw WHERE {quoted(m)} IS NOT NULL"
            for m in spec.measures
        ]
        rows = f"({' UNION ALL '.join(parts)})"
    back = {new: old for old, new in spec.renames.items()}

    def col(name: str) -> str:
        if name == "survey_year":
            return "right(survey_code, 4)"
        return quoted(back.get(name, name))

    def text(name: str | None, na: bool) -> str:
        if name is None:
            return "CAST(NULL AS VARCHAR)"
        return f"nullif({col(name)}, 'NA')" if na else col(name)

    area = col(spec.area)
    code_text = f"regexp_replace({area}, '^''', '')" if spec.area_rule == "m49" else area
    padded = f"CASE WHEN length({code_text}) < 3 THEN lpad({code_text}, 3, '0') ELSE {code_text} END"
    key = {"m49": padded, "m49_plain": padded, "survey": f"left({area}, 3)", "iso3": area}[spec.area_rule]
    ref = code_text if spec.area_ref == "raw" else key
    on = "iso3c" if spec.area_rule == "iso3" else "m49_code"
    unit = text(spec.unit, spec.na_values)
    if spec.unit_when:
        column, values, label = spec.unit_when
        unit = f"CASE WHEN {column} IN ({', '.join(repr(v) for v in values)}) THEN '{label}' END"
    bags = ", ".join(
        bag([(k, key if c == "@" else text(c, na)) for k, c, na in spec.entries(b)]) + f" AS {quoted(b)}"
        for b in BAGS
    )
    return f"""
    SELECT a.m49_code AS afs_m49_code, a.iso3c AS afs_iso3c, {ref} AS area_ref,
           {text(spec.area_name, spec.na_values)} AS area_name,
           {YEARS[spec.year[0]](*[col(c) for c in spec.year[1:]])} AS afs_year,
           {safe_double(col(spec.value))} AS afs_value, {col(spec.value)} AS value,
           {unit} AS afs_unit, {text(spec.flag, spec.na_values)} AS afs_flag, {bags},
           '{code}' AS afs_source_code, '{UPDATED_AT}' AS afs_source_updated_at,
           CAST(CAST('{INGESTED_AT}' AS TIMESTAMP) AS VARCHAR) AS afs_source_ingested_at
    FROM {rows} AS r LEFT JOIN areas AS a ON {key} = a.{on}"""


def view_query(code: str) -> str:
    return f"WITH {source_sql(code)} {view_sql(code)}"
