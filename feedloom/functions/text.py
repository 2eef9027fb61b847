"""Text normalisation (F1-F3) as column expressions.

Python's ``str.split()`` / ``str.strip()`` treat every character with
``str.isspace()`` as whitespace: the Unicode White_Space set plus the four
ASCII separators U+001C..U+001F.  Java's ``\\s`` is ASCII-only and Spark's
``trim`` removes spaces only, so the class is built here from that rule and
spelled with ``\\x{...}`` escapes, which both Java regex and RE2 (the DuckDB
oracle) accept.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, VariantType


def _whitespace_ranges() -> list[tuple[int, int]]:
    points = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    ranges: list[tuple[int, int]] = []
    for c in points:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1] = (ranges[-1][0], c)
        else:
            ranges.append((c, c))
    return ranges


def _class_body() -> str:
    parts = []
    for lo, hi in _whitespace_ranges():
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "".join(parts)


WS_CLASS = "[" + _class_body() + "]"
WS_RUN = WS_CLASS + "+"
NON_WS = "[^" + _class_body() + "]"


def normalise_ws(col: Column) -> Column:
    """Collapse every whitespace run to one space and strip both ends."""
    return F.trim(F.regexp_replace(col, WS_RUN, " "))


def has_text(col: Column) -> Column:
    """True when the string holds a non-whitespace character (Python ``s.strip()`` truthy)."""
    return col.rlike(NON_WS)


def _variant_part_kept(x: Column) -> Column:
    # Python keeps a list element when it is truthy: drop null, "", 0, false,
    # [] and {}; keep everything else.  The element's JSON type decides.
    t = F.schema_of_variant(x)
    return (
        F.when(F.is_variant_null(x), F.lit(False))
        .when(t == "STRING", F.try_variant_get(x, "$", "string") != "")
        .when(t == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
        .when(t.startswith("ARRAY"), F.size(F.try_variant_get(x, "$", "array<variant>")) > 0)
        .when(t.startswith("OBJECT"), F.to_json(x) != "{}")
        .otherwise(F.try_variant_get(x, "$", "double") != 0)
    )


def _variant_part_text(x: Column) -> Column:
    t = F.schema_of_variant(x)
    return F.when(t == "STRING", F.try_variant_get(x, "$", "string")).otherwise(F.to_json(x))


def join_text_variant(col: Column) -> Column:
    """F1 over a VARIANT field: string as is, list joined, anything else ''."""
    t = F.schema_of_variant(col)
    parts = F.try_variant_get(col, "$", "array<variant>")
    joined = F.array_join(
        F.transform(F.filter(parts, _variant_part_kept), _variant_part_text), " ")
    raw = (
        F.when(col.isNull() | F.is_variant_null(col), F.lit(""))
        .when(t == "STRING", F.try_variant_get(col, "$", "string"))
        .when(t.startswith("ARRAY"), joined)
        .otherwise(F.lit(""))
    )
    return normalise_ws(raw)


def join_text(df: DataFrame, name: str) -> Column:
    """F1 ``join_text``: the column's type decides how it becomes one normalised string.

    string -> normalised; array<string> -> non-empty parts joined by a space, then
    normalised; VARIANT -> decided per row; any other type -> ''.  Missing
    columns behave like a missing JSON key ('').
    """
    if name not in df.columns:
        return F.lit("")
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, StringType):
        return normalise_ws(F.coalesce(col, F.lit("")))
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StringType):
        kept = F.filter(col, lambda x: x.isNotNull() & (x != ""))
        return normalise_ws(F.coalesce(F.array_join(kept, " "), F.lit("")))
    if isinstance(dtype, VariantType):
        return join_text_variant(col)
    return F.lit("")


def item_text(*parts: Column) -> Column:
    """the non-empty normalised parts joined by one space ('' when all empty)."""
    return F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])
