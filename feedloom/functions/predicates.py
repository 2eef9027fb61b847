"""Row predicates shared by profiling and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, NumericType, StringType, VariantType

from feedloom.functions.text import has_text


def falsy(df: DataFrame, name: str) -> Column:
    """L4: Python falsiness of a field: None, '', [], {}, 0, false, or absent."""
    if name not in df.columns:
        return F.lit(True)
    col = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, StringType):
        return col.isNull() | (col == "")
    if isinstance(dtype, (ArrayType, MapType)):
        return col.isNull() | (F.size(col) == 0)
    if isinstance(dtype, BooleanType):
        return F.coalesce(~col, F.lit(True))
    if isinstance(dtype, NumericType):
        return col.isNull() | (col == 0)
    if isinstance(dtype, VariantType):
        t = F.schema_of_variant(col)
        return (
            F.when(col.isNull() | F.is_variant_null(col), F.lit(True))
            .when(t == "STRING", F.try_variant_get(col, "$", "string") == "")
            .when(t == "BOOLEAN", ~F.try_variant_get(col, "$", "boolean"))
            .when(t.startswith("ARRAY"), F.size(F.try_variant_get(col, "$", "array<variant>")) == 0)
            .when(t.startswith("OBJECT"), F.to_json(col) == "{}")
            .otherwise(F.try_variant_get(col, "$", "double") == 0)
        )
    return col.isNull()


def blank_text(col: Column) -> Column:
    """Null -> '', then nothing but whitespace."""
    return ~has_text(F.coalesce(col, F.lit("")))


def missing_value(df: DataFrame, name: str) -> Column:
    """L3 on a field of any type: absent, null, JSON null, or the empty string."""
    if name not in df.columns:
        return F.lit(True)
    col = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, VariantType):
        return (col.isNull() | F.is_variant_null(col)
                | F.coalesce((F.schema_of_variant(col) == "STRING")
                             & (F.try_variant_get(col, "$", "string") == ""), F.lit(False)))
    if isinstance(dtype, StringType):
        return col.isNull() | (col == "")
    return col.isNull()
