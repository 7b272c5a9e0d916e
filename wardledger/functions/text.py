"""Small text expressions shared by the operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(name: str) -> str:
    """SQL text: trim spaces (only spaces, not tabs), an empty result is NULL."""
    return f"nullif(trim({name}), '')"


def populated(name: str) -> str:
    """SQL text: present and not blank after trimming."""
    return f"{name} IS NOT NULL AND trim({name}) <> ''"


def literal(text: str) -> str:
    """SQL text literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def filled(template: str) -> str:
    """SQL text of a template such as ``Code '{code}' unknown``; NULL in gives NULL."""
    parts = [
        f"cast({part[1:-1]} AS string)" if part.startswith("{") else literal(part)
        for part in re.split(r"(\{\w+\})", template)
        if part
    ]
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"


def listed_json(text: str, mark: str) -> str:
    """SQL text: VARIANT list of a JSON text and the text ``mark`` behind it; NULL when it is not readable."""
    return f"""try_parse_json(concat('[', {text}, ',"', {mark}, '"]'))"""


def strict_json(text: str) -> str:
    """SQL text: JSON text as VARIANT; NULL when it is not one whole value.

    The parser ignores what follows a value. Inside a list with a mark behind it,
    such a text leaves no list of two, so it is refused at the price of one parse.
    The mark is the hash of the text, which the text itself cannot hold.
    """
    mark = f"md5({text})"
    pair = f"array(try_variant_get({listed_json(text, mark)}, '$', 'array<variant>'))"
    own = f"size(p) = 2 AND try_variant_get(p[1], '$', 'string') = {mark}"
    return f"get(transform({pair}, p -> CASE WHEN {own} THEN p[0] END), 0)"


def timestamp_text(column: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def nested_to_json(df: DataFrame) -> DataFrame:
    """Replace struct, array and map columns by their JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def timestamps_to_text(df: DataFrame) -> DataFrame:
    """Replace timestamp columns by their text; everything else passes through."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            timestamp_text(f.name).alias(f.name) if isinstance(f.dataType, stamps) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
