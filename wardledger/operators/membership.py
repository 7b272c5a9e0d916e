"""Rows whose key is not in another table.

The other table is reduced to its distinct keys, which a batch run stores once. The rest
is one plain join: the sizes of stored keys let the planner broadcast them or not, and a
key held by a third of all rows is split at run time, since only the side of the key set
has to hold each key once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.text import populated


def key_set(df: DataFrame, key: str) -> DataFrame:
    """Distinct populated values of the SQL text ``key`` as the column ``_key``."""
    return df.selectExpr(f"{key} AS _key").where(populated("_key")).distinct()


def without_match(child: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Rows of ``child`` with a populated ``key`` that is not in ``known``, duplicates included."""
    keyed = child.selectExpr("*", f"{key} AS _key").where(populated("_key"))
    return keyed.join(known, "_key", "left_anti").drop("_key")
