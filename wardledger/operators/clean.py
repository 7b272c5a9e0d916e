"""Typed projection, text cleaning, current-state and interval operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null


def typed_projection(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the columns of ``schema``, cast strictly: a bad value fails the job.

    The cast follows ``spark.sql.ansi.enabled`` (on by default), so Spark itself
    raises on text that is no number, date or timestamp.
    """
    return df.selectExpr(
        *[f"cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
    )


def clean_columns(schema: T.StructType, drop: tuple[str, ...] = (), keep_raw: tuple[str, ...] = ()) -> list[str]:
    """SQL text of the columns of ``schema``, with a blank-to-null trim of every text column."""
    out = []
    for f in schema.fields:
        if f.name in drop:
            continue
        name = f"`{f.name}`"
        is_text = isinstance(f.dataType, T.StringType) and f.name not in keep_raw
        out.append(f"{blank_to_null(name)} AS {name}" if is_text else name)
    return out


def clean_text(df: DataFrame, drop: tuple[str, ...] = (), keep_raw: tuple[str, ...] = ()) -> DataFrame:
    """Blank-to-null trim of every text column in one projection."""
    return df.selectExpr(*clean_columns(df.schema, drop, keep_raw))


def latest_per_key(df: DataFrame, key: str = "name", order_by: str = "modified") -> DataFrame:
    """Newest row of each key; equal times are settled by a hash of the row.

    ``row_number() = 1`` lets Spark place a group limit in front of the shuffle,
    so every map task sends one row per key however many versions a key has.
    """
    rank = (
        f"row_number() OVER (PARTITION BY `{key}` "
        f"ORDER BY `{order_by}` DESC NULLS LAST, xxhash64(*) DESC) AS _rank"
    )
    return df.selectExpr("*", rank).where("_rank = 1").drop("_rank")


def lost_winners(former: DataFrame, fresh: DataFrame, start: datetime | str, end: datetime | str, key: str = "name", order_by: str = "modified") -> DataFrame:
    """Keys (column ``_lost``) whose winner of ``[start, end)`` was replaced and that no row of ``fresh`` has."""
    replaced = interval_slice(former, start, end, order_by).select(F.col(key).alias("_lost"))
    present = fresh.select(F.col(key).alias("_present")).distinct()
    return replaced.join(present, F.col("_lost").eqNullSafe(F.col("_present")), "left_anti")


def merge_latest(
    former: DataFrame,
    fresh: DataFrame,
    start: datetime | str,
    end: datetime | str,
    lost: DataFrame | None = None,
    history: DataFrame | None = None,
    key: str = "name",
    order_by: str = "modified",
) -> DataFrame:
    """Newest row of each key after the rows of ``[start, end)`` were replaced by ``fresh``.

    ``former`` holds the newest rows before. Those of the interval no longer count: they
    are among ``fresh`` again, or their key fell back to an older row. Only for keys that
    ``fresh`` does not have either (``lost``) must ``history`` be looked at; later rows than
    a winner do not exist. A null key is one key.
    """
    outside = ~((F.col(order_by) >= ntz(start)) & (F.col(order_by) < ntz(end)))
    rows = former.where(F.coalesce(outside, F.lit(True))).unionByName(fresh.select(former.columns))
    if lost is not None and history is not None:
        older = history.where(F.col(order_by) < ntz(start)).select(former.columns)
        rows = rows.unionByName(older.join(lost, F.col(key).eqNullSafe(F.col("_lost")), "left_semi"))
    return latest_per_key(rows, key, order_by)


def current_state(df: DataFrame) -> DataFrame:
    """Newest version of each record (by its raw name), cleaned."""
    return clean_text(latest_per_key(df))


def ntz(value: datetime | str) -> Column:
    """Zone-free timestamp literal."""
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp_ntz")


def interval_slice(
    df: DataFrame, start: datetime | str, end: datetime | str, column: str = "modified"
) -> DataFrame:
    """Rows with ``start <= column < end``."""
    return df.where((F.col(column) >= ntz(start)) & (F.col(column) < ntz(end)))
