"""Writes: tables that are replaced in one step, views and CSV exports.

Data lie in a store database beside the layer; what a reader opens is a view in the layer
that names the current build. A new build is written first and the view is switched when
it is complete, so a reader sees the old rows or the new ones. The build before stays
until the next write, for those who still read it. What a failed run leaves is in the
store only, and the next write drops it. One job writes a table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..layout import database_of, store_of
from ..operators.clean import interval_slice
from .readers import day_of

LOAD_DATE = "load_date"
BUILD = "_build"
PROPERTY = "wardledger."
# An interval of so many days is written by the tasks that read it; the rows of a longer one are brought together by day.
DIRECT_DAYS = 15
# A row group is held in memory for each open file, so it is small. Payloads repeat most of their text, which the
# higher level finds.
# Nearly every one of these texts is unlike the others, so a dictionary of them is built only to be given up.
DISTINCT_TEXTS = ("payload_json", "api_response")
FILES = {
    "compression": "zstd", "parquet.compression.codec.zstd.level": 9, "parquet.block.size": 16 << 20,
    **{f"parquet.enable.dictionary#{name}": "false" for name in DISTINCT_TEXTS},
}


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    """What the last switch of a view noted; nothing for a view that does not exist."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"].removeprefix(PROPERTY): r["value"] for r in rows if r["key"].startswith(PROPERTY)}


def _switch(spark: SparkSession, table: str, select: str, **noted: object) -> None:
    """The commit: one statement of the catalog."""
    properties = ", ".join(f"'{PROPERTY}{k}' = '{v}'" for k, v in noted.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({properties}) AS {select}")


def _in_store(spark: SparkSession, table: str, ending: str) -> str:
    """Name in the store, which is made if it is not there."""
    store = store_of(database_of(table))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{store}`")
    return f"{store}.{table.rpartition('.')[2]}_{ending}"


def overwrite_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    buckets: tuple[int, str] | None = None,
    shown: Sequence[str] | None = None,
) -> None:
    """Full rebuild. ``df`` may read the build that it replaces.

    ``shown``: SQL text of the columns that the view has, all of ``df`` if left out.
    ``buckets``: number and column, by which a reader of one value opens one bucket.
    """
    spark = df.sparkSession
    current = _properties(spark, table).get("build")
    prefix = _in_store(spark, table, "")
    store, _, start = prefix.rpartition(".")
    for row in spark.sql(f"SHOW TABLES IN `{store}`").collect():  # builds of all tables of one layer
        name, build = row["tableName"], row["tableName"][len(start) :]
        if name.startswith(start.lower()) and len(build) == 32 and build != current:
            spark.sql(f"DROP TABLE IF EXISTS {store}.{name}")
    build = uuid.uuid4().hex
    if buckets:
        # A task for each bucket; within the partitions that makes a file a bucket.
        df = df.repartition(buckets[0], buckets[1])
    writer = df.write.format("parquet").options(**FILES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets[0], buckets[1]).sortBy(buckets[1])
    writer.saveAsTable(f"{prefix}{build}")
    columns = ", ".join(shown or [f"`{c}`" for c in df.columns])
    _switch(spark, table, f"SELECT {columns} FROM {prefix}{build}", build=build)


def stored_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The rows behind the view of ``overwrite_table`` as they were written; None before the first build."""
    build = _properties(spark, table).get("build")
    return spark.table(_in_store(spark, table, build)) if build else None


def publish_view(spark: SparkSession, name: str, select: str) -> None:
    """A view of the catalog, which any session reads and which is computed anew at every read."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


_LOCK, _INSIDE = Lock(), [0, ""]


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """``insertInto`` takes the overwrite mode from the session, not from write options.

    Several tables may be written at a time: the last one out restores the mode.
    """
    name = "spark.sql.sources.partitionOverwriteMode"
    with _LOCK:
        if not _INSIDE[0]:
            _INSIDE[1] = spark.conf.get(name)
            spark.conf.set(name, "dynamic")
        _INSIDE[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _INSIDE[0] -= 1
            if not _INSIDE[0]:
                spark.conf.set(name, _INSIDE[1])


def _drop_dead(spark: SparkSession, held: str, noted: dict[str, str]) -> None:
    """Drop the partitions that the view does not show: of failed runs and of replaced days."""
    build = int(noted.get("build", 0))
    parts = spark.sql(f"SHOW PARTITIONS {held}").select(
        F.regexp_extract("partition", rf"{LOAD_DATE}=([0-9-]+)", 1).alias("day"),
        F.regexp_extract("partition", rf"{BUILD}=(\d+)", 1).cast("int").alias("build"),
    )
    replaced = F.col("day").between(noted.get("first", "9"), noted.get("last", "9")) & (F.col("day") < noted.get("last", "9"))
    dead = parts.where((F.col("build") > build) | (replaced & (F.col("build") < build))).distinct().collect()  # a row a day
    for row in dead:
        spark.sql(f"ALTER TABLE {held} DROP IF EXISTS PARTITION ({LOAD_DATE}='{row['day']}', {BUILD}={row['build']})")


def overwrite_interval(
    df: DataFrame,
    table: str,
    start: datetime | date | str,
    end: datetime | date | str,
    column: str = "modified",
    partition_by: Sequence[str] = (),
) -> None:
    """Replace what ``table`` holds of the days ``[start, end)`` by the rows of ``df``.

    The store is partitioned by day and build. The new rows are written, once, as partitions
    of the next build; the view then shows these and, of other days, what it showed before.
    So a repeated interval leaves no duplicates, an emptied day is empty and other days
    are neither read nor written.
    """
    spark = df.sparkSession
    first, last = day_of(start), day_of(end)
    held, noted = _in_store(spark, table, "days"), _properties(spark, table)
    known = spark.catalog.tableExists(held)
    if known:
        _drop_dead(spark, held, noted)
    build = int(noted.get("build", 0)) + 1
    # The range on the column itself reaches the source; the day is derived from it.
    days = interval_slice(df, first, last, column).withColumn(LOAD_DATE, F.to_date(column)).withColumn(BUILD, F.lit(build))
    own = [c for c in days.columns if c not in (*partition_by, LOAD_DATE, BUILD)]
    layout = [*own, LOAD_DATE, BUILD, *partition_by]
    rows = days.select(*layout)
    if (date.fromisoformat(last) - date.fromisoformat(first)).days > DIRECT_DAYS:
        # One file set per day; AQE spreads a day that holds most rows over several tasks.
        rows = rows.hint("rebalance", LOAD_DATE, *partition_by)
    if known:
        with _dynamic_overwrite(spark):
            rows.write.mode("overwrite").insertInto(held)
    else:
        rows.write.format("parquet").options(**FILES).partitionBy(LOAD_DATE, BUILD, *partition_by).saveAsTable(held)
    shown = ", ".join(f"`{c}`" for c in [*own, *partition_by, LOAD_DATE])
    replaced = f"{BUILD} < {build} AND {LOAD_DATE} >= DATE'{first}' AND {LOAD_DATE} < DATE'{last}'"
    select = f"SELECT {shown} FROM {held} WHERE {BUILD} <= {build} AND NOT ({replaced})"
    _switch(spark, table, select, build=build, first=first, last=last)


def read_interval(
    spark: SparkSession, table: str, start: datetime | date | str, end: datetime | date | str
) -> DataFrame:
    """Rows of the days ``[start, end)``; the filter prunes partitions."""
    first, last = F.lit(day_of(start)).cast("date"), F.lit(day_of(end)).cast("date")
    return (
        spark.table(table)
        .where((F.col(LOAD_DATE) >= first) & (F.col(LOAD_DATE) < last))
        .drop(LOAD_DATE)
    )


def export_csv(df: DataFrame, path: str) -> None:
    """Whole table as a directory of CSV files, written by all tasks."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def export_sample(df: DataFrame, path: str, rows: int = 5) -> None:
    """The first few rows as CSV."""
    export_csv(df.limit(rows), path)
