"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; it is deleted when the application ends.

    Only a local session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL.setdefault("base", "file://" + tempfile.mkdtemp(prefix="llm-"))
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.deleteOnExit(where)
    return store.makeQualified(where).toString()


def stored(df: DataFrame, name: str, row_group: int = 0) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there.

    ``row_group``: bytes of a row group, the least that a task can read of a file.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    (df.write.option("parquet.block.size", row_group) if row_group else df.write).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more; other frames are left alone."""
    for table in tables:
        path = table.__dict__.pop("_stored_at", None)
        if path:
            spark = table.sparkSession
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def bit_filter(keys: DataFrame, column: str, log2_bits: int = 23) -> np.ndarray:
    """Bitmap of ``column`` (64-bit hashes): bit ``key & mask`` is set for each key.

    Its size is fixed (1 MB for 23), so it can be sent to every task however many
    keys there are. A full bitmap lets everything pass: it only saves work ahead
    of an exact join and never decides.
    """
    mask = (1 << log2_bits) - 1
    bit = F.col(column).bitwiseAND(F.lit(mask))
    words = (
        keys.where(F.col(column).isNotNull())
        .select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 AS int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # at most 2 ** (log2_bits - 6) rows
    )
    out = np.zeros(1 << (log2_bits - 6), np.int64)
    out[words.column("word").to_numpy().astype(np.int64)] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True where ``keys`` (uint64) may be among the keys of the bitmap."""
    at = keys & np.uint64(bits.size * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
