"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A payload that repeats a key is read, the last value counts; else its row would be lost.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles methods above 8000 bytes; past that, Spark's split
    # projections are faster than one large generated method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go with the query that made them; else they pile up until the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A task keeps the files of so many partitions open, so that a write of days needs no sort.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}
#: Set in sessions that were built elsewhere, too.
TUNED = (
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.variant.allowDuplicateKeys",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
    "spark.sql.maxConcurrentOutputFileWriters",
)


def build_session(app: str = "wardledger", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs expect; shuffle sizing is left to AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Settings for a session that was built elsewhere.

    AQE only merges shuffle partitions, so on a large cluster it has to start from
    more than the default 200; small sessions keep their own number.
    """
    for name in TUNED:
        spark.conf.set(name, DEFAULTS[name])
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    cores = spark.sparkContext.defaultParallelism
    if spark.conf.get(start, None) is None and cores > 64:
        spark.conf.set(start, str(4 * cores))
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; it is deleted when the application ends.

    Only a local session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="wardledger-")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.deleteOnExit(where)
    return store.makeQualified(where).toString()
