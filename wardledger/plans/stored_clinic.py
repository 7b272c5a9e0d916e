"""The batch run over clinical tables derived from a folder, and queries over its tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..layout import LAYERS, Layout
from ..operators.profile import ANSWERS_SUFFIX, list_tables, row_counts
from ..session import shared_folder
from ..sources import derived
from ..sources.readers import load_bronze
from ..sources.schemas import CODE_LISTS
from ..sources.sinks import LOAD_DATE, overwrite_interval
from .dashboard import Queries
from .derived_clinic import DerivedClinic
from .medallion import Medallion

#: Three loads that together cover the feed.
LOADS = (("2026-07-01", "2026-07-04"), ("2026-07-04", "2026-07-09"), ("2026-07-09", "2026-07-13"))
RELOADED = ("2026-07-04", "2026-07-09")
EMPTIED = "2026-07-05"


def _environment(spark: SparkSession) -> Layout:
    """An environment of its own: runs of one session do not meet."""
    name = f"__run_{uuid.uuid4().hex[:12]}"
    return Layout(name, shared_folder(spark, "clinic"))


class StoredClinic:
    """Bronze, silver and gold tables of all source tables, written once a session and folder."""

    _built: dict[tuple[str, str], StoredClinic] = {}

    def __init__(self, spark: SparkSession, folder: str) -> None:
        clinic = DerivedClinic(spark, folder)
        self.job = Medallion(spark, _environment(spark))
        self.spark = self.job.spark
        feed = derived.parquet_relation(spark, folder, by_range=True)
        self.job.run(
            lambda table: derived.raw_table(spark, feed, table, feed=True),
            *derived.FEED_DAYS,
            clinic.rule_registry(),
            {name: clinic.code_list(name) for name in CODE_LISTS},
            derived.AS_OF,
        )

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> StoredClinic:
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._built:
            cls._built[key] = cls(spark, folder)
        return cls._built[key]

    def queries(self) -> Queries:
        return Queries.over(self.spark, self.job.layout)

    def table(self, layer: str, name: str) -> DataFrame:
        return self.job.table(layer, name)

    def rejects(self) -> DataFrame:
        return self.spark.table(self.job.layout.table("silver", "flatten_rejects"))

    def profile(self) -> DataFrame:
        """Row counts of every stored table that discovery finds in the three layers, read from file footers.

        The answers are left out: their views parse at every read.
        """
        names = [(layer, name) for layer in LAYERS for name in list_tables(self.spark, self.job.layout.database(layer))]
        return row_counts({f"{layer}.{n}": self.table(layer, n) for layer, n in names if not n.endswith(ANSWERS_SUFFIX)})


def merged_master(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Current state of a master table after three loads, each merged into the state before."""
    clinic, layout = DerivedClinic(spark, folder), _environment(spark)
    job = Medallion(spark, layout)
    source = load_bronze(derived.raw_table(spark, clinic.base, table, feed=True), table)
    for start, end in LOADS:
        overwrite_interval(source, layout.table("bronze", table), start, end)
        job.merge_master(table, start, end)
    return job.table("silver", table)


def reloaded_interval(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A history table after a load, a reload that brings fewer rows of some days, and none of one of them."""
    clinic, layout = DerivedClinic(spark, folder), _environment(spark)
    layout.create(spark)
    target = layout.table("bronze", table)
    source = load_bronze(derived.raw_table(spark, clinic.base, table, feed=True), table)
    overwrite_interval(source, target, *derived.FEED_DAYS)
    fewer = source.where((F.length("name") % 2 == 0) & (F.to_date("modified") != F.lit(EMPTIED).cast("date")))
    overwrite_interval(fewer, target, *RELOADED)
    return spark.table(target).drop(LOAD_DATE)
