"""Table discovery, row counts and publishing."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..layout import Layout
from ..sources.sinks import publish_view

# ---- fixed values: gold tables open to readers, and the name endings --------
PUBLISHED = (
    "audit_rule",
    "audit_finding",
    "audit_run",
    "audit_check_identity_patient_uid_format",
    "audit_check_reference_integrity_condition_encounter",
    "audit_check_reference_integrity_observation_encounter",
    "audit_check_reference_integrity_procedure_encounter",
    "audit_check_structural_encounter_status",
    "audit_check_temporal_encounter_period",
    "audit_check_terminology_icd9cm_validity",
    "audit_check_terminology_icd10_validity",
)
FLAT_SUFFIX = "_fhir_resource"
ANSWERS_SUFFIX = "_submission_audit"
# ---- end of fixed values ----------------------------------------------------

LOG = logging.getLogger(__name__)


def list_tables(spark: SparkSession, database: str, suffix: str = "") -> list[str]:
    """Names of the tables of a database that end in ``suffix``, in order.

    Catalog names are lower case; source tables are matched without case.
    """
    found = spark.sql(f"SHOW TABLES IN `{database}`").where(~F.col("isTemporary"))
    return sorted(r["tableName"] for r in found.collect() if r["tableName"].endswith(suffix.lower()))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count, is_empty`` for each table, as one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts).withColumn("is_empty", F.col("row_count") == 0)


def read_error(df: DataFrame) -> str | None:
    """Why ``df`` cannot be read, found by a probe of one row; None if it can. Empty is readable."""
    try:
        df.limit(1).isEmpty()
        return None
    except Exception as error:  # whatever the source raises is the answer
        return f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"


def is_readable(df: DataFrame) -> bool:
    return read_error(df) is None


def publish(
    spark: SparkSession, layout: Layout, allowed: Iterable[str] = PUBLISHED, layer: str = "gold"
) -> DataFrame:
    """Expose allow-listed tables as views; report ``ready``, ``missing`` or ``failed`` and why.

    Views lie in a database of the environment, so those of two environments stand
    side by side and other sessions of the catalog read them. A table that does not exist is skipped and one that cannot be read
    does not stop the others.
    """
    report: list[tuple[str, str, str | None]] = []
    for name in allowed:
        full = layout.table(layer, name)
        if not spark.catalog.tableExists(full):
            report.append((name, "missing", None))
            continue
        table = spark.table(full)
        error = read_error(table)
        if error is None:
            publish_view(spark, layout.view(name), f"SELECT * FROM {full}")
        report.append((name, "failed" if error else "ready", error))
    return spark.createDataFrame(report, "table_name string, status string, reason string")


def health(spark: SparkSession, layout: Layout) -> dict[str, object]:
    """``ok`` when the findings can be read, else ``degraded``."""
    name = layout.table("gold", "audit_finding")
    reachable = False
    if spark.catalog.tableExists(name):
        error = read_error(spark.table(name))
        reachable = error is None
        if error:
            LOG.warning("%s cannot be read: %s", name, error)
    return {"status": "ok" if reachable else "degraded", "gold_reachable": reachable}
