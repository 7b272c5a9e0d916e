"""Gold layer: findings and the run snapshot."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import latest_per_key, ntz

# ---- fixed values: tables a run counts --------------------------------------
SCANNED = (
    "tabPatient",
    "condition_fhir_resource",
    "observation_fhir_resource",
    "procedure_fhir_resource",
    "encounter_fhir_resource",
)
NO_VALUE = "NA"
RUN_STATUS = "SUCCESS"
# ---- end of fixed values ----------------------------------------------------


def day_totals(rows: DataFrame, name: str, day: str | None = None) -> DataFrame:
    """``table_name``, ``row_count`` and ``newest`` of some rows by day of change (``day``: of all of them, without a day)."""
    counts = [F.count("*").alias("row_count"), F.max("modified").alias("newest")]
    if day is not None:
        return rows.agg(*counts).select(F.lit(name).alias("table_name"), "row_count", "newest")
    by_day = rows.groupBy(F.to_date("modified").alias("load_date")).agg(*counts)
    return by_day.select(F.lit(name).alias("table_name"), "row_count", "newest", "load_date")


def finding_totals(findings: DataFrame) -> DataFrame:
    """Findings by what the dashboard counts: a few rows a rule, however many findings there are."""
    return findings.groupBy("rule_id", "audit_domain", "severity", "status").agg(
        F.count("*").alias("finding_count"),
        F.min("detected_at").alias("first_detected"),
        F.max("detected_at").alias("last_detected"),
    )


def audit_run(
    tables: Mapping[str, DataFrame], rules: DataFrame, findings: DataFrame, as_of: str
) -> DataFrame:
    """One row describing a run; equal data and rules give the equal ``audit_run_id``."""
    data = [day_totals(tables[name], name, "whole") for name in SCANNED]
    return run_from_totals(reduce(DataFrame.unionAll, data), rules, finding_totals(findings), as_of)


def run_from_totals(data: DataFrame, rules: DataFrame, found: DataFrame, as_of: str) -> DataFrame:
    """The run from the totals of its data and findings: no row of either is read again.

    Totals and active rules are laid side by side in one narrow union and reduced by a
    single aggregate.
    """
    no_stamp, no_int, no_count = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("int"), F.lit(None).cast("bigint")

    def row(df: DataFrame, **given: Column | str) -> DataFrame:
        empty = {"modified": no_stamp, "version": no_int, "first": no_stamp, "last": no_stamp, "scanned": no_count, "found": no_count}
        return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in {**empty, **given}.items()])

    totals = reduce(
        DataFrame.unionAll,
        [
            row(data, modified="newest", scanned="row_count"),
            row(rules.where(F.col("status") == "ACTIVE"), version="version"),
            row(found, first="first_detected", last="last_detected", found="finding_count"),
        ],
    ).agg(
        F.max("modified").cast("string").alias("data_snapshot"),
        F.max("version").cast("string").alias("rule_set_version"),
        F.min("first").alias("first_detected"),
        F.max("last").alias("last_detected"),
        F.coalesce(F.sum("scanned"), F.lit(0)).alias("records_scanned"),
        F.coalesce(F.sum("found"), F.lit(0)).alias("findings_created"),
    )
    return totals.select(
        F.md5(
            F.concat(
                F.coalesce("data_snapshot", F.lit(NO_VALUE)),
                F.lit("|"),
                F.coalesce("rule_set_version", F.lit(NO_VALUE)),
            )
        ).alias("audit_run_id"),
        F.coalesce("first_detected", ntz(as_of)).alias("started_at"),
        F.coalesce("last_detected", ntz(as_of)).alias("finished_at"),
        "rule_set_version",
        "data_snapshot",
        F.lit(RUN_STATUS).alias("status"),
        "records_scanned",
        "findings_created",
    )


def newest_versions(flat: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """Option: only the newest version of each document of a flat table.

    By default a document edited in two intervals keeps both rows and its
    findings fire twice under the same ``finding_id``.
    """
    keyed = flat.withColumn("_grain", F.struct(*grain))
    return latest_per_key(keyed, key="_grain").drop("_grain")
