"""Scans: source tables, reference code lists and the rule registry."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.text import blank_to_null
from ..operators.clean import interval_slice, typed_projection
from .schemas import bronze_schema, code_list_schema

# ---- fixed values: columns of the rule registry -----------------------------
RULE = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("audit_domain", T.StringType()),
        T.StructField("focus_area", T.StringType()),
        T.StructField("rule_basis", T.StringType()),
        T.StructField("authority_name", T.StringType()),
        T.StructField("authority_reference", T.StringType()),
        T.StructField("standard_name", T.StringType()),
        T.StructField("standard_version", T.StringType()),
        T.StructField("rule_expression", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("effective_from", T.DateType()),
        T.StructField("effective_to", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
BLANK_IS_NULL = (
    "authority_name",
    "authority_reference",
    "standard_name",
    "standard_version",
    "effective_to",
)
# ---- end of fixed values ----------------------------------------------------

RULES_CSV = str(Path(__file__).with_name("rule_registry.csv"))


def read_source(
    spark: SparkSession, table: str, location: str | None = None, jdbc: dict[str, str] | None = None
) -> DataFrame:
    """One source table, from Parquet files or over JDBC.

    ``jdbc`` takes Spark's JDBC options. ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` spread the read over executors; filters
    on the result are pushed to the database.
    """
    if jdbc is not None:
        return spark.read.format("jdbc").options(**{"dbtable": table, **jdbc}).load()
    return spark.read.parquet(f"{location}/{table}")


def load_bronze(
    source: DataFrame, table: str, start: datetime | str | None = None, end: datetime | str | None = None
) -> DataFrame:
    """Typed rows of a source table, of one ``[start, end)`` interval when given."""
    typed = typed_projection(source, bronze_schema(table))
    return typed if start is None else interval_slice(typed, start, end)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line, quotes doubled inside quotes, columns by position.

    An empty cell, quoted or not, is NULL.
    """
    return spark.read.csv(
        path, schema=schema, header=True, quote='"', escape='"', multiLine=False, enforceSchema=True
    )


def read_code_list(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the reference code lists; every column stays text."""
    return read_csv(spark, path, code_list_schema(name))


def typed_rules(raw: DataFrame) -> DataFrame:
    """Registry rows (all text) to their types, blank optional cells to NULL."""
    out = []
    for f in RULE.fields:
        cell = blank_to_null(f.name) if f.name in BLANK_IS_NULL else f.name
        out.append(f"cast({cell} AS {f.dataType.simpleString()}) AS {f.name}")
    return raw.selectExpr(*out)


def raw_rule_schema() -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in RULE.fields])


def read_rules(spark: SparkSession, path: str = RULES_CSV) -> DataFrame:
    """The rule registry, typed."""
    return typed_rules(read_csv(spark, path, raw_rule_schema()))


def day_of(value: datetime | date | str) -> str:
    """``yyyy-MM-dd`` of a day boundary; anything else is refused."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()
    day, _, clock = text.replace("T", " ").partition(" ")
    if clock.strip("0:. "):
        raise ValueError(f"not a day boundary: {value}")
    return date.fromisoformat(day).isoformat()
