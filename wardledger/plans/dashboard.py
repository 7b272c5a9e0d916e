"""The seven parameterised queries over the gold tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..layout import Layout
from ..operators.clean import ntz
from ..operators.profile import health
from .audit import finding_totals

MAX_LIMIT = 200

# ---- fixed values: result columns -------------------------------------------
LIST_COLUMNS = (
    "finding_id rule_id audit_domain focus_area entity_type entity_id patient_id encounter_id "
    "actual_value expected_value severity status detected_at source_system"
).split()
DETAIL_COLUMNS = (
    "finding_id rule_id rule_name rule_basis authority_name authority_reference standard_name "
    "standard_version audit_domain focus_area entity_type entity_id patient_id encounter_id "
    "actual_value expected_value severity status detected_at resolved_at source_system "
    "source_record_id evidence_reference explanation reviewer_id review_note resolution_code"
).split()
RULE_COLUMNS = (
    "rule_id rule_name description audit_domain focus_area rule_basis authority_name "
    "authority_reference standard_name standard_version severity status version"
).split()
PROVENANCE = ("rule_name rule_basis authority_name authority_reference standard_name standard_version").split()
# ---- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Spec:
    required: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()
    defaults: dict[str, Any] = field(default_factory=dict)


SPECS: dict[str, Spec] = {
    "audit_overview": Spec(),
    "findings_summary": Spec(),
    "findings_by_domain": Spec(),
    "top_recurring_rules": Spec(defaults={"limit": 10}),
    "list_findings": Spec(
        nullable=("audit_domain", "rule_id", "severity", "status", "after_detected_at", "after_finding_id"), defaults={"limit": 25, "offset": 0}
    ),
    "finding_detail": Spec(required=("finding_id",)),
    "list_audit_rules": Spec(),
}


def checked(action: str, params: dict[str, Any]) -> dict[str, Any]:
    """Parameters of a query with defaults filled in, or ``ValueError``."""
    if action not in SPECS:
        raise ValueError(f"unknown query: {action}")
    spec = SPECS[action]
    values: dict[str, Any] = {}
    for name in (*spec.required, *spec.nullable, *spec.defaults):
        value = params.get(name)
        value = spec.defaults.get(name) if value is None else value
        if value is None and name not in spec.nullable:
            raise ValueError(f"missing parameter: {name}")
        values[name] = value
    for name in ("limit", "offset"):
        if name in values and (not isinstance(values[name], int) or isinstance(values[name], bool)):
            raise ValueError(f"{name} must be an integer")
        if values.get(name, 0) < 0:
            raise ValueError(f"{name} must not be negative")
    if (values.get("after_detected_at") is None) != (values.get("after_finding_id") is None):
        raise ValueError("after_detected_at and after_finding_id go together")
    if values.get("limit", 0) > MAX_LIMIT:
        raise ValueError(f"limit must not exceed {MAX_LIMIT}")
    return values


class Queries:
    """Queries over ``audit_rule``, ``audit_finding`` and ``audit_run``.

    ``totals`` (see ``finding_totals``) may be stored: then no finding is read to count them.
    """

    def __init__(
        self, rule: DataFrame, finding: DataFrame | None = None, run: DataFrame | None = None, totals: DataFrame | None = None
    ) -> None:
        self.rule, self.finding, self.run_row = rule, finding, run
        self.totals = finding_totals(finding) if totals is None and finding is not None else totals

    @classmethod
    def over(cls, spark: SparkSession, layout: Layout) -> "Queries":
        """The stored gold tables of an environment."""
        names = [layout.table("gold", t) for t in ("audit_rule", "audit_finding", "audit_run")]
        return cls(*[spark.table(t) for t in [*names, layout.stored("gold", "finding_totals")]])

    def run(self, action: str, **params: Any) -> DataFrame:
        """Validate the parameters and build the query."""
        values = checked(action, params)
        method: Callable[..., DataFrame] = getattr(self, action)
        return method(**values)

    def audit_overview(self) -> DataFrame:
        """The run with the number of active and of all rules (scalar subqueries)."""
        counts = self.rule.agg(
            F.count_if(F.col("status") == "ACTIVE").alias("active"), F.count("*").alias("total")
        )
        return self.run_row.select(
            "records_scanned",
            "rule_set_version",
            "data_snapshot",
            "status",
            "started_at",
            "finished_at",
            counts.select("active").scalar().alias("applicable_checks"),
            counts.select("total").scalar().alias("total_rules_in_registry"),
        )

    def findings_summary(self) -> DataFrame:
        status, severity = F.col("status"), F.col("severity")

        def counted(wanted: Column, name: str) -> Column:
            return F.coalesce(F.sum(F.when(wanted, F.col("finding_count"))), F.lit(0)).alias(name)

        return self.totals.agg(
            counted(F.lit(True), "total"),
            counted(status == "OPEN", "open"),
            counted(status == "UNDER_REVIEW", "under_review"),
            counted(status == "RESOLVED", "resolved"),
            counted(severity == "HIGH", "high_severity"),
            counted(severity == "MEDIUM", "medium_severity"),
            counted(severity == "LOW", "low_severity"),
        )

    def findings_by_domain(self) -> DataFrame:
        count = F.col("finding_count")
        return (
            self.totals.groupBy("audit_domain")
            .agg(
                F.sum(count).alias("total_findings"),
                F.sum(F.when(F.col("status") == "OPEN", count).otherwise(0)).alias("open_findings"),
                F.sum(F.when(F.col("severity") == "HIGH", count).otherwise(0)).alias("high_severity_findings"),
            )
            .orderBy(F.col("total_findings").desc(), F.col("audit_domain").asc_nulls_last())
        )

    def top_recurring_rules(self, limit: int = 10) -> DataFrame:
        """Counted per rule before the registry is joined, so the join is tiny."""
        counts = self.totals.groupBy("rule_id").agg(F.sum("finding_count").alias("finding_count"))
        named = self.rule.select("rule_id", "rule_name", "severity")
        return (
            counts.join(named, "rule_id", "left")
            .select("rule_id", "rule_name", "severity", "finding_count")
            .orderBy(F.col("finding_count").desc(), F.col("rule_id").asc_nulls_last())
            .limit(limit)
        )

    def list_findings(
        self,
        audit_domain: str | None = None,
        rule_id: str | None = None,
        severity: str | None = None,
        status: str | None = None,
        limit: int = 25,
        offset: int = 0,
        after_detected_at: datetime | str | None = None,
        after_finding_id: str | None = None,
    ) -> DataFrame:
        """A page of findings, newest first and then by id.

        ``after_detected_at`` and ``after_finding_id`` are those of the last finding of the
        page before: what lies before is filtered out, not sorted, however deep the page
        is. ``offset`` counts from the first finding (or from there).
        """
        wanted = {"audit_domain": audit_domain, "rule_id": rule_id, "severity": severity, "status": status}
        found = self.finding.select(*LIST_COLUMNS)
        for name, value in wanted.items():
            if value is not None:
                found = found.where(F.col(name) == value)
        if after_finding_id is not None:
            at = ntz(after_detected_at)
            same = (F.col("detected_at") == at) & (F.col("finding_id") > after_finding_id)
            found = found.where((F.col("detected_at") < at) | same)
        order = [F.col("detected_at").desc(), F.col("finding_id").asc_nulls_last()]
        return found.orderBy(*order).offset(offset).limit(limit)

    def finding_detail(self, finding_id: str) -> DataFrame:
        rule = self.rule.select("rule_id", *PROVENANCE)
        return (
            self.finding.where(F.col("finding_id") == finding_id)
            .join(rule, "rule_id", "left")
            .select(*DETAIL_COLUMNS)
        )

    def list_audit_rules(self) -> DataFrame:
        return self.rule.select(*RULE_COLUMNS).orderBy(F.col("rule_id").asc_nulls_last())


def status(spark: SparkSession, layout: Layout) -> dict[str, object]:
    return health(spark, layout)
