"""Expected results of the dashboard queries as DuckDB SQL."""

from __future__ import annotations

from .duck import AS_OF, _cte, _run, gold_parts

# ---- fixed values: columns of the reports -------------------------------------
LISTED = (
    "finding_id", "rule_id", "audit_domain", "focus_area", "entity_type", "entity_id", "patient_id", "encounter_id",
    "actual_value", "expected_value", "severity", "status", "detected_at", "source_system",
)
ONLY_IN_DETAIL = (
    "resolved_at", "source_record_id", "evidence_reference", "explanation", "reviewer_id", "review_note", "resolution_code",
)
OF_THE_RULE = ("rule_name", "rule_basis", "authority_name", "authority_reference", "standard_name", "standard_version")
RULE_LIST = (
    "rule_id", "description", *OF_THE_RULE, "audit_domain", "focus_area", "severity", "status", "version",
)
# ---- end of fixed values --------------------------------------------------------

#: Name of a total and the findings that it counts.
OF_ALL = {
    "total": "true",
    "open": "status = 'OPEN'",
    "under_review": "status = 'UNDER_REVIEW'",
    "resolved": "status = 'RESOLVED'",
    "high_severity": "severity = 'HIGH'",
    "medium_severity": "severity = 'MEDIUM'",
    "low_severity": "severity = 'LOW'",
}
OF_A_DOMAIN = {"total_findings": "total", "open_findings": "open", "high_severity_findings": "high_severity"}


def _totals(named: dict[str, str]) -> str:
    return ", ".join(f"CAST(ifnull(sum(CAST({which} AS INTEGER)), 0) AS BIGINT) AS {name}" for name, which in named.items())


def over_findings(select: str) -> str:
    return _cte(gold_parts(), select)


def overview() -> str:
    counts = "SELECT count(*) AS total_rules_in_registry, count(nullif(status = 'ACTIVE', false)) AS applicable_checks FROM rules"
    return _cte(
        {**gold_parts(), "runs": _run()},
        f"SELECT runs.* EXCLUDE (audit_run_id, findings_created), n.* FROM runs, ({counts}) AS n",
    )


def summary() -> str:
    return over_findings(f"SELECT {_totals(OF_ALL)} FROM findings")


def by_domain() -> str:
    return over_findings(f"SELECT audit_domain, {_totals({k: OF_ALL[v] for k, v in OF_A_DOMAIN.items()})} FROM findings GROUP BY ALL")


def top_rules(top: int = 10) -> str:
    """Counts first, then the names of the rules that have a place."""
    placed = (
        "SELECT rule_id, count(*) AS finding_count, row_number() OVER (ORDER BY count(*) DESC, rule_id) AS place "
        "FROM findings GROUP BY rule_id"
    )
    named = ", ".join(f"(SELECT any_value({c}) FROM rules AS r WHERE r.rule_id = p.rule_id) AS {c}" for c in ("rule_name", "severity"))
    return over_findings(f"SELECT rule_id, {named}, finding_count FROM ({placed}) AS p WHERE place <= {top}")


def page(where: str = "true", limit: int = 25, offset: int = 0) -> str:
    """The rows whose place in the list lies on the page."""
    place = "row_number() OVER (ORDER BY detected_at DESC, finding_id)"
    return over_findings(
        f"SELECT {', '.join(LISTED)} FROM findings WHERE {where} QUALIFY {place} BETWEEN {offset + 1} AND {offset + limit}"
    )


def page_after(finding_id: str, where: str, limit: int) -> str:
    """The page that starts behind a finding of the run."""
    return page(f"{where} AND (-epoch(detected_at), finding_id) > (-epoch({AS_OF}), '{finding_id}')", limit)


def detail(finding_id: str) -> str:
    rule = f"SELECT rule_id, {', '.join(OF_THE_RULE)} FROM rules"
    return over_findings(
        f"SELECT {', '.join([*LISTED, *ONLY_IN_DETAIL, *OF_THE_RULE])} "
        f"FROM (FROM findings WHERE finding_id = {finding_id}) AS f LEFT JOIN ({rule}) AS r USING (rule_id)"
    )


def rule_list() -> str:
    return over_findings(f"SELECT {', '.join(RULE_LIST)} FROM rules")


def dashboard(finding_id: str) -> dict[str, str]:
    return {
        "audit_overview": overview(),
        "findings_summary": summary(),
        "findings_by_domain": by_domain(),
        "top_recurring_rules": top_rules(),
        "list_findings": page(),
        "finding_detail": detail(finding_id),
    }
