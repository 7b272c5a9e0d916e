"""Compliance rules as data and their evaluation into the findings contract.

A rule names the entity it looks at and what makes a row a violation: either a
predicate on the row itself, or a key that a reference table does not hold.
Rules on the rows of one entity are evaluated in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import filled, literal, populated
from .membership import key_set, without_match

TEXT, STAMP = T.StringType(), T.TimestampNTZType()

# ---- fixed values: contract of a finding ------------------------------------
FINDING = T.StructType(
    [
        T.StructField("finding_id", TEXT),
        T.StructField("audit_run_id", TEXT),
        T.StructField("rule_id", TEXT),
        T.StructField("rule_version", T.IntegerType()),
        T.StructField("audit_domain", TEXT),
        T.StructField("focus_area", TEXT),
        T.StructField("entity_type", TEXT),
        T.StructField("entity_id", TEXT),
        T.StructField("patient_id", TEXT),
        T.StructField("encounter_id", TEXT),
        T.StructField("actual_value", TEXT),
        T.StructField("expected_value", TEXT),
        T.StructField("severity", TEXT),
        T.StructField("status", TEXT),
        T.StructField("detected_at", STAMP),
        T.StructField("resolved_at", STAMP),
        T.StructField("source_system", TEXT),
        T.StructField("source_record_id", TEXT),
        T.StructField("evidence_reference", TEXT),
        T.StructField("explanation", TEXT),
        T.StructField("reviewer_id", TEXT),
        T.StructField("review_note", TEXT),
        T.StructField("resolution_code", TEXT),
    ]
)
RUN_SLOT = "NA"
NEW_STATUS = "OPEN"
SOURCE_SYSTEM = "Frappe"
# ---- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One rule.

    ``actual`` and ``explanation`` are templates with columns in braces;
    ``violation``, ``key`` and ``reference_key`` are SQL text.
    """

    rule_id: str
    check: str
    severity: str
    audit_domain: str
    focus_area: str
    entity_type: str
    source: str
    entity_id: str
    patient_id: str
    encounter_id: str | None
    actual: str
    expected: str
    explanation: str
    version: int = 1
    violation: str | None = None
    key: str | None = None
    reference: str | None = None
    reference_key: str | None = None

    @property
    def needs_reference(self) -> bool:
        return self.reference is not None

    @property
    def table(self) -> str:
        return f"audit_check_{self.check}"

    @property
    def columns(self) -> list[str]:
        """Columns of the entity that a finding shows."""
        named = re.findall(r"\{(\w+)\}", f"{self.actual} {self.explanation}")
        return list(dict.fromkeys(filter(None, (self.entity_id, self.patient_id, self.encounter_id, *named))))


REGISTRY: dict[str, Rule] = {}


def register(rule: Rule) -> Rule:
    """Add a rule; the findings table picks it up without further change."""
    if rule.rule_id in REGISTRY:
        raise ValueError(f"rule registered twice: {rule.rule_id}")
    if (rule.violation is None) == (rule.reference is None):
        raise ValueError(f"{rule.rule_id}: give either a violation or a reference")
    REGISTRY[rule.rule_id] = rule
    return rule


def rules(rule_ids: list[str] | None = None) -> list[Rule]:
    chosen = REGISTRY if rule_ids is None else {k: v for k, v in REGISTRY.items() if k in rule_ids}
    return sorted(chosen.values(), key=lambda rule: rule.check)


def as_finding(rule: Rule, as_of: str) -> dict[str, str]:
    """The contract columns of a violating row as SQL text."""
    entity = f"{{{rule.entity_id}}}"
    values = {
        "finding_id": f"md5({filled(f'{RUN_SLOT}|{rule.rule_id}|{rule.entity_type}|{entity}')})",
        "rule_id": literal(rule.rule_id),
        "rule_version": str(rule.version),
        "audit_domain": literal(rule.audit_domain),
        "focus_area": literal(rule.focus_area),
        "entity_type": literal(rule.entity_type),
        "entity_id": rule.entity_id,
        "patient_id": rule.patient_id,
        "encounter_id": rule.encounter_id or "NULL",
        "actual_value": filled(rule.actual),
        "expected_value": literal(rule.expected),
        "severity": literal(rule.severity),
        "status": literal(NEW_STATUS),
        "detected_at": literal(as_of),
        "source_system": literal(SOURCE_SYSTEM),
        "source_record_id": rule.entity_id,
        "evidence_reference": filled(f"silver.{rule.source}:{rule.entity_id}={entity}"),
        "explanation": filled(rule.explanation),
    }
    return {
        f.name: f"cast({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()})" for f in FINDING.fields
    }


def entity_findings(
    entity: DataFrame, group: list[Rule], as_of: str, known: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Findings of several rules of one entity, in one pass over it.

    ``known`` holds the distinct keys of the references, by rule; each key is there once,
    so the marking join keeps the row count. Then the numbers of the violated
    rules are exploded: rows without a violation are gone before any text is built.
    """
    violations = []
    for i, rule in enumerate(group):
        if not rule.needs_reference:
            violations.append(rule.violation)
            continue
        marks = known[rule.rule_id].selectExpr(f"_key AS _key{i}", f"true AS _known{i}")
        entity = entity.selectExpr("*", f"{rule.key} AS _key{i}").join(marks, f"_key{i}", "left")
        violations.append(f"{populated(f'_key{i}')} AND _known{i} IS NULL")
    numbers = ", ".join(f"CASE WHEN {violation} THEN {i} END" for i, violation in enumerate(violations))
    hits = entity.selectExpr("*", f"explode(array({numbers})) AS _rule").where("_rule IS NOT NULL")
    per_rule = [as_finding(rule, as_of) for rule in group]
    out = []
    for f in FINDING.fields:
        texts = [columns[f.name] for columns in per_rule]
        branches = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(texts))
        chosen = texts[0] if len(set(texts)) == 1 else f"CASE _rule {branches} END"
        out.append(f"{chosen} AS {f.name}")
    return hits.selectExpr(*out)


def reference_findings(entity: DataFrame, rule: Rule, known: DataFrame, as_of: str) -> DataFrame:
    """Findings of one rule whose key must exist in a reference."""
    unmatched = without_match(entity.select(*rule.columns), rule.key, known)
    return unmatched.selectExpr(*[f"{text} AS {name}" for name, text in as_finding(rule, as_of).items()])


Slot = tuple[str, str]


def reference_slots(chosen: list[Rule]) -> list[Slot]:
    """Tables and key texts that the rules refer to, each once."""
    return list(dict.fromkeys((r.reference, r.reference_key) for r in chosen if r.needs_reference))


def known_keys(slot: Slot, tables: Mapping[str, DataFrame]) -> DataFrame:
    reference, key = slot
    return key_set(tables[reference], key)


def check(rule: Rule, tables: Mapping[str, DataFrame], as_of: str, known: DataFrame | None = None) -> DataFrame:
    """Findings of one rule over its tables; ``known``: the stored keys of its reference."""
    entity = tables[rule.source]
    if rule.needs_reference:
        keys = known_keys((rule.reference, rule.reference_key), tables) if known is None else known
        return reference_findings(entity, rule, keys, as_of)
    return entity_findings(entity, [rule], as_of)


def assert_contract(df: DataFrame) -> DataFrame:
    found = [(f.name, f.dataType) for f in df.schema.fields]
    expected = [(f.name, f.dataType) for f in FINDING.fields]
    if found != expected:
        raise ValueError(f"not the findings contract: {sorted(set(found) ^ set(expected), key=str)}")
    return df


def active(registry: DataFrame) -> DataFrame:
    """Ids of the rules of this library that are ACTIVE in a registry, one row a rule."""
    known = F.col("rule_id").isin(list(REGISTRY)) & (F.col("status") == "ACTIVE")
    return registry.where(known).select("rule_id").distinct()


def evaluate(
    tables: Mapping[str, DataFrame],
    as_of: str,
    rule_ids: list[str] | None = None,
    registry: DataFrame | None = None,
    stored_keys: Mapping[Slot, DataFrame] | None = None,
) -> DataFrame:
    """Union of the findings of all rules; with ``registry`` only of those that are ACTIVE in it.

    All rules of an entity run in one pass. ``stored_keys`` replaces the keys that are
    read from the references. No Spark job runs before an action on the result.
    """
    chosen = rules(rule_ids)
    slots = {slot: (stored_keys or {}).get(slot) for slot in reference_slots(chosen)}
    keys = {slot: known_keys(slot, tables) if df is None else df for slot, df in slots.items()}
    known = {r.rule_id: keys[r.reference, r.reference_key] for r in chosen if r.needs_reference}
    by_entity: dict[str, list[Rule]] = {}
    for rule in chosen:
        by_entity.setdefault(rule.source, []).append(rule)
    parts = [entity_findings(tables[source], group, as_of, known) for source, group in by_entity.items()]
    found = reduce(DataFrame.unionByName, map(assert_contract, parts))
    if registry is None:
        return found
    return found.join(F.broadcast(active(registry)), "rule_id", "left_semi").select(found.columns)


# ---- fixed values: the eight active rules and the texts of their findings ---
ENCOUNTER_TABLE = "encounter_fhir_resource"
ENCOUNTER_EXPECTED = "Encounter dengan satusehat_id tersebut harus ada di silver.encounter_fhir_resource"
ENCOUNTER_STATUSES = ("arrived", "in-progress", "finished")
UID_PATTERN = r"\A[0-9]{16}\z"

register(
    Rule(
        rule_id="CTL-TERM-ICD10-001",
        check="terminology_icd10_validity",
        severity="HIGH",
        audit_domain="Clinical Terminology Compliance",
        focus_area="Terminology - ICD-10",
        entity_type="Condition",
        source="condition_fhir_resource",
        entity_id="frappe_doc_name",
        patient_id="patient",
        encounter_id="satusehat_encounter_id",
        expected="Kode harus terdaftar di bronze.icd_10 (ICD-10 2010)",
        actual="{icd_code}",
        explanation="Diagnosis code '{icd_code}' tidak ditemukan di bronze.icd_10 (ICD-10 2010)",
        key="trim(icd_code)",
        reference="icd_10",
        reference_key="trim(CODE)",
    )
)
register(
    Rule(
        rule_id="CTL-TERM-ICD9CM-001",
        check="terminology_icd9cm_validity",
        severity="HIGH",
        audit_domain="Clinical Terminology Compliance",
        focus_area="Terminology - ICD-9-CM",
        entity_type="Procedure",
        source="procedure_fhir_resource",
        entity_id="frappe_doc_name",
        patient_id="patient_ihs",
        encounter_id="satusehat_encounter_id",
        expected="Kode harus terdaftar di bronze.icd_9cm (ICD-9-CM 2010)",
        actual="{code}",
        explanation="Procedure code '{code}' tidak ditemukan di bronze.icd_9cm (ICD-9-CM 2010)",
        key="trim(code)",
        reference="icd_9cm",
        reference_key="trim(CODE)",
    )
)
for _id, _check, _severity, _entity, _patient in (
    ("CTL-REF-COND-ENC-001", "condition", "HIGH", "Condition", "patient"),
    ("CTL-REF-PROC-ENC-001", "procedure", "HIGH", "Procedure", "patient_ihs"),
    ("CTL-REF-OBS-ENC-001", "observation", "MEDIUM", "Observation", "patient"),
):
    register(
        Rule(
            rule_id=_id,
            check=f"reference_integrity_{_check}_encounter",
            severity=_severity,
            audit_domain="Clinical Reference Integrity",
            focus_area=f"Reference Integrity - {_entity} to Encounter",
            entity_type=_entity,
            source=f"{_check}_fhir_resource",
            entity_id="frappe_doc_name",
            patient_id=_patient,
            encounter_id="satusehat_encounter_id",
            expected=ENCOUNTER_EXPECTED,
            actual="{satusehat_encounter_id}",
            explanation=(
                f"{_entity} mereferensikan Encounter (satusehat_encounter_id = '{{satusehat_encounter_id}}') "
                "yang tidak ditemukan di silver.encounter_fhir_resource"
            ),
            key="satusehat_encounter_id",
            reference=ENCOUNTER_TABLE,
            reference_key="satusehat_id",
        )
    )
register(
    Rule(
        rule_id="CTL-STRUCT-ENC-STATUS-001",
        check="structural_encounter_status",
        severity="MEDIUM",
        audit_domain="EHR/FHIR Structural Compliance",
        focus_area="Structural - Encounter Status",
        entity_type="Encounter",
        source=ENCOUNTER_TABLE,
        entity_id="frappe_doc_name",
        patient_id="patient",
        encounter_id="satusehat_id",
        expected=" | ".join(ENCOUNTER_STATUSES),
        actual="{fhir_status}",
        explanation=(
            "Encounter.status ('{fhir_status}') bukan salah satu dari 3 status yang wajib dikirim SatuSehat: "
            "arrived, in-progress, finished"
        ),
        violation=f"{populated('fhir_status')} AND fhir_status NOT IN {ENCOUNTER_STATUSES}",
    )
)
register(
    Rule(
        rule_id="CTL-TEMPORAL-ENC-001",
        check="temporal_encounter_period",
        severity="MEDIUM",
        audit_domain="Data Format & Temporal Integrity",
        focus_area="Temporal Consistency - Encounter",
        entity_type="Encounter",
        source=ENCOUNTER_TABLE,
        entity_id="frappe_doc_name",
        patient_id="patient",
        encounter_id="satusehat_id",
        expected="period_start <= period_end",
        actual="{period_start} > {period_end}",
        explanation=(
            "Encounter.period_start ({period_start}) lebih besar dari period_end ({period_end}) -- "
            "timeline tidak mungkin"
        ),
        violation="period_start > period_end",
    )
)
register(
    Rule(
        rule_id="CTL-IDENT-PAT-FORMAT-001",
        check="identity_patient_uid_format",
        severity="LOW",
        audit_domain="Patient Identity & Identifier Integrity",
        focus_area="Identity - UID Format",
        entity_type="Patient",
        source="tabPatient",
        entity_id="name",
        patient_id="name",
        encounter_id=None,
        expected="16 digit numerik (format-check saja, bukan validasi NIK resmi)",
        actual="{uid}",
        explanation=(
            "Patient.uid ('{uid}') tidak berformat 16 digit numerik. Catatan: ini format-check saja -- "
            "definisi resmi field uid belum dikonfirmasi (lihat rule_basis = UNVERIFIED)"
        ),
        violation=rf"{populated('uid')} AND NOT trim(uid) RLIKE r'{UID_PATTERN}'",
    )
)
# ---- end of fixed values ----------------------------------------------------
