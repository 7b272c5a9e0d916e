"""Clinical source tables derived from the order, event, part ... tables.

Every row of a base table becomes one raw row: nothing is filtered, so the work
grows with the tables. Values are text, as a bridge to another system delivers
them; the typed projection casts them. The rules are integer arithmetic and
string concatenation only, which Spark and other SQL engines read alike, so the
same text also feeds the SQL that results are compared with.

Faults are planted on purpose: blank and padded text, missing, unreadable and
foreign payloads, other spellings of a payload (list where one object is usual
and the reverse), dangling references and unknown codes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .resources import RESOURCES
from .schemas import bronze_fields

AS_OF = "2026-08-12 00:00:00"

_KEY_CLOCK = (
    "'2026-07-' || lpad(CAST(1 + {k} % 28 AS STRING), 2, '0') || ' ' || "
    "lpad(CAST({k} % 24 AS STRING), 2, '0') || ':' || lpad(CAST({k} % 60 AS STRING), 2, '0') || "
    "':00.' || lpad(CAST({k} % 1000000 AS STRING), 6, '0')"
)

# base table -> key, time text, owner, flag, amount in hundredths, end text
_BASES = {
    "orders": (
        "o_orderkey",
        "substr(CAST(o_orderdate AS STRING), 1, 10) || ' ' || "
        "lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') "
        "|| ':00.' || lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '0')",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_orderdate - INTERVAL 1 DAY AS STRING) "
        "ELSE CAST(o_orderdate + INTERVAL 1 DAY AS STRING) END",
    ),
    "events": ("event_id", "CAST(ts AS STRING)", "user_id", "event_type", "value", "CAST(ts AS STRING)"),
    "lineitem": (
        "l_orderkey * 8 + l_linenumber",
        "CAST(l_shipdate AS STRING)",
        "l_suppkey",
        "l_returnflag",
        "l_extendedprice",
        "CAST(l_shipdate AS STRING)",
    ),
    "customer": (
        "c_custkey", _KEY_CLOCK.format(k="c_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal",
        _KEY_CLOCK.format(k="c_custkey"),
    ),
    "part": (
        "p_partkey", _KEY_CLOCK.format(k="p_partkey"), "p_size", "p_brand", "p_retailprice",
        _KEY_CLOCK.format(k="p_partkey"),
    ),
    "conversations": (
        "conv_id * 1000 + turn", _KEY_CLOCK.format(k="turn"), "conv_id", "role", "turn",
        _KEY_CLOCK.format(k="turn"),
    ),
}

_TABLE_BASE = {
    "tabPatient": "orders",
    "tabPatientEncounter": "events",
    "tabHealthcarePractitioner": "conversations",
    "tabItem": "part",
    "tabAllergyIntolerance_SatuSehat": "customer",
    "tabCarePlan_SatuSehat": "orders",
    "tabComposition_SatuSehat": "orders",
    "tabCondition_SatuSehat": "events",
    "tabDiagnosticReport_SatuSehat": "lineitem",
    "tabEncounter_SatuSehat": "orders",
    "tabEpisodeOfCare_SatuSehat": "customer",
    "tabImagingStudy_SatuSehat": "part",
    "tabImmunization_SatuSehat": "orders",
    "tabMedicationDispense_SatuSehat": "lineitem",
    "tabMedicationStatement_SatuSehat": "events",
    "tabObservation_SatuSehat": "events",
    "tabProcedure_SatuSehat": "events",
    "tabQuestionnaireResponse_SatuSehat": "conversations",
    "tabServiceRequest_SatuSehat": "orders",
    "tabSpecimen_SatuSehat": "events",
}


def _code(code: str, text: str) -> dict[str, Any]:
    return {"coding": [{"system": "http://codes.example", "code": code, "display": text}], "text": text}


def _ref(kind: str, key: str = "@w@") -> dict[str, str]:
    return {"reference": f"{kind}/{key}", "display": f"{kind} @w@"}


_PATIENT = _ref("Patient")
_ENCOUNTER = _ref("Encounter", "@k@")
_OFFICIAL = [{"use": "temp", "value": "T-@k@"}, {"use": "official", "value": "O-@k@"}]

# Payload of each resource; ``@k@`` and the like are filled in per row and
# ``#...#`` marks a number.
_PAYLOADS: dict[str, dict[str, Any]] = {
    "allergy_intolerance": {
        "identifier": _OFFICIAL, "clinicalStatus": _code("active", "Active"),
        "verificationStatus": _code("confirmed", "Confirmed"), "category": ["food", "other"],
        "code": _code("A@w@", "Allergy @f@"), "patient": _PATIENT, "encounter": _ENCOUNTER,
        "recorder": _ref("Practitioner"),
    },
    "careplan": {
        "status": "active", "intent": "plan", "title": "Plan @k@", "description": "Plan of @w@",
        "category": [_code("C@w@", "Category")], "subject": _PATIENT, "encounter": _ENCOUNTER,
        "author": _ref("Practitioner"),
    },
    "composition": {
        "status": "final", "type": _code("T@w@", "Type @f@"), "subject": _PATIENT,
        "encounter": _ENCOUNTER, "date": "@iso@", "author": [_ref("Practitioner")],
        "title": "Summary @k@",
        "section": [
            {"title": "History @k@", "code": _code("S1", "History")},
            {"title": "Findings @k@", "code": _code("S2", "Findings")},
        ],
    },
    "condition": {
        "clinicalStatus": _code("active", "Active"), "category": [_code("encounter-diagnosis", "Diagnosis")],
        "code": _code("Brand#@m50@", "Diagnosis @m50@"), "subject": _PATIENT, "encounter": _ENCOUNTER,
    },
    "diagnostic_report": {
        "status": "final", "category": [_code("LAB", "Laboratory")], "code": _code("D@w@", "Report @f@"),
        "subject": _PATIENT, "encounter": _ENCOUNTER, "effectiveDateTime": "@iso@", "issued": "@iso@",
        "performer": [_ref("Organization")], "basedOn": [_ref("ServiceRequest", "@k@")],
        "conclusionCode": [_code("CC@w@", "Conclusion")],
        "result": [_ref("Observation", "@k@-1"), _ref("Observation", "@k@-2"), _ref("Observation", "@k@-3")],
    },
    "encounter": {
        "identifier": [{"system": "http://ids.example", "value": "EI-@k@"}], "status": "@status@",
        "class": {"code": "AMB", "display": "ambulatory"}, "subject": _PATIENT,
        "period": {"start": "@iso@", "end": "@end@"}, "location": [{"location": _ref("Location")}],
        "serviceProvider": _ref("Organization"),
        "participant": [
            {"type": [_code("ATND", "attender")], "individual": _ref("Practitioner")},
            {"type": [_code("CON", "consultant")], "individual": _ref("Practitioner", "@k@")},
        ],
    },
    "episode_of_care": {
        "status": "active", "identifier": [{"value": "EOC-@k@"}], "type": [_code("E@w@", "Episode")],
        "patient": _PATIENT, "managingOrganization": _ref("Organization"), "period": {"start": "@iso@"},
    },
    "imaging_study": {
        "identifier": [{"value": "IMG-@k@"}], "status": "available", "subject": _PATIENT,
        "encounter": _ENCOUNTER, "started": "@iso@", "basedOn": [_ref("ServiceRequest", "@k@")],
        "modality": [{"code": "CT", "display": "CT"}], "numberOfSeries": "#k#", "numberOfInstances": "#w#",
    },
    "immunization": {
        "status": "completed", "vaccineCode": _code("V@w@", "Vaccine @f@"), "patient": _PATIENT,
        "encounter": _ENCOUNTER, "occurrenceDateTime": "@iso@", "primarySource": "#flag#",
        "lotNumber": "L@k@", "expirationDate": "@day@", "performer": [{"actor": _ref("Practitioner")}],
        "reasonCode": [_code("R@w@", "Reason")],
    },
    "medication_dispense": {
        "identifier": _OFFICIAL, "status": "completed", "medicationReference": _ref("Medication", "@k@"),
        "subject": _PATIENT, "context": _ENCOUNTER, "whenHandedOver": "@iso@",
        "authorizingPrescription": [_ref("MedicationRequest", "@k@")],
        "dosageInstruction": [{"text": "take @w@ daily"}],
    },
    "medication_statement": {
        "status": "completed", "category": _code("outpatient", "Outpatient"),
        "medicationCodeableConcept": _code("M@w@", "Medicine @f@"), "subject": _PATIENT,
        "context": _ENCOUNTER, "dateAsserted": "@iso@", "informationSource": _PATIENT,
        "note": [{"text": "note @k@"}],
    },
    "observation": {
        "status": "final", "category": [_code("vital-signs", "Vital Signs")], "code": _code("8867-4", "Heart rate"),
        "subject": _PATIENT, "encounter": _ENCOUNTER, "performer": [_ref("Practitioner")],
        "effectiveDateTime": "@iso@", "valueQuantity": {"value": "#amount#", "unit": "beats/min"},
    },
    "procedure": {
        "status": "completed", "category": _code("PC", "Procedure"), "code": _code("P@m1500@", "Procedure @f@"),
        "subject": _PATIENT, "encounter": _ENCOUNTER, "performer": [{"actor": _ref("Practitioner")}],
    },
    "questionnaire_response": {
        "status": "completed", "questionnaire": "http://forms.example/Q@w@", "subject": _PATIENT,
        "encounter": _ENCOUNTER, "authored": "@iso@", "author": _ref("Practitioner"), "source": _PATIENT,
        "item": [
            {"linkId": "1", "text": "Role", "answer": [{"valueString": "@f@"}]},
            {"linkId": "2", "text": "Ready", "answer": [{"valueBoolean": "#flag#"}]},
        ],
    },
    "service_request": {
        "identifier": [{"value": "SR-@k@"}], "status": "active", "intent": "order",
        "category": [_code("108252007", "Laboratory procedure")], "code": _code("S@w@", "Request @f@"),
        "subject": _PATIENT, "encounter": _ENCOUNTER, "authoredOn": "@iso@",
        "requester": _ref("Practitioner"), "performer": [_ref("Practitioner", "@k@")],
    },
    "specimen": {
        "identifier": _OFFICIAL, "status": "available", "type": _code("SP@w@", "Specimen"),
        "subject": _PATIENT, "request": [_ref("ServiceRequest", "@k@")],
        "collection": {"collectedDateTime": "@iso@", "collector": _ref("Practitioner")},
    },
}

_FILLERS = {
    "k": "CAST(k AS STRING)",
    "w": "CAST(w AS STRING)",
    "f": "f",
    "iso": "iso",
    "end": "substr(e, 1, 10) || 'T' || substr(e, 12, 8) || '+00:00'",
    "day": "substr(t, 1, 10)",
    "m50": "CAST(k % 50 AS STRING)",
    "m1500": "CAST(k % 1500 AS STRING)",
    "flag": "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END",
    "amount": "CAST(CAST((c - c % 100) / 100 AS BIGINT) AS STRING) || '.' || lpad(CAST(c % 100 AS STRING), 2, '0')",
    "status": "CASE f WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in-progress' ELSE 'planned' END",
}


def _literal(text: str) -> str:
    """SQL text literal; characters that engines escape differently go by code."""
    pieces = []
    for part in re.split(r"([\\'\n])", text):
        if part in ("\\", "'", "\n"):
            pieces.append(f"chr({ord(part)})")
        elif part:
            pieces.append(f"'{part}'")
    return " || ".join(pieces) or "''"


def _fill(text: str) -> str:
    """Turn a template into a SQL concatenation."""
    pieces = []
    for part in re.split(r"(@\w+@)", text):
        if re.fullmatch(r"@\w+@", part):
            pieces.append(f"({_FILLERS[part[1:-1]]})")
        elif part:
            pieces.append(_literal(part))
    return " || ".join(pieces)


def _dump(value: Any) -> str:
    text = json.dumps(value, separators=(",", ":"))
    return re.sub(r'"#(\w+)#"', r"@\1@", text)


def _respell(value: Any) -> Any:
    """One-element lists become their element, objects become one-element lists."""
    if isinstance(value, dict):
        return {
            k: [_respell(v)] if isinstance(v, dict) else _respell(v) for k, v in value.items()
        }
    if isinstance(value, list):
        inner = [_respell(v) for v in value]
        return inner[0] if len(inner) == 1 else inner
    return value


def _pad(value: Any) -> Any:
    """Lists get a further element, objects become lists that start with an empty one."""
    if isinstance(value, dict):
        return {k: [{}, _pad(v)] if isinstance(v, dict) else _pad(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_pad(v) for v in value] + [{"note": None}]
    return value


def _sparse(body: dict[str, Any]) -> dict[str, Any]:
    return {k: v for i, (k, v) in enumerate(body.items()) if i % 2 == 0}


def _documents(name: str, key: str = "@k@") -> list[str]:
    """Usual, sparse, respelled and padded JSON of a resource, then a foreign one."""
    head = {"resourceType": RESOURCES[name].view.resource, "id": f"{name}-{key}"}
    body = _PAYLOADS[name]
    bodies = [body, _sparse(body), _respell(body), _pad(body)]
    return [_dump({**head, **b}) for b in bodies] + [_dump({"resourceType": "Basic", "id": f"x-{key}"})]


def _twice(document: str) -> str:
    """The same object with its first key said twice."""
    return "{" + document[1:].split(",", 1)[0] + "," + document[1:]


def _payload(name: str) -> str:
    usual, sparse, respelled, padded, foreign = _documents(name)
    if RESOURCES[name].is_array:
        second = _documents(name, "@k@-b")[0]
        third = _documents(name, "@k@-c")[1]
        return (
            "CASE WHEN k % 20 = 19 THEN CAST(NULL AS STRING) "
            f"WHEN k % 50 = 3 THEN {_fill('[' + usual[:40])} "
            f"WHEN k % 50 = 4 THEN {_fill(usual)} "
            f"WHEN k % 50 = 13 THEN {_fill(f'[{usual}] x')} "
            f"WHEN k % 50 = 23 THEN {_fill(f'[{_twice(usual)}]')} "
            "WHEN k % 50 = 5 THEN '[]' "
            f"WHEN k % 9 = 0 THEN {_fill(f'[{foreign},{usual},{second}]')} "
            f"WHEN k % 9 = 1 THEN {_fill(f'[null,{respelled}]')} "
            f"WHEN k % 9 = 2 THEN {_fill(f'[{padded},{third}]')} "
            f"WHEN k % 9 = 3 THEN {_fill(f'[{sparse},{second},{third}]')} "
            f"ELSE {_fill(f'[{usual}]')} END"
        )
    return (
        "CASE WHEN k % 20 = 19 THEN CAST(NULL AS STRING) "
        f"WHEN k % 25 = 24 THEN {_fill(foreign)} "
        f"WHEN k % 50 = 3 THEN {_fill(usual[:40])} "
        f"WHEN k % 50 = 13 THEN {_fill(usual + ' x')} "
        f"WHEN k % 50 = 23 THEN {_fill(_twice(usual))} "
        f"WHEN k % 8 = 5 THEN {_fill(sparse)} "
        f"WHEN k % 32 = 6 THEN {_fill(respelled)} "
        f"WHEN k % 32 = 7 THEN {_fill(padded)} "
        f"ELSE {_fill(usual)} END"
    )


def _answer(name: str) -> str:
    kind = RESOURCES[name].view.resource
    done = _dump(
        {"resourceType": kind, "id": "R-@k@", "meta": {"lastUpdated": "@iso@", "versionId": "@k@"}}
    )
    failed = _dump(
        {
            "resourceType": "OperationOutcome",
            "id": "E-@k@",
            "issue": [
                {
                    "severity": "error", "code": "invalid", "details": {"text": "Code @k@ not found"},
                    "expression": [f"{kind}.code", f"{kind}.id"],
                }
            ],
        }
    )
    empty = _dump({"resourceType": "OperationOutcome", "issue": []})

    def wrap(status: Any, body: str) -> str:
        return _dump({"status_code": status, "response": body})

    if RESOURCES[name].is_array:
        return (
            "CASE WHEN k % 8 = 4 THEN 'gateway timeout' WHEN k % 8 = 5 THEN CAST(NULL AS STRING) "
            f"WHEN k % 8 = 0 THEN {_fill(f'[{wrap(201, done)},{wrap(400, failed)}]')} "
            f"WHEN k % 8 = 1 THEN {_fill(f'[{done},null,{failed}]')} "
            "WHEN k % 8 = 2 THEN '[]' "
            f"WHEN k % 8 = 3 THEN {_fill('[' + wrap('422', empty) + ']')} "
            f"ELSE {_fill(f'[{wrap(201, done)}]')} END"
        )
    return (
        f"CASE k % 8 WHEN 0 THEN {_fill(done)} WHEN 1 THEN {_fill(failed)} "
        f"WHEN 2 THEN {_fill(wrap(201, done))} "
        f"WHEN 3 THEN {_literal('STATUS CODE: 400' + chr(10) * 2)} || {_fill(failed)} "
        "WHEN 4 THEN 'gateway timeout' WHEN 5 THEN CAST(NULL AS STRING) "
        f"WHEN 6 THEN {_fill(wrap('500', _dump({'message': 'down @k@'})))} "
        f"ELSE {_fill(empty)} END"
    )


def _default(name: str, type_name: str, i: int) -> str:
    if type_name == "INT":
        return f"CAST((k + {i}) % 7 AS STRING)"
    if type_name == "DECIMAL":
        return f"CAST((k + {i}) % 1000 AS STRING) || '.25'"
    if type_name == "DATE":
        return "substr(t, 1, 10)"
    if type_name == "TIMESTAMP":
        return "t"
    return (
        f"CASE (k + {i}) % 5 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN ' {name} ' || CAST(k AS STRING) || ' ' "
        f"WHEN 3 THEN CAST(NULL AS STRING) ELSE '{name}' END"
    )


_UID = (
    "CASE k % 10 WHEN 0 THEN '12345678901234' || CAST(k % 10 AS STRING) WHEN 1 THEN '' "
    "WHEN 2 THEN CAST(NULL AS STRING) WHEN 3 THEN ' ' || lpad(CAST(k AS STRING), 16, '0') "
    "WHEN 4 THEN lpad(CAST(k AS STRING), 15, '0') || 'X' ELSE lpad(CAST(k AS STRING), 16, '3') END"
)
_LINK = "CASE WHEN k % 11 = 10 THEN '  ' ELSE 'SS-' || CAST(k * 2 AS STRING) END"
_ICD = (
    "CASE WHEN k % 11 = 5 THEN '  ' WHEN k % 13 = 6 THEN CAST(NULL AS STRING) "
    "WHEN k % 7 = 1 THEN ' Brand#' || CAST(k % 50 AS STRING) || ' ' ELSE 'Brand#' || CAST(k % 50 AS STRING) END"
)


# Times of the base tables span decades. As a feed, the month becomes the day and the rest
# the time of day, so the rows of a table lie on twelve days at most and stay distinct.
FEED_DAYS = ("2026-07-01", "2026-07-13")
_FEED_STAMP = (
    "'2026-07-' || substr(t, 6, 2) || ' ' || lpad(CAST(CAST(substr(t, 1, 4) AS INT) % 24 AS STRING), 2, '0') || ':' || "
    "substr(t, 9, 2) || ':' || substr(t, 12, 2) || '.' || substr(t, 15, 2) || "
    # Times on whole minutes differ in their last digits only.
    "CASE WHEN substr(t, 18, 2) = '00' THEN coalesce(nullif(substr(t, 23, 4), ''), '0000') "
    "ELSE substr(t, 18, 2) || coalesce(nullif(substr(t, 21, 2), ''), '00') END"
)


@lru_cache(maxsize=None)
def _columns(table: str, feed: bool = False) -> dict[str, str]:
    """Column -> SQL expression over ``k, t, w, f, c, e, iso``."""
    given: dict[str, str] = {"creation": "t", "modified": _FEED_STAMP if feed else "t"}
    if table == "tabPatient":
        given["name"] = "'PAT-' || CAST(w AS STRING) || CASE WHEN k % 97 = 0 THEN ' ' ELSE '' END"
        given["uid"] = _UID
    elif table == "tabPatientEncounter":
        given["name"] = "'PE-' || CAST(w AS STRING)"
    elif table == "tabHealthcarePractitioner":
        given["name"] = "'HP-' || CAST(w AS STRING)"
    elif table == "tabItem":
        given["name"] = "'ITEM-' || f"
    else:
        name = next(n for n, r in RESOURCES.items() if r.table == table)
        given["name"] = f"'{name}-' || CAST(k AS STRING)"
        given["payload_json"] = _payload(name)
        given["api_response"] = _answer(name)
        given["satusehat_id"] = "'SS-' || CAST(k AS STRING)"
        given["patient"] = "'PAT-' || CAST(w AS STRING)"
        given["patient_ihs"] = "'IHS-' || CAST(w AS STRING)"
        given["satusehat_encounter_id"] = _LINK
        given["icd_code"] = _ICD
    fields = bronze_fields(table)
    return {f.name: given.get(f.name) or _default(f.name, f.type, i) for i, f in enumerate(fields)}


def raw_sql(
    table: str, relation: Callable[[str], str], columns: list[str] | None = None, feed: bool = False, stamped: str = "{}"
) -> str:
    """SELECT of the raw text rows of a source table; ``relation`` names a base table.

    ``feed``: ``modified`` lies within ``FEED_DAYS``, as a batch run by day needs it. ``stamped``:
    template of the time text, for an engine that would else make it anew for every use.
    """
    base = _TABLE_BASE[table]
    key, stamp, owner, flag, amount, end = _BASES[base]
    wanted = {n: x for n, x in _columns(table, feed).items() if columns is None or n in columns}
    select = ",\n  ".join(f"{x} AS {n}" for n, x in wanted.items())
    return (
        f"SELECT\n  {select}\nFROM (SELECT k, t, w, f, c, e, "
        "substr(t, 1, 10) || 'T' || substr(t, 12, 8) || '+00:00' AS iso FROM ("
        f"SELECT CAST({key} AS BIGINT) AS k, {stamped.format(stamp)} AS t, CAST({owner} AS BIGINT) AS w, {flag} AS f, "
        f"CAST(FLOOR(ABS({amount}) * 100) AS BIGINT) AS c, {end} AS e FROM {relation(base)}) AS b) AS src"
    )


def code_list_sql(name: str, relation: Callable[[str], str]) -> str:
    """Reference code lists: one row per part or supplier, codes repeat."""
    columns = {
        "icd_10": (
            "CASE WHEN p_partkey % 3 = 0 THEN p_brand || ' ' ELSE p_brand END AS CODE, p_name AS DISPLAY, "
            "CASE WHEN p_partkey % 2 = 0 THEN '2010' ELSE '2016' END AS VERSION",
            "part",
        ),
        "icd_9cm": ("'P' || CAST(s_suppkey AS STRING) AS CODE, s_name AS DISPLAY, '2010' AS VERSION", "supplier"),
        "icd_pm": ("'PM' || CAST(p_partkey AS STRING) AS CODE, p_name AS DISPLAY, '2015' AS VERSION", "part"),
        "icd_o": ("'M' || CAST(p_partkey AS STRING) AS CODE, p_name AS STR, p_type AS SAB", "part"),
        "icd_mm": (
            "CAST(p_size % 3 AS STRING) AS LEVEL, 'MM' || CAST(p_partkey AS STRING) AS CODE, "
            "p_name AS DISPLAY, '2012' AS VERSION",
            "part",
        ),
    }
    select, base = columns[name]
    return f"SELECT {select} FROM {relation(base)}"


def registry_sql(relation: Callable[[str], str]) -> str:
    """Local rules beside the shipped ones, one text row per part."""
    key = "lpad(CAST(p_partkey AS STRING), 9, '0')"
    return (
        f"SELECT 'LOC-' || {key} AS rule_id, 'Local rule, ' || p_name AS rule_name, "
        "p_name || ', \"' || p_type || '\"' AS description, p_type AS audit_domain, p_brand AS focus_area, "
        "'DATA_QUALITY_CONTROL' AS rule_basis, CASE WHEN p_partkey % 2 = 0 THEN ' ' ELSE ' ' || p_brand END "
        "AS authority_name, '  ' AS authority_reference, p_type AS standard_name, "
        "CAST(2000 + p_size AS STRING) AS standard_version, 'local' AS rule_expression, "
        "CASE p_size % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS severity, "
        "'2026-08-12' AS effective_from, CASE WHEN p_partkey % 3 = 0 THEN '2027-01-31' ELSE ' ' END AS effective_to, "
        "CASE WHEN p_partkey % 4 = 0 THEN 'ACTIVE' ELSE 'BLOCKED' END AS status, "
        "CAST(1 + p_partkey % 3 AS STRING) AS version, '2026-08-12 00:00:00' AS created_at, "
        f"'2026-08-12 00:00:00' AS updated_at FROM {relation('part')}"
    )


# A raw row is about a hundred times as long as its stored base row, so a task that sorts raw rows takes few of these.
SORTED_BYTES = 1 << 20
_SPREAD_BY = {
    "orders": "o_orderkey", "events": "event_id", "part": "p_partkey", "conversations": "conv_id, turn",
    "lineitem": "l_orderkey, l_linenumber", "customer": "c_custkey",
}


def parquet_relation(spark: SparkSession, folder: str, sorted_rows: bool = False, by_range: bool = False) -> Callable[[str], str]:
    """Base table as a relation; an input of fewer splits than cores is spread over them.

    The small test tables are single row groups, which one task would read and
    transform alone. Inputs with enough splits are read as they are. ``sorted_rows``: their
    raw rows are sorted as a whole, so the base rows are spread over tasks by their size.
    ``by_range``: they are spread by ranges of their key and each task takes them in its order, so that
    neighbours stay together in the files that are written, where they compress better than rows dealt one
    by one. Base rows are sorted, not the raw rows that are made of them.
    """

    @lru_cache(maxsize=None)
    def relation(base: str) -> str:
        path = f"{folder}/{base}.parquet"
        cores = spark.sparkContext.defaultParallelism
        found = spark.read.parquet(path)
        tasks = int(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // SORTED_BYTES if sorted_rows else 0
        ranged = by_range and base in _SPREAD_BY
        spread = f"REPARTITION_BY_RANGE({cores}, {_SPREAD_BY[base]})" if ranged else f"REPARTITION({cores})"
        hint = f"/*+ {spread} */ " if found.rdd.getNumPartitions() < cores else ""
        if tasks > max(cores, found.rdd.getNumPartitions()):
            hint = f"/*+ REPARTITION({tasks}, {_SPREAD_BY[base]}) */ "
        return f"(SELECT {hint}* FROM parquet.`{path}`{f' SORT BY {_SPREAD_BY[base]}' if ranged else ''})"

    return relation


def raw_table(spark: SparkSession, relation: Callable[[str], str], table: str, feed: bool = False) -> DataFrame:
    """Raw rows. A feed is filtered by its time: Spark would copy the making of that text into the filter, many
    times over, and put the filter ahead of the spread; behind a generator the text is made once.
    """
    return spark.sql(raw_sql(table, relation, feed=feed, stamped="explode(array({}))" if feed else "{}"))


def code_list(spark: SparkSession, relation: Callable[[str], str], name: str) -> DataFrame:
    return spark.sql(code_list_sql(name, relation))


def raw_rules(spark: SparkSession, relation: Callable[[str], str]) -> DataFrame:
    return spark.sql(registry_sql(relation))
