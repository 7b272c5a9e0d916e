"""Expected results as DuckDB SQL.

The raw rows come from the same derivation text as in Spark; everything behind
them (casts, cleaning, JSON paths, response shapes, rules, queries) is written
anew here with DuckDB's own functions.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from contextlib import contextmanager

from wardledger.operators.rules import REGISTRY
from wardledger.sources import derived
from wardledger.sources.readers import RULES_CSV, RULE
from wardledger.sources.resources import CHILD_VIEWS, RESOURCES
from wardledger.sources.schemas import CODE_LISTS, MASTER_TABLES, bronze_fields
from wardledger.sources.views import VIEWS

AS_OF = f"TIMESTAMP '{derived.AS_OF}'"
SQL_TYPES = {"STRING": "VARCHAR", "INT": "INTEGER", "DECIMAL": "DECIMAL(21,9)"}
DROPPED = {"api_response", "payload_json", "_user_tags", "_comments", "_assign", "_liked_by"}


def _type(name: str) -> str:
    return SQL_TYPES.get(name, name)


def _cte(parts: dict[str, str], final: str) -> str:
    """One statement out of named parts; parts may refer to earlier ones."""
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {body}\n{final}"


def _text(column: str, type_name: str) -> str:
    """Dates and decimals as text, see ``comparable`` in the entry module."""
    return f"CAST({column} AS VARCHAR) AS {column}" if type_name in ("DATE", "DECIMAL") else column


_FEED = [False]


@contextmanager
def feed() -> Iterator[None]:
    """Within: the raw rows as the batch run gets them, on a few days."""
    _FEED[0] = True
    try:
        yield
    finally:
        _FEED[0] = False


def raw(table: str) -> str:
    return derived.raw_sql(table, lambda base: base, feed=_FEED[0])


def typed(table: str) -> str:
    casts = ", ".join(f"CAST({f.name} AS {_type(f.type)}) AS {f.name}" for f in bronze_fields(table))
    return f"SELECT {casts} FROM ({raw(table)}) AS r"


def bronze(table: str, where: str = "") -> str:
    columns = ", ".join(_text(f.name, f.type) for f in bronze_fields(table))
    return f"SELECT {columns} FROM ({typed(table)}) AS b {where}"


def _cleaned(fields, drop=frozenset(), raw_text=frozenset()) -> str:
    out = []
    for f in fields:
        if f.name in drop:
            continue
        if f.type == "STRING" and f.name not in raw_text:
            out.append(f"NULLIF(TRIM({f.name}), '') AS {f.name}")
        else:
            out.append(_text(f.name, f.type))
    return ", ".join(out)


def cleaned(table: str) -> str:
    return f"SELECT {_cleaned(bronze_fields(table))} FROM ({typed(table)}) AS b"


def master(table: str) -> str:
    columns = _cleaned(bronze_fields(table))
    latest = (
        f"SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY modified DESC) AS rn FROM ({typed(table)}) AS b"
    )
    return f"SELECT {columns} FROM ({latest}) AS v WHERE rn = 1"


def parent(resource: str) -> str:
    table = RESOURCES[resource].table
    return f"SELECT {_cleaned(bronze_fields(table), DROPPED)} FROM ({typed(table)}) AS b"


# ---- JSON paths ---------------------------------------------------------------
def _members(node: str, name: str) -> str:
    value = f"json_extract({node}, '$.{name}')"
    return f"CASE WHEN json_type({value}) = 'ARRAY' THEN CAST({value} AS JSON[]) ELSE [{value}] END"


def _present(values: str) -> str:
    return f"list_filter({values}, lambda x: x IS NOT NULL AND json_type(x) <> 'NULL')"


def reached(node: str, path: str) -> str:
    """All JSON values a path reaches, as a DuckDB list."""
    found = f"[{node}]"
    for step in re.findall(r"[^.(]+(?:\([^)]*\))?", path):
        if step == "first()":
            found = f"({found})[1:1]"
        elif step.startswith("where("):
            name, text = re.fullmatch(r"where\((\w+)='(.*)'\)", step).groups()
            found = f"list_filter({found}, lambda x: json_extract_string(x, '$.{name}') = '{text}')"
        else:
            found = _present(f"flatten(list_transform({found}, lambda x: {_members('x', step)}))")
    return found


def value(node: str, path: str) -> str:
    return f"json_extract_string(({reached(node, path)})[1], '$')"


def _nodes(table: str, is_array: bool) -> str:
    documents = f"SELECT *, TRY_CAST(payload_json AS JSON) AS document FROM ({typed(table)}) AS b"
    if not is_array:
        return f"SELECT *, document AS node, 0 AS position FROM ({documents}) AS d"
    lists = (
        "SELECT *, CASE WHEN json_type(document) = 'ARRAY' THEN CAST(document AS JSON[]) END AS nodes "
        f"FROM ({documents}) AS d"
    )
    return f"SELECT *, unnest(nodes) AS node, unnest(range(len(nodes))) AS position FROM ({lists}) AS l"


def flat(resource: str, as_text: bool = True) -> str:
    spec = RESOURCES[resource]
    source_types = {f.name: f.type for f in bronze_fields(spec.table)}
    columns = {}
    for target, source in spec.passthrough.items():
        columns[target] = (source, source_types[source])
    for name, path in spec.view.columns:
        target = spec.renames.get(name, name)
        kind = spec.types.get(target, "STRING")
        text = value("node", path)
        columns[target] = (text if kind == "STRING" else f"TRY_CAST({text} AS {'BIGINT' if kind == 'INT' else _type(kind)})", kind)
    if spec.index_column:
        columns[spec.index_column] = ("CAST(position AS INTEGER)", "INT")
    shown = [
        f"CAST({x} AS VARCHAR) AS {n}" if as_text and kind == "DATE" else f"{x} AS {n}"
        for n, (x, kind) in columns.items()
    ]
    return (
        f"SELECT {', '.join(shown)} FROM ({_nodes(spec.table, spec.is_array)}) AS n "
        f"WHERE json_extract_string(node, '$.resourceType') = '{spec.view.resource}'"
    )


def children(view_name: str) -> str:
    view = VIEWS[view_name]
    table = RESOURCES[CHILD_VIEWS[view_name]].table
    members = _members("node", view.for_each)
    items = (
        f"SELECT *, unnest(items) AS item, unnest(range(len(items))) AS item_position FROM ("
        f"SELECT *, {members} AS items FROM ({_nodes(table, False)}) AS n "
        f"WHERE json_extract_string(node, '$.resourceType') = '{view.resource}') AS i"
    )
    columns = ["name AS frappe_doc_name", "modified"]
    columns += [f"{value('node', path)} AS {name}" for name, path in view.columns]
    columns += [f"{value('item', path)} AS {name}" for name, path in view.nested]
    columns.append("CAST(item_position AS INTEGER) AS element_idx")
    return (
        f"SELECT {', '.join(columns)} FROM ({items}) AS e WHERE item IS NOT NULL AND json_type(item) <> 'NULL'"
    )


# ---- responses ----------------------------------------------------------------
# Column and the place of its value in the body, for refused and for accepted documents.
REFUSED = {
    "error_severity": "$.issue[0].severity",
    "error_code": "$.issue[0].code",
    "error_message": "$.issue[0].details.text",
    "error_expression": "$.issue[0].expression[0]",
}
ACCEPTED = {
    "submitted_resource_id": "$.id",
    "submitted_last_updated": "$.meta.lastUpdated",
    "submitted_version_id": "$.meta.versionId",
}
HEAD = "STATUS CODE:"


def _answers(spec) -> str:
    """One row per answer text."""
    rows = typed(spec.table)
    if not spec.is_array:
        return f"SELECT *, api_response AS answer FROM ({rows}) AS b WHERE api_response IS NOT NULL"
    listed = f"SELECT *, TRY_CAST(api_response AS JSON) AS whole FROM ({rows}) AS b"
    places = "CAST(range(CAST(json_array_length(whole) AS BIGINT)) AS INTEGER[])"
    return (
        f"SELECT * EXCLUDE (whole), CAST(json_extract(whole, '$[' || response_idx || ']') AS VARCHAR) AS answer "
        f"FROM (SELECT *, unnest({places}) AS response_idx FROM ({listed}) AS l WHERE json_type(whole) = 'ARRAY') AS p"
    )


def responses(resource: str) -> str:
    """Three kinds of answers, each read in its own way, then the fields of their bodies."""
    spec = RESOURCES[resource]
    digits = f"trim(split_part(substr(answer, {len(HEAD) + 1}), '{{', 1), chr(32) || chr(9) || chr(10) || chr(13))"
    inner = "json_extract_string(document, '$.response')"
    # kind -> (which answers, body, HTTP status)
    kinds = {
        "headed": (
            f"starts_with(answer, '{HEAD}')",
            "nullif(substr(answer, strpos(answer, '{')), answer)",
            f"TRY_CAST(string_split_regex({digits}, '[^0-9]')[1] AS INTEGER)",
        ),
        "wrapped": (
            f"document IS NOT NULL AND {inner} IS NOT NULL",
            inner,
            "TRY_CAST(json_extract_string(document, '$.status_code') AS INTEGER)",
        ),
        "bare": (
            f"document IS NOT NULL AND {inner} IS NULL",
            "answer",
            "TRY_CAST(json_extract_string(document, '$.status_code') AS INTEGER)",
        ),
        "other": ("document IS NULL", "CAST(NULL AS VARCHAR)", "CAST(NULL AS INTEGER)"),
    }
    headed = kinds["headed"][0]
    read = " UNION ALL ".join(
        f"SELECT *, {body} AS body, {status} AS submission_http_status FROM answers "
        f"WHERE {which if kind == 'headed' else f'NOT {headed} AND {which}'}"
        for kind, (which, body, status) in kinds.items()
    )
    paths = ["$.resourceType", *REFUSED.values(), *ACCEPTED.values()]
    fields = f"SELECT *, json_extract_string(body, {paths}) AS found FROM ({read}) AS r"
    sides = (
        f"SELECT *, found[1] = 'OperationOutcome' AS is_submission_error, "
        f"list_transform(found, lambda v: CASE found[1] WHEN 'OperationOutcome' THEN v END) AS refused, "
        f"list_transform(found, lambda v: CASE found[1] WHEN 'OperationOutcome' THEN NULL ELSE v END) AS accepted "
        f"FROM ({fields}) AS f"
    )
    shown = [f"refused[{i}] AS {name}" for i, name in enumerate(REFUSED, 2)]
    for i, name in enumerate(ACCEPTED, 2 + len(REFUSED)):
        value = f"CASE WHEN found[1] IS NOT NULL THEN accepted[{i}] END"
        shown.append(f"{f'TRY_CAST({value} AS TIMESTAMP)' if name.endswith('updated') else value} AS {name}")
    lead = _cleaned(bronze_fields(spec.table), DROPPED)
    index = "response_idx, " if spec.is_array else ""
    answers = f"SELECT *, TRY_CAST(answer AS JSON) AS document FROM ({_answers(spec)}) AS a"
    return _cte(
        {"answers": answers},
        f"SELECT {lead}, api_response, {index}submission_http_status, found[1] AS response_resource_type, "
        f"is_submission_error, {', '.join(shown)} FROM ({sides}) AS s",
    )


# ---- gold ---------------------------------------------------------------------
def code_list(name: str) -> str:
    return derived.code_list_sql(name, lambda base: base)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def registry(as_text: bool = True) -> str:
    names = [f.name for f in RULE.fields]
    with open(RULES_CSV, encoding="utf-8", newline="") as lines:
        rows = list(csv.reader(lines))[1:]
    values = ", ".join("(" + ", ".join(_quoted(c) if c else "NULL" for c in row) + ")" for row in rows)
    shipped = f"SELECT * FROM (VALUES {values}) AS v({', '.join(names)})"
    local = f"SELECT {', '.join(names)} FROM ({derived.registry_sql(lambda base: base)}) AS l"
    blank = {"authority_name", "authority_reference", "standard_name", "standard_version", "effective_to"}
    casts = {
        "effective_from": "DATE", "effective_to": "DATE", "version": "INTEGER",
        "created_at": "TIMESTAMP", "updated_at": "TIMESTAMP",
    }
    out = []
    for name in names:
        x = f"NULLIF(TRIM({name}), '')" if name in blank else name
        if name in casts:
            x = f"CAST({x} AS {casts[name]})"
        if as_text and casts.get(name) == "DATE":
            x = f"CAST({x} AS VARCHAR)"
        out.append(f"{x} AS {name}")
    return f"SELECT {', '.join(out)} FROM ({shipped} UNION ALL {local}) AS r"


def _parts() -> dict[str, str]:
    return {
        "patients": master("tabPatient"),
        "encounters": flat("encounter", False),
        "conditions": flat("condition", False),
        "observations": flat("observation", False),
        "procedures": flat("procedure", False),
        "icd10": code_list("icd_10"),
        "icd9": code_list("icd_9cm"),
    }


#: What a violating row shows: rule -> (part, patient, encounter, shown value, explanation around it).
SHOWN = {
    "CTL-TERM-ICD10-001": (
        "conditions", "patient", "satusehat_encounter_id", "icd_code",
        "Diagnosis code '%' tidak ditemukan di bronze.icd_10 (ICD-10 2010)",
    ),
    "CTL-TERM-ICD9CM-001": (
        "procedures", "patient_ihs", "satusehat_encounter_id", "code",
        "Procedure code '%' tidak ditemukan di bronze.icd_9cm (ICD-9-CM 2010)",
    ),
    "CTL-REF-COND-ENC-001": (
        "conditions", "patient", "satusehat_encounter_id", "satusehat_encounter_id",
        "Condition mereferensikan Encounter (satusehat_encounter_id = '%') yang tidak ditemukan di "
        "silver.encounter_fhir_resource",
    ),
    "CTL-REF-PROC-ENC-001": (
        "procedures", "patient_ihs", "satusehat_encounter_id", "satusehat_encounter_id",
        "Procedure mereferensikan Encounter (satusehat_encounter_id = '%') yang tidak ditemukan di "
        "silver.encounter_fhir_resource",
    ),
    "CTL-REF-OBS-ENC-001": (
        "observations", "patient", "satusehat_encounter_id", "satusehat_encounter_id",
        "Observation mereferensikan Encounter (satusehat_encounter_id = '%') yang tidak ditemukan di "
        "silver.encounter_fhir_resource",
    ),
    "CTL-STRUCT-ENC-STATUS-001": (
        "encounters", "patient", "satusehat_id", "fhir_status",
        "Encounter.status ('%') bukan salah satu dari 3 status yang wajib dikirim SatuSehat: "
        "arrived, in-progress, finished",
    ),
    "CTL-TEMPORAL-ENC-001": (
        "encounters", "patient", "satusehat_id", "concat_ws(' > ', period_start, period_end)",
        "Encounter.period_start (%) lebih besar dari period_end (%) -- timeline tidak mungkin",
    ),
    "CTL-IDENT-PAT-FORMAT-001": (
        "patients", "name", "NULL", "uid",
        "Patient.uid ('%') tidak berformat 16 digit numerik. Catatan: ini format-check saja -- "
        "definisi resmi field uid belum dikonfirmasi (lihat rule_basis = UNVERIFIED)",
    ),
}
#: Values that no set holds, as set differences, and predicates of single rows.
MISSING = {
    "CTL-TERM-ICD10-001": ("trim(icd_code)", "icd10", "trim(CODE)"),
    "CTL-TERM-ICD9CM-001": ("trim(code)", "icd9", "trim(CODE)"),
    "CTL-REF-COND-ENC-001": ("satusehat_encounter_id", "encounters", "satusehat_id"),
    "CTL-REF-PROC-ENC-001": ("satusehat_encounter_id", "encounters", "satusehat_id"),
    "CTL-REF-OBS-ENC-001": ("satusehat_encounter_id", "encounters", "satusehat_id"),
}
WRONG = {
    "CTL-STRUCT-ENC-STATUS-001": (
        "length(trim(fhir_status)) > 0 AND NOT list_contains(['arrived', 'in-progress', 'finished'], fhir_status)"
    ),
    "CTL-TEMPORAL-ENC-001": "date_diff('microsecond', period_end, period_start) > 0",
    "CTL-IDENT-PAT-FORMAT-001": (
        "length(trim(uid)) > 0 AND (length(trim(uid)) <> 16 OR translate(trim(uid), '0123456789', '') <> '')"
    ),
}


def _violations(rule_id: str) -> str:
    """What the rows that break a rule have of their own."""
    part, patient, encounter, value, why = SHOWN[rule_id]
    if rule_id in WRONG:
        which = WRONG[rule_id]
    else:
        key, known, known_key = MISSING[rule_id]
        which = f"{key} IN (SELECT {key} FROM {part} WHERE length(trim({key})) > 0 EXCEPT SELECT {known_key} FROM {known})"
    pieces = [_quoted(piece) for piece in why.split("%")]
    filling = ["CAST(period_start AS VARCHAR)", "CAST(period_end AS VARCHAR)"] if len(pieces) > 2 else [value]
    text = " || ".join(x for pair in zip(pieces, [*filling, "''"]) for x in pair)
    return (
        f"SELECT '{rule_id}' AS rule_id, {REGISTRY[rule_id].entity_id} AS entity_id, {patient} AS patient_id, "
        f"CAST({encounter} AS VARCHAR) AS encounter_id, {value} AS actual_value, {text} AS explanation "
        f"FROM {part} WHERE {which}"
    )


def _facts() -> str:
    """What all findings of a rule share."""
    rows = [
        (r.rule_id, r.audit_domain, r.focus_area, r.entity_type, r.expected, r.severity, f"silver.{r.source}:{r.entity_id}=")
        for r in REGISTRY.values()
    ]
    values = ", ".join("(" + ", ".join(map(_quoted, row)) + ")" for row in rows)
    names = "rule_id, audit_domain, focus_area, entity_type, expected_value, severity, place"
    return f"SELECT * FROM (VALUES {values}) AS v({names})"


EMPTY = {
    "audit_run_id": "VARCHAR", "resolved_at": "TIMESTAMP", "reviewer_id": "VARCHAR", "review_note": "VARCHAR",
    "resolution_code": "VARCHAR",
}


def _contract(rule_ids: Iterable[str]) -> str:
    empty = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in EMPTY.items())
    return (
        "SELECT v.*, f.* EXCLUDE (rule_id, place), 1 AS rule_version, 'OPEN' AS status, 'Frappe' AS source_system, "
        f"entity_id AS source_record_id, place || entity_id AS evidence_reference, {AS_OF} AS detected_at, {empty}, "
        "md5(concat_ws('|', 'NA', v.rule_id, entity_type, entity_id)) AS finding_id "
        f"FROM ({' UNION ALL '.join(map(_violations, rule_ids))}) AS v JOIN ({_facts()}) AS f ON f.rule_id = v.rule_id"
    )


def check(rule_id: str) -> str:
    needed = {SHOWN[rule_id][0], *MISSING.get(rule_id, ())}
    return _cte({n: sql for n, sql in _parts().items() if n in needed}, _contract([rule_id]))


def gold_parts() -> dict[str, str]:
    parts = _parts()
    parts["rules"] = registry(False)
    parts["findings"] = _contract(SHOWN)
    return parts


def _run() -> str:
    """Rows, rules and findings as one list of facts, added up at once."""
    changes = [f"SELECT modified AS changed, NULL AS version, NULL AS seen FROM {p}" for p in _parts() if not p.startswith("icd")]
    changes.append("SELECT NULL, version, NULL FROM rules WHERE status = 'ACTIVE'")
    changes.append("SELECT NULL, NULL, detected_at FROM findings")
    totals = (
        "SELECT CAST(max(changed) AS VARCHAR) AS data_snapshot, CAST(max(version) AS VARCHAR) AS rule_set_version, "
        "count(changed) AS records_scanned, count(seen) AS findings_created, "
        f"ifnull(min(seen), {AS_OF}) AS started_at, ifnull(max(seen), {AS_OF}) AS finished_at FROM facts"
    )
    return (
        f"WITH facts AS ({' UNION ALL '.join(changes)}) SELECT *, 'SUCCESS' AS status, "
        "md5(ifnull(data_snapshot, 'NA') || '|' || ifnull(rule_set_version, 'NA')) AS audit_run_id "
        f"FROM ({totals}) AS t"
    )


def findings() -> str:
    return _cte(gold_parts(), "FROM findings")


def run() -> str:
    return _cte({**gold_parts(), "runs": _run()}, "FROM runs")


def row_counts(names: list[str]) -> str:
    parts = gold_parts()
    sources = {"audit_finding": "findings", "audit_rule": "rules", "tabPatient": "patients"}
    sources |= {f"{p[:-1]}_fhir_resource": p for p in ("encounters", "conditions", "observations", "procedures")}
    sources |= {n: f"({master(n)}) AS m" for n in names if n in MASTER_TABLES and n not in sources}
    sources |= {n: f"({code_list(n)}) AS c" for n in names if n in CODE_LISTS}
    flats = {r.silver_table: r.name for r in RESOURCES.values()}
    sources |= {n: f"({flat(flats[n])}) AS f" for n in names if n in flats and n not in sources}
    counts = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, count(*) = 0 AS is_empty FROM {sources[n]}" for n in names
    )
    return _cte(parts, counts)


def rejects() -> str:
    """Payloads that no flat table holds, by table, day and reason."""
    out = []
    for resource in RESOURCES.values():
        kind = resource.view.resource
        own = "coalesce(json_extract_string({0}, '$.resourceType') = '" + kind + "', false)"
        documents = f"SELECT *, TRY_CAST(payload_json AS JSON) AS document FROM ({typed(resource.table)}) AS b"
        if resource.is_array:
            readable = "json_type(document) = 'ARRAY'"
            some = f"len(list_filter(CAST(document AS JSON[]), lambda x: {own.format('x')})) > 0"
        else:
            readable, some = "document IS NOT NULL", own.format("document")
        reason = (
            f"CASE WHEN payload_json IS NULL THEN 'missing' WHEN NOT coalesce({readable}, false) THEN 'unreadable' "
            f"WHEN NOT {some} THEN 'foreign' END"
        )
        out.append(
            f"SELECT '{resource.silver_table}' AS table_name, count(*) FILTER (WHERE why = 'missing') AS missing, "
            "count(*) FILTER (WHERE why = 'unreadable') AS unreadable, count(*) FILTER (WHERE why = 'foreign') AS \"foreign\", "
            f"CAST(CAST(modified AS DATE) AS VARCHAR) AS load_date FROM (SELECT modified, {reason} AS why FROM ({documents}) AS d) AS r "
            "WHERE why IS NOT NULL GROUP BY CAST(modified AS DATE)"
        )
    return " UNION ALL ".join(out)


def stored_counts() -> str:
    """Rows of every table of the three layers after one run over the feed."""
    parts = gold_parts()
    sources = {f"bronze.{t}": f"({typed(t)}) AS b" for t in [*MASTER_TABLES, *(r.table for r in RESOURCES.values())]}
    sources |= {f"bronze.{n}": f"({code_list(n)}) AS c" for n in CODE_LISTS}
    sources |= {f"silver.{t}": f"({master(t)}) AS m" for t in MASTER_TABLES}
    for r in RESOURCES.values():
        sources[f"silver.{r.parent_table}"] = f"({typed(r.table)}) AS p"
        sources[f"silver.{r.silver_table}"] = f"({flat(r.name)}) AS f"
    sources["silver.flatten_rejects"] = f"({rejects()}) AS r"
    sources |= {"gold.audit_rule": "rules", "gold.audit_finding": "findings", "gold.audit_run": "(SELECT 1 AS one) AS o"}
    sources |= {f"gold.{r.table}": f"(SELECT * FROM findings WHERE rule_id = '{r.rule_id}') AS k" for r in REGISTRY.values()}
    counts = " UNION ALL ".join(
        f"SELECT '{n.lower()}' AS table_name, count(*) AS row_count, count(*) = 0 AS is_empty FROM {source}" for n, source in sources.items()
    )
    return _cte(parts, counts)


def merged_master(table: str) -> str:
    """The newest of all rows, ranked at once."""
    return master(table)


def reloaded(table: str, first: str, last: str, emptied: str) -> str:
    inside = f"modified >= TIMESTAMP '{first}' AND modified < TIMESTAMP '{last}'"
    kept = f"length(name) % 2 = 0 AND CAST(modified AS DATE) <> DATE '{emptied}'"
    return bronze(table, f"WHERE NOT ({inside}) OR ({kept})")
