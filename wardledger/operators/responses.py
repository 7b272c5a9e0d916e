"""Parse what the receiving API answered into success and error columns.

Three shapes occur: the body itself, ``{"status_code": n, "response": "<body>"}``
and ``STATUS CODE: n`` followed by the body. Text is parsed once; a wrapped body
costs one more parse of the inner text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.fhirpath import text_at
from ..functions.text import strict_json
from .clean import clean_columns

# ---- fixed values: markers of the response shapes ---------------------------
STATUS_PREFIX = "STATUS CODE:"
STATUS_PATTERN = r"STATUS CODE:\s*(\d+)"
BODY_PATTERN = r"(?s)(\{.*)"
ERROR_TYPE = "OperationOutcome"
# ---- end of fixed values ----------------------------------------------------


def _body_columns(is_array: bool) -> list[str]:
    """``submission_http_status`` and ``_body`` (VARIANT) of the VARIANT column ``_response``."""
    wrapped = text_at("_response", "$.response")
    body = f"CASE WHEN {wrapped} IS NOT NULL THEN {strict_json(wrapped)} ELSE _response END"
    code = f"try_cast({text_at('_response', '$.status_code')} AS int)"
    if not is_array:
        headed = f"startswith(api_response, '{STATUS_PREFIX}')"
        stated = f"try_cast(regexp_extract(api_response, r'{STATUS_PATTERN}', 1) AS int)"
        below = strict_json(f"regexp_extract(api_response, r'{BODY_PATTERN}', 1)")
        body = f"CASE WHEN {headed} THEN {below} ELSE {body} END"
        code = f"CASE WHEN {headed} THEN {stated} ELSE {code} END"
    return [f"{code} AS submission_http_status", f"{body} AS _body"]


def _outcome_columns() -> list[str]:
    kind = text_at("_body", "$.resourceType")
    failed, accepted = f"{kind} = '{ERROR_TYPE}'", f"{kind} <> '{ERROR_TYPE}'"

    def error(path: str) -> str:
        return f"CASE WHEN {failed} THEN {text_at('_body', path)} END"

    def success(path: str) -> str:
        return f"CASE WHEN {accepted} THEN {text_at('_body', path)} END"

    return [
        f"{kind} AS response_resource_type",
        f"{failed} AS is_submission_error",
        f"{error('$.issue[0].severity')} AS error_severity",
        f"{error('$.issue[0].code')} AS error_code",
        f"{error('$.issue[0].details.text')} AS error_message",
        f"{error('$.issue[0].expression[0]')} AS error_expression",
        f"{success('$.id')} AS submitted_resource_id",
        f"try_cast({success('$.meta.lastUpdated')} AS timestamp_ntz) AS submitted_last_updated",
        f"{success('$.meta.versionId')} AS submitted_version_id",
    ]


DROPS = ("payload_json", "_user_tags", "_comments", "_assign", "_liked_by")


def _projections(schema: T.StructType, is_array: bool, index_column: str, drop: tuple[str, ...]) -> list[list[str]]:
    """The columns of each step, from answered rows to the parsed responses."""
    cleaned = clean_columns(schema, drop, keep_raw=("api_response",))
    kept = [f"`{f.name}`" for f in schema.fields if f.name not in drop]
    lead = [c for c in kept if c != "`api_response`"] + ["`api_response`"]
    steps = [cleaned, [*kept, f"{strict_json('api_response')} AS _response"]]
    if is_array:
        elements = "posexplode(try_variant_get(_response, '$', 'array<variant>'))"
        steps.append([*kept, f"{elements} AS (`{index_column}`, _response)"])
        lead.append(f"`{index_column}`")
    steps.append([*lead, *_body_columns(is_array)])
    steps.append([*lead, "submission_http_status", *_outcome_columns()])
    return steps


def parse_responses(
    bronze: DataFrame, is_array: bool = False, index_column: str = "response_idx", drop: tuple[str, ...] = DROPS
) -> DataFrame:
    """One row per response (per list element when ``is_array``)."""
    df = bronze.where("api_response IS NOT NULL")
    for columns in _projections(bronze.schema, is_array, index_column, drop):
        df = df.selectExpr(*columns)
    return df


def responses_sql(
    table: str, schema: T.StructType, is_array: bool = False, index_column: str = "response_idx", drop: tuple[str, ...] = DROPS
) -> str:
    """The same as one statement over the stored ``table``, for a view of the catalog."""
    sql = f"(SELECT * FROM {table} WHERE api_response IS NOT NULL)"
    for columns in _projections(schema, is_array, index_column, drop):
        sql = f"(SELECT {', '.join(columns)} FROM {sql})"
    return sql[1:-1]
