import json

from wardledger.operators.responses import parse_responses

DONE = {"resourceType": "Encounter", "id": "r1", "meta": {"lastUpdated": "2026-07-02T01:02:03+00:00", "versionId": "7"}}
FAILED = {
    "resourceType": "OperationOutcome", "id": "e1",
    "issue": [{"severity": "error", "code": "invalid", "details": {"text": "bad"}, "expression": ["a.b", "c"]}],
}
COLUMNS = (
    "submission_http_status response_resource_type is_submission_error error_severity error_code error_message "
    "error_expression submitted_resource_id submitted_version_id"
).split()
SUCCESS = (None, "Encounter", False, None, None, None, None, "r1", "7")
ERROR = (None, "OperationOutcome", True, "error", "invalid", "bad", "a.b", None, None)


def parsed(spark, *answers, **kw):
    df = spark.createDataFrame(
        [(f" d{i} ", a, "p", "t") for i, a in enumerate(answers)],
        "name string, api_response string, payload_json string, _user_tags string",
    )
    return parse_responses(df, **kw)


def one(spark, answer):
    row = parsed(spark, answer).first()
    return tuple(row[c] for c in COLUMNS)


def test_body_itself(spark):
    assert one(spark, json.dumps(DONE)) == SUCCESS
    assert one(spark, json.dumps(FAILED)) == ERROR


def test_wrapped_body(spark):
    assert one(spark, json.dumps({"status_code": 201, "response": json.dumps(DONE)})) == (201, *SUCCESS[1:])
    assert one(spark, json.dumps({"status_code": "400", "response": json.dumps(FAILED)})) == (400, *ERROR[1:])
    assert one(spark, json.dumps({"status_code": "soon", "response": "no json"})) == (None,) * 9
    # a null response leaves the answer itself as the body
    assert one(spark, json.dumps({"status_code": 204, "response": None, **DONE})) == (204, *SUCCESS[1:])


def test_prefixed_body(spark):
    assert one(spark, "STATUS CODE: 400\n\n" + json.dumps(FAILED)) == (400, *ERROR[1:])
    assert one(spark, "STATUS CODE: 400\n\n" + json.dumps(FAILED, indent=2)) == (400, *ERROR[1:])
    assert one(spark, "STATUS CODE: x\n\n" + json.dumps(DONE)) == SUCCESS
    assert one(spark, "STATUS CODE: 502") == (502, *(None,) * 8)
    assert one(spark, " STATUS CODE: 400") == (None,) * 9


def test_incomplete_bodies(spark):
    assert one(spark, "gateway timeout") == (None,) * 9
    assert one(spark, '{"message":"x"}') == (None,) * 9
    assert one(spark, '{"resourceType":"OperationOutcome"}') == (None, "OperationOutcome", True, *(None,) * 6)
    assert one(spark, '{"resourceType":"OperationOutcome","id":"e","issue":[]}')[7] is None


def test_null_response_is_dropped_and_columns(spark):
    df = parsed(spark, None, "x")
    assert df.count() == 1
    assert df.columns == ["name", "api_response", *COLUMNS[:8], "submitted_last_updated", "submitted_version_id"]
    assert df.first()["name"] == "d1"


def test_last_updated(spark):
    assert str(parsed(spark, json.dumps(DONE)).first()["submitted_last_updated"]) == "2026-07-02 01:02:03"
    odd = {**DONE, "meta": {"lastUpdated": "yesterday"}}
    assert parsed(spark, json.dumps(odd)).first()["submitted_last_updated"] is None


def test_array_answers(spark):
    wrapped = {"status_code": 201, "response": json.dumps(DONE)}
    df = parsed(
        spark, json.dumps([wrapped, None, FAILED, "STATUS CODE: 400"]), "[]", json.dumps(wrapped), "oops", None,
        is_array=True,
    )
    got = {r["response_idx"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}
    assert got == {0: (201, *SUCCESS[1:]), 1: (None,) * 9, 2: ERROR, 3: (None,) * 9}
    assert df.columns[:3] == ["name", "api_response", "response_idx"]
