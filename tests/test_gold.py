import pytest

from wardledger.operators.rules import FINDING
from wardledger.plans.audit import SCANNED, audit_run, newest_versions
from wardledger.plans.dashboard import DETAIL_COLUMNS, LIST_COLUMNS, RULE_COLUMNS, Queries, checked
from wardledger.sources.readers import RULE, read_code_list, read_rules, typed_rules

AS_OF = "2026-08-12 00:00:00"


def findings(spark, *rows):
    """rows: finding_id, rule_id, audit_domain, severity, status, detected_at"""
    given = ["finding_id", "rule_id", "audit_domain", "severity", "status", "detected_at"]
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in given))
    return df.selectExpr(
        *[
            f"cast({f.name if f.name in given else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in FINDING.fields
        ]
    )


def test_shipped_registry(spark):
    rules = read_rules(spark)
    assert rules.schema == RULE or rules.columns == RULE.names
    rows = {r["rule_id"]: r for r in rules.collect()}
    assert len(rows) == 9
    assert [k for k, r in rows.items() if r["status"] == "BLOCKED"] == ["CTL-IDENT-PAT-COMPLETE-001"]
    assert "Patient.uid" in rows["CTL-IDENT-PAT-FORMAT-001"]["description"]
    assert rows["CTL-TEMPORAL-ENC-001"]["authority_name"] is None
    assert rows["CTL-TERM-ICD10-001"]["effective_to"] is None
    assert rows["CTL-TERM-ICD10-001"]["standard_version"] == "2010"
    assert str(rows["CTL-TERM-ICD10-001"]["effective_from"]) == "2026-08-12"


def test_registry_severity_agrees_with_rules(spark):
    from wardledger.operators.rules import rules

    registry = {r["rule_id"]: r for r in read_rules(spark).collect()}
    for rule in rules():
        row = registry[rule.rule_id]
        assert (row["severity"], row["audit_domain"], row["focus_area"]) == (
            rule.severity, rule.audit_domain, rule.focus_area,
        )


def test_typed_rules_blanks(spark):
    raw = spark.createDataFrame(
        [tuple(" " if f.name in ("authority_name", "effective_to") else "2026-08-12" if f.name == "effective_from"
               else "3" if f.name == "version" else "2026-08-12 00:00:00" if f.name.endswith("_at") else " v "
               for f in RULE.fields)],
        ", ".join(f"{f.name} string" for f in RULE.fields),
    )
    row = typed_rules(raw).first()
    assert row["authority_name"] is None and row["effective_to"] is None
    assert row["standard_name"] == "v" and row["rule_name"] == " v " and row["version"] == 3


def test_code_list_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text('a,b,c\nA00,"Cholera, ""classic""",2010\n007,x,2010\n')
    rows = read_code_list(spark, str(tmp_path / "c.csv"), "icd_10").collect()
    assert [tuple(r) for r in rows] == [("A00", 'Cholera, "classic"', "2010"), ("007", "x", "2010")]


def scanned(spark, *stamps):
    empty = spark.createDataFrame([], "modified timestamp_ntz")
    tables = {name: empty for name in SCANNED}
    if stamps:
        tables["tabPatient"] = spark.createDataFrame([(s,) for s in stamps], "m string").selectExpr(
            "cast(m AS timestamp_ntz) AS modified"
        )
    return tables


def test_run_snapshot(spark):
    found = findings(spark, ("f1", "r", "d", "LOW", "OPEN", "2026-08-01"), ("f2", "r", "d", "LOW", "OPEN", "2026-08-02"))
    tables = scanned(spark, "2026-07-02 00:00:00.12", "2026-07-01")
    row = audit_run(tables, read_rules(spark), found, AS_OF).collect()
    assert len(row) == 1
    row = row[0]
    assert (row["data_snapshot"], row["rule_set_version"], row["status"]) == ("2026-07-02 00:00:00.12", "1", "SUCCESS")
    assert (row["records_scanned"], row["findings_created"]) == (2, 2)
    assert (str(row["started_at"]), str(row["finished_at"])) == ("2026-08-01 00:00:00", "2026-08-02 00:00:00")
    again = audit_run(tables, read_rules(spark), found, "2030-01-01").first()
    assert again["audit_run_id"] == row["audit_run_id"]
    assert row["audit_run_id"] == spark.sql("SELECT md5('2026-07-02 00:00:00.12|1') AS m").first()["m"]


def test_run_snapshot_of_nothing(spark):
    row = audit_run(scanned(spark), read_rules(spark).where("false"), findings(spark), AS_OF).first()
    assert row["audit_run_id"] == spark.sql("SELECT md5('NA|NA') AS m").first()["m"]
    assert str(row["started_at"]) == str(row["finished_at"]) == "2026-08-12 00:00:00"
    assert (row["records_scanned"], row["findings_created"], row["data_snapshot"]) == (0, 0, None)


def test_newest_versions(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 0, 2), ("a", 1, 1)], "frappe_doc_name string, i int, modified int")
    assert sorted(map(tuple, newest_versions(df, ("frappe_doc_name", "i")).collect())) == [("a", 0, 2), ("a", 1, 1)]


@pytest.fixture(scope="module")
def board(spark):
    found = findings(
        spark,
        ("f1", "CTL-TERM-ICD10-001", "A", "HIGH", "OPEN", "2026-08-01"),
        ("f2", "CTL-TERM-ICD10-001", "A", "HIGH", "RESOLVED", "2026-08-03"),
        ("f3", "CTL-TEMPORAL-ENC-001", "B", "MEDIUM", "UNDER_REVIEW", "2026-08-03"),
        ("f4", "UNKNOWN", None, "LOW", "OPEN", "2026-08-02"),
    )
    run = audit_run(scanned(spark), read_rules(spark), found, AS_OF)
    return Queries(read_rules(spark), found, run)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_overview(board):
    row = board.run("audit_overview").collect()
    assert len(row) == 1 and (row[0]["applicable_checks"], row[0]["total_rules_in_registry"]) == (8, 9)


def test_summary(board, spark):
    assert rows(board.run("findings_summary")) == [(4, 2, 1, 1, 2, 1, 1)]
    assert rows(Queries(read_rules(spark), findings(spark)).run("findings_summary")) == [(0,) * 7]


def test_by_domain(board):
    assert rows(board.run("findings_by_domain")) == [("A", 2, 1, 2), ("B", 1, 0, 0), (None, 1, 1, 0)]


def test_top_rules(board):
    got = rows(board.run("top_recurring_rules", limit=2))
    assert [r[0] for r in got] == ["CTL-TERM-ICD10-001", "CTL-TEMPORAL-ENC-001"] and got[0][2:] == ("HIGH", 2)
    assert rows(board.run("top_recurring_rules"))[-1] == ("UNKNOWN", None, None, 1)


def test_list_findings(board):
    def ids(**kw):
        return [r["finding_id"] for r in board.run("list_findings", **kw).collect()]

    assert ids() == ["f2", "f3", "f4", "f1"]
    assert ids(limit=2, offset=1) == ["f3", "f4"] and ids(offset=9) == []
    assert ids(severity="HIGH") == ["f2", "f1"] and ids(severity="HIGH", status="OPEN") == ["f1"]
    assert ids(audit_domain="B", rule_id="CTL-TEMPORAL-ENC-001") == ["f3"] and ids(status="X") == []
    assert board.run("list_findings").columns == LIST_COLUMNS


def test_detail(board):
    got = board.run("finding_detail", finding_id="f3")
    assert got.columns == DETAIL_COLUMNS and len(DETAIL_COLUMNS) == 27
    assert got.first()["rule_basis"] == "DATA_QUALITY_CONTROL"
    assert board.run("finding_detail", finding_id="f4").first()["rule_name"] is None


def test_rules_list(board):
    got = board.run("list_audit_rules")
    ids = [r["rule_id"] for r in got.collect()]
    assert ids == sorted(ids) and len(ids) == 9 and got.columns == RULE_COLUMNS


@pytest.mark.parametrize(
    "action, params",
    [
        ("nope", {}), ("finding_detail", {}), ("list_findings", {"limit": 201}), ("list_findings", {"limit": "5"}),
        ("list_findings", {"limit": -1}), ("list_findings", {"offset": -1}), ("top_recurring_rules", {"limit": True}),
    ],
)
def test_bad_parameters(action, params):
    with pytest.raises(ValueError):
        checked(action, params)


def test_defaults():
    assert checked("list_findings", {"limit": 200})["offset"] == 0
    assert checked("top_recurring_rules", {}) == {"limit": 10}
