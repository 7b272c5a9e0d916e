from collections import Counter

import pytest

from wardledger.operators import rules as R
from wardledger.operators.membership import key_set, without_match

AS_OF = "2026-08-12 00:00:00"


def condition(spark, *rows):
    return spark.createDataFrame(
        list(rows), "frappe_doc_name string, patient string, satusehat_encounter_id string, icd_code string"
    )


def run_check(rule_id, tables):
    return R.check(R.rules([rule_id])[0], tables, AS_OF)


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffled"])
def joins(request, spark):
    """Both ways of a join, with partitions of a few bytes split where a key is hot."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": request.param,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name in changed:
        spark.conf.unset(name)


def test_hot_keys_either_way(spark, joins):
    """A third of the rows hold one dangling key, another third one known key."""
    child = spark.range(0, 3000).selectExpr(
        "id AS n",
        "CASE WHEN id % 3 = 0 THEN 'lost' WHEN id % 3 = 1 THEN 'k1' WHEN id % 30 = 2 THEN NULL "
        "WHEN id % 30 = 5 THEN '  ' ELSE concat('k', id % 8) END AS key",
    )
    child = child.unionAll(child.where("key = 'lost'"))
    parent = spark.createDataFrame([(k,) for k in ["k1", "k1", "k2", "k3", "k4", "k5", None, ""]], "id string")
    known = {"k1", "k2", "k3", "k4", "k5"}
    expected = Counter(r["n"] for r in child.collect() if r["key"] and r["key"].strip() and r["key"] not in known)
    got = without_match(child, "key", key_set(parent, "id"))
    assert got.columns == ["n", "key"]
    assert Counter(r["n"] for r in got.collect()) == expected and sum(expected.values()) > 2000


def test_empty_reference_violates_everything(spark, joins):
    child = spark.createDataFrame([("a",), ("a",), (" ",), (None,)], "key string")
    none = spark.createDataFrame([], "id string")
    assert without_match(child, "key", key_set(none, "id")).count() == 2


def test_codes_match_trimmed_both_ways(spark):
    codes = spark.createDataFrame([("A1 ", "2010"), ("A1", "2016"), ("B2", "2010")], "CODE string, VERSION string")
    rows = condition(
        spark, ("c1", "p", "e", " A1 "), ("c2", "p", "e", "B2"), ("c3", "p", "e", "b2"), ("c4", "p", "e", None),
        ("c5", "p", "e", "  "), ("c6", "p", "e", "X9 "),
    )
    got = run_check("CTL-TERM-ICD10-001", {"condition_fhir_resource": rows, "icd_10": codes}).collect()
    assert sorted(r["entity_id"] for r in got) == ["c3", "c6"]
    six = next(r for r in got if r["entity_id"] == "c6")
    assert six["actual_value"] == "X9 "
    assert six["explanation"] == "Diagnosis code 'X9 ' tidak ditemukan di bronze.icd_10 (ICD-10 2010)"
    assert six["evidence_reference"] == "silver.condition_fhir_resource:frappe_doc_name=c6"


def test_encounter_link_is_untrimmed(spark):
    encounters = spark.createDataFrame([("SS-1",), (None,), ("",)], "satusehat_id string")
    rows = condition(spark, ("c1", "p", "SS-1", None), ("c2", "p", "SS-1 ", None), ("c3", "p", "", None), ("c4", None, "SS-9", None))
    got = run_check("CTL-REF-COND-ENC-001", {"condition_fhir_resource": rows, "encounter_fhir_resource": encounters})
    assert sorted(r["entity_id"] for r in got.collect()) == ["c2", "c4"]


def encounters(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "frappe_doc_name string, patient string, satusehat_id string, fhir_status string, s string, e string",
    ).selectExpr("*", "cast(s AS timestamp_ntz) AS period_start", "cast(e AS timestamp_ntz) AS period_end")


def test_row_rules_in_one_pass(spark):
    table = encounters(
        spark,
        ("e1", "p", "S1", "arrived", "2026-07-02", "2026-07-01"),
        ("e2", "p", "S2", " arrived", None, None),
        ("e3", "p", "S3", "Arrived", "2026-07-02", "2026-07-01 12:00:00"),
        ("e4", "p", "S4", "  ", "2026-07-02", "2026-07-02"),
        ("e5", "p", "S5", None, "2026-07-02", None),
        ("e6", "p", "S6", "finished", "2026-07-01", "2026-07-02"),
    )
    group = [r for r in R.rules() if r.source == "encounter_fhir_resource"]
    got = R.entity_findings(table, group, AS_OF)
    pairs = sorted((r["rule_id"], r["entity_id"]) for r in got.collect())
    assert pairs == [
        ("CTL-STRUCT-ENC-STATUS-001", "e2"), ("CTL-STRUCT-ENC-STATUS-001", "e3"),
        ("CTL-TEMPORAL-ENC-001", "e1"), ("CTL-TEMPORAL-ENC-001", "e3"),
    ]
    temporal = next(r for r in got.collect() if r["rule_id"] == "CTL-TEMPORAL-ENC-001" and r["entity_id"] == "e3")
    assert temporal["actual_value"] == "2026-07-02 00:00:00 > 2026-07-01 12:00:00"
    separate = R.check(group[0], {"encounter_fhir_resource": table}, AS_OF).unionByName(
        R.check(group[1], {"encounter_fhir_resource": table}, AS_OF)
    )
    assert Counter(map(tuple, separate.collect())) == Counter(map(tuple, got.collect()))


def test_uid_format(spark):
    values = {
        "ok": "1234567890123456", "pad": " 1234567890123456 ", "short": "123456789012345", "long": "12345678901234567",
        "letter": "12345678901234X6", "newline": "1234567890123456\n", "blank": " ", "none": None,
    }
    patients = spark.createDataFrame(list(values.items()), "name string, uid string")
    got = run_check("CTL-IDENT-PAT-FORMAT-001", {"tabPatient": patients}).collect()
    assert sorted(r["entity_id"] for r in got) == ["letter", "long", "newline", "short"]
    assert {r["encounter_id"] for r in got} == {None}


def test_finding_id_is_stable(spark):
    patients = spark.createDataFrame([("PAT-1", "1")], "name string, uid string")
    row = run_check("CTL-IDENT-PAT-FORMAT-001", {"tabPatient": patients}).first()
    expected = spark.sql("SELECT md5('NA|CTL-IDENT-PAT-FORMAT-001|Patient|PAT-1') AS m").first()["m"]
    assert row["finding_id"] == expected and row["status"] == "OPEN" and row["audit_run_id"] is None


def test_contract_is_asserted(spark):
    with pytest.raises(ValueError):
        R.assert_contract(spark.createDataFrame([("x",)], "finding_id string"))


def test_registration_guards():
    rule = R.rules(["CTL-TEMPORAL-ENC-001"])[0]
    with pytest.raises(ValueError):
        R.register(rule)
    assert len(R.rules()) == 8 and "CTL-IDENT-PAT-COMPLETE-001" not in R.REGISTRY


def entity_tables(spark):
    """All tables of the rules, with one hot dangling key and one hot unknown code."""
    rows = spark.range(300).selectExpr(
        "concat('d', id) AS frappe_doc_name", "'p' AS patient", "'i' AS patient_ihs",
        "IF(id % 3 = 0, 'lost', concat('SS-', id % 40)) AS satusehat_encounter_id",
        "CASE WHEN id % 3 = 1 THEN 'ZZ' WHEN id % 7 = 0 THEN ' ' ELSE concat(' A', id % 9) END AS icd_code",
        "concat('P', id % 9) AS code",
    )
    return {
        "condition_fhir_resource": rows, "procedure_fhir_resource": rows, "observation_fhir_resource": rows,
        "encounter_fhir_resource": spark.range(30).selectExpr(
            "concat('e', id) AS frappe_doc_name", "'p' AS patient", "concat('SS-', id) AS satusehat_id",
            "IF(id % 4 = 0, 'planned', 'arrived') AS fhir_status", "timestamp_ntz'2026-07-02 00:00:00' AS period_start",
            "IF(id % 5 = 0, timestamp_ntz'2026-07-01 00:00:00', NULL) AS period_end",
        ),
        "tabPatient": spark.createDataFrame([("a", "1"), ("b", "1234567890123456")], "name string, uid string"),
        "icd_10": spark.range(6).selectExpr("concat('A', id, ' ') AS CODE"),
        "icd_9cm": spark.range(6).selectExpr("concat('P', id) AS CODE"),
    }


def test_one_pass_equals_single_checks(spark, joins):
    tables = entity_tables(spark)
    expected = Counter(tuple(r) for rule in R.rules() for r in R.check(rule, tables, AS_OF).collect())
    assert len({row[2] for row in expected}) == 8
    assert Counter(map(tuple, R.evaluate(tables, AS_OF).collect())) == expected


def test_one_scan_per_entity(spark):
    plan = R.evaluate(entity_tables(spark), AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 300") == 3


def test_only_active_rules_fire(spark):
    patients = spark.createDataFrame([("p", "12")], "name string, uid string")
    encounters = spark.createDataFrame(
        [("e", "planned", "p", "s", None, None)],
        "frappe_doc_name string, fhir_status string, patient string, satusehat_id string, period_start timestamp_ntz, period_end timestamp_ntz",
    )
    ids = ["CTL-IDENT-PAT-FORMAT-001", "CTL-STRUCT-ENC-STATUS-001"]
    tables = {"tabPatient": patients, "encounter_fhir_resource": encounters}
    registry = spark.createDataFrame([(ids[0], "BLOCKED"), (ids[1], "ACTIVE"), ("other", "ACTIVE")], "rule_id string, status string")
    fired = lambda **more: {r["rule_id"] for r in R.evaluate(tables, AS_OF, ids, **more).collect()}
    assert fired() == set(ids) and fired(registry=registry) == {ids[1]}
