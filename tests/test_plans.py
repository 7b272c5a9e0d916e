"""The shape of the plans that matter at scale, on stored tables."""

import re

import pytest

from wardledger.operators.clean import interval_slice, latest_per_key
from wardledger.operators.flatten import flatten_resource
from wardledger.operators.membership import key_set, without_match
from wardledger.operators.responses import parse_responses
from wardledger.operators.rules import entity_findings, evaluate, rules
from wardledger.plans.derived_clinic import DerivedClinic
from wardledger.sources.resources import RESOURCES


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """Bronze tables written to files, as the jobs find them."""
    clinic, root = DerivedClinic(spark, folder), tmp_path_factory.mktemp("bronze")
    out = {}
    for name in ("encounter", "observation"):
        clinic.bronze(RESOURCES[name].table).write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["encounter", "observation"])
def test_one_parse_no_python_no_shuffle(stored, name):
    flat = flatten_resource(stored[name], name)
    assert optimized(flat).count("parseJson") == 1
    assert "Exchange" not in physical(flat) and "Python" not in physical(flat)


def test_flatten_reads_only_needed_columns(stored):
    flat = flatten_resource(stored["encounter"], "encounter").select("frappe_doc_name", "fhir_status")
    schema = re.search(r"ReadSchema: (\S+)", physical(flat))[1]
    assert schema == "struct<name:string,payload_json:string>"


def test_responses_parse_text_once_and_inner_bodies_once(stored):
    plan = optimized(parse_responses(stored["encounter"]))
    assert plan.count("parseJson") == 3 and "Exchange" not in plan


def test_interval_reaches_the_scan(stored):
    plan = physical(interval_slice(stored["encounter"], "1997-01-01", "1998-01-01"))
    assert "PushedFilters: [IsNotNull(modified), GreaterThanOrEqual(modified" in plan


def test_group_limit_before_the_shuffle(stored):
    plan = physical(latest_per_key(stored["encounter"].select("name", "modified")))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and any("Partial" in line for line in limits)


@pytest.fixture(scope="module")
def known(spark, stored, tmp_path_factory):
    """The key table of a run."""
    keys = f"{tmp_path_factory.mktemp('keys')}/keys"
    key_set(stored["encounter"], "satusehat_id").write.parquet(keys)
    return spark.read.parquet(keys)


def test_small_key_table_is_broadcast_and_child_not_shuffled(stored, known):
    plan = physical(without_match(stored["observation"], "satusehat_encounter_id", known))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "hashpartitioning" not in plan


def test_large_key_table_is_one_exchange_a_side(spark, stored, known):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(without_match(stored["observation"].select("name", "satusehat_encounter_id"), "satusehat_encounter_id", known))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("hashpartitioning") == 2, plan


def test_no_job_while_findings_are_built(spark, folder):
    tracker = spark.sparkContext.statusTracker()
    clinic = DerivedClinic(spark, folder)
    tables = {name: clinic[name] for name in {t for r in rules() for t in (r.source, r.reference) if t}}
    registry = clinic.rule_registry()
    spark.sparkContext.setJobGroup("building", "")
    try:
        evaluate(tables, "2026-08-12", registry=registry)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_row_rules_scan_once(stored):
    flat = flatten_resource(stored["encounter"], "encounter")
    group = [r for r in rules() if r.source == "encounter_fhir_resource"]
    assert physical(entity_findings(flat, group, "2026-08-12")).count("FileScan") == 1
