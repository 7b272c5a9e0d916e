"""A query of each kind against DuckDB at the smallest scale."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module

KINDS = (
    "interval_slice blank_to_null nested_to_json timestamp_text official_identifier "
    "typed_projection_tabItem latest_per_key_tabPatient code_list_icd_o clean_parent_immunization "
    "flatten_allergy_intolerance flatten_encounter flatten_observation flatten_questionnaire_response_item "
    "parse_response_encounter parse_response_observation audit_rule audit_finding audit_overview "
    "top_recurring_rules list_findings_filtered"
).split()


def test_every_query_has_sql():
    optional = set(entry_module.LLM_QUERIES)  # some of these cannot be put as SQL
    assert set(entry_module.queries()) - optional == set(entry_module.oracle_sql()) - optional


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", KINDS)
def test_query(spark, folder, duck, name):
    df = entry_module.queries()[name](spark, folder)
    columns, extra, missing, rows = differences(df, duck, entry_module.oracle_sql()[name])
    assert not columns and not extra and not missing and rows > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
