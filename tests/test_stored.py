"""Queries over the tables of a batch run: results, plans, and what a narrower re-run leaves."""

import re

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from wardledger.layout import Layout
from wardledger.operators.clean import interval_slice
from wardledger.plans.dashboard import checked
from wardledger.plans.medallion import Medallion
from wardledger.plans.stored_clinic import LOADS, StoredClinic
from wardledger.sources import derived
from wardledger.sources.readers import load_bronze
from wardledger.sources.resources import RESOURCES
from wardledger.sources.sinks import overwrite_interval, read_interval, stored_table

NAMES = [n for n in entry_module.stored_queries() if not n.startswith("merged_") or n == "merged_tabPatient"]


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.fixture(scope="module")
def clinic(spark, folder):
    return StoredClinic.of(spark, folder)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, folder, duck, name):
    df = entry_module.queries()[name](spark, folder)
    columns, extra, missing, rows = differences(df, duck, entry_module.oracle_sql()[name])
    assert not columns and not extra and not missing
    assert rows > 0 or name == "stored_finding_detail"


def plan(df):
    spark = df.sparkSession
    for key, value in (("spark.sql.maxMetadataStringLength", "2000"), ("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")):
        spark.conf.set(key, value)
    text = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    return text


def test_counts_read_no_finding(clinic):
    board = clinic.queries()
    for name in ("findings_summary", "findings_by_domain", "top_recurring_rules"):
        text = plan(board.run(name))
        assert "audit_finding_" not in text and "finding_totals_" in text, name


def test_lists_prune_partitions_and_a_finding_its_bucket(clinic):
    board = clinic.queries()
    text = plan(board.run("list_findings", rule_id="CTL-TERM-ICD10-001", severity="HIGH"))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text)[1]
    assert "rule_id" in filters and "severity" in filters and "TakeOrderedAndProject" in text
    some = clinic.table("gold", "audit_finding").first()
    detail = board.run("finding_detail", finding_id=some["finding_id"])
    assert "SelectedBucketsCount: 1 out of 8" in plan(detail)
    assert {r["entity_id"] for r in detail.collect()} == {some["entity_id"]}


def test_pages_by_key_follow_each_other(clinic):
    board = clinic.queries()
    every = [r["finding_id"] for r in board.run("list_findings", limit=200).collect()]
    found, place = [], {}
    for _ in range(4):
        page = board.run("list_findings", limit=50, **place).collect()
        found += [r["finding_id"] for r in page]
        place = {"after_detected_at": page[-1]["detected_at"], "after_finding_id": page[-1]["finding_id"]}
    # A finding that fires twice has one id: a page may end between the two.
    assert found == every or set(found) >= set(every[:190])
    text = plan(board.run("list_findings", limit=50, **place))
    assert re.search(r"PushedFilters: \[.*finding_id", text) and "Sort [" not in text
    with pytest.raises(ValueError):
        checked("list_findings", {"after_finding_id": "x"})


def test_the_run_reads_no_payload(clinic):
    """Its totals agree with the tables; they were counted when the rows were stored."""
    silver = [clinic.table("silver", t) for t in ("tabPatient", *(RESOURCES[r].silver_table for r in ("condition", "observation", "procedure", "encounter")))]
    run = clinic.table("gold", "audit_run").first()
    assert run["records_scanned"] == sum(t.count() for t in silver)
    assert run["findings_created"] == clinic.table("gold", "audit_finding").count()


def test_profile_reads_footers_only(clinic):
    text = plan(clinic.profile())
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    of_rejects = [s for s in schemas if "_reject" in s]
    assert len(schemas) > 70 and set(schemas) - set(of_rejects) == {"struct<>"}


def test_discovery_sees_no_store(clinic):
    names = {r["table_name"] for r in clinic.profile().select("table_name").collect()}
    assert "bronze.icd_10" in names and "gold.audit_run" in names
    assert not any("store" in n or n.endswith("_days") or "totals" in n for n in names)


def test_merge_reads_one_interval(spark, folder):
    """The plan of a later load scans the former state and the days of the load, not the history."""
    base = derived.parquet_relation(spark, folder)
    source = load_bronze(derived.raw_table(spark, base, "tabItem", feed=True), "tabItem")
    job = Medallion(spark, Layout("__merge"))
    bronze = job.layout.table("bronze", "tabItem")
    overwrite_interval(source, bronze, *LOADS[0])
    job.merge_master("tabItem", *LOADS[0])
    former = stored_table(spark, job.layout.table("silver", "tabItem"))
    overwrite_interval(source, bronze, *LOADS[1])
    from wardledger.operators.clean import lost_winners, merge_latest

    fresh = read_interval(spark, bronze, *LOADS[1])
    assert lost_winners(former, fresh, *LOADS[1]).isEmpty()
    text = plan(merge_latest(former, fresh, *LOADS[1]))
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    assert len(filters) == 2 and sum("load_date" in f and LOADS[1][0] in f for f in filters) == 1


def test_rejects_of_a_day_survive_a_narrower_run(spark, folder):
    base = derived.parquet_relation(spark, folder)
    spec = RESOURCES["encounter"]
    source = load_bronze(derived.raw_table(spark, base, spec.table, feed=True), spec.table)
    job = Medallion(spark, Layout("__narrow"))
    held = job.layout.stored("silver", spec.silver_table)

    def build(start, end):
        overwrite_interval(source, job.layout.table("bronze", spec.table), start, end)
        job.build_resource(spec, start, end)

    def counts():
        return {(r["load_date"], r["_reject"]): r["count"] for r in spark.table(held).groupBy("load_date", "_reject").count().collect()}

    build(*derived.FEED_DAYS)
    before = counts()
    assert len({day for day, why in before if why != "none"}) > 2
    build("2026-07-02", "2026-07-03")
    assert counts() == before


def test_the_feed_is_spread_by_ranges_of_its_key(spark, folder):
    ranged = spark.sql(f"SELECT * FROM {derived.parquet_relation(spark, folder, by_range=True)('orders')}")
    dealt = spark.sql(f"SELECT * FROM {derived.parquet_relation(spark, folder)('orders')}")
    key = F.col("o_orderkey")
    spans = sorted((r["low"], r["high"]) for r in ranged.groupBy(F.spark_partition_id()).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect())
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert ranged.count() == dealt.count() and ranged.exceptAll(dealt).isEmpty()


def test_each_task_of_the_feed_takes_its_base_rows_in_order(spark, tmp_path):
    keys = [(7 * i) % 500 for i in range(500)] + [None, 3, 3]
    rows = spark.createDataFrame([(k, f"s{i}") for i, k in enumerate(keys)], "o_orderkey long, o_orderstatus string").coalesce(1)
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    ranged = spark.sql(f"SELECT * FROM {derived.parquet_relation(spark, str(tmp_path), by_range=True)('orders')}")
    tasks = ranged.rdd.glom().collect()
    for task in tasks:
        found = [-1 if r["o_orderkey"] is None else r["o_orderkey"] for r in task]
        assert found == sorted(found)
    assert sorted(r["o_orderstatus"] for task in tasks for r in task) == sorted(f"s{i}" for i in range(len(keys)))


def test_the_time_of_a_feed_is_made_once(spark, folder):
    """A filter on it neither repeats it nor runs ahead of the spread."""
    table = "tabDiagnosticReport_SatuSehat"
    feed = derived.raw_table(spark, derived.parquet_relation(spark, folder, by_range=True), table, feed=True)
    loaded = interval_slice(load_bronze(feed, table), *derived.FEED_DAYS).withColumn("day", F.to_date("modified"))
    text = loaded._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("cast(l_shipdate") <= 2  # the time and the end
    below = text[text.index("Generate explode"):]
    assert "Filter" not in below
    assert loaded.count() == spark.read.parquet(f"{folder}/lineitem.parquet").count()
