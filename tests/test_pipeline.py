from collections import Counter

from wardledger.operators.flatten import flatten_rejects
from wardledger.layout import Layout
from wardledger.plans.dashboard import Queries
from wardledger.plans.derived_clinic import DerivedClinic
from wardledger.plans.medallion import Medallion
from wardledger.sources import derived
from wardledger.sources.resources import RESOURCES
from wardledger.sources.schemas import bronze_tables


def test_batch_run_equals_lazy_chain(spark, folder, tmp_path):
    clinic = DerivedClinic(spark, folder)
    # Times of the base tables span decades; the run keeps one day per partition,
    # so the test shifts every record into three days and loads them in two steps.
    shift = "concat('2026-07-0', 2 + pmod(xxhash64(name), 3), substr(modified, 11)) AS modified"
    raw = {}
    for name in bronze_tables():
        table = derived.raw_table(spark, clinic.base, name)
        columns = [shift if c == "modified" else c for c in table.columns]
        table.selectExpr(*columns).write.parquet(f"{tmp_path}/raw/{name}")
        raw[name] = spark.read.parquet(f"{tmp_path}/raw/{name}")
    codes = {name: clinic.code_list(name) for name in ("icd_10", "icd_9cm")}
    job = Medallion(spark, Layout("__run"))
    job.load(raw.__getitem__, "2026-07-02", "2026-07-04")
    job.build_silver("2026-07-02", "2026-07-04")
    job.run(raw.__getitem__, "2026-07-04", "2026-07-05", clinic.rule_registry(), codes, derived.AS_OF)

    for name in ("encounter", "observation"):
        assert job.table("silver", RESOURCES[name].silver_table).count() == clinic.flat(name).count()
        # Another session of the catalog reads what the lazy chain parses; only the days differ.
        answers = spark.newSession().table(job.layout.table("silver", RESOURCES[name].audit_table)).drop("modified", "load_date")
        expected = clinic.responses(name).drop("modified")
        assert Counter(map(tuple, answers.select(expected.columns).collect())) == Counter(map(tuple, expected.collect()))
        assert job.table("silver", RESOURCES[name].parent_table).count() == clinic.parent(name).count()

    rejected = job.table("silver", "flatten_rejects").where("table_name = 'encounter_fhir_resource'")
    expected = flatten_rejects(clinic.bronze(RESOURCES["encounter"].table), "encounter").first()
    total = rejected.groupBy().sum("missing", "unreadable", "foreign").first()
    assert tuple(total) == tuple(expected) and expected["unreadable"] > 0

    def bag(df):
        return Counter(tuple(r) for r in df.where("entity_type <> 'Patient'").collect())

    found = job.table("gold", "audit_finding")
    stored = bag(found)
    assert stored == bag(clinic.findings())
    icd = job.table("gold", "audit_check_terminology_icd10_validity")
    assert icd.count() == found.where("rule_id = 'CTL-TERM-ICD10-001'").count() > 0
    board = Queries.over(spark, Layout("__run"))
    run = job.table("gold", "audit_run").collect()
    assert len(run) == 1 and run[0]["findings_created"] == found.count()
    assert board.run("findings_summary").first()["total"] == found.count()
    assert job.empty_tables("gold") == []

    job.build_gold(clinic.rule_registry(), codes, derived.AS_OF, newest_only=True)
    newest = job.table("gold", "audit_finding")
    assert newest.count() == newest.select("finding_id").distinct().count()
    assert {r["finding_id"] for r in newest.where("entity_type <> 'Patient'").collect()} == {r[0] for r in stored}

    job.export(f"{tmp_path}/out")
    assert spark.read.csv(f"{tmp_path}/out/gold/audit_rule.csv", header=True, escape='"').count() == 209  # rules of the shipped registry and of the part table
    assert spark.read.csv(f"{tmp_path}/out/bronze/tabitem.csv", header=True, escape='"').count() == 5
