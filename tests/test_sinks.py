import re
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest

from wardledger.layout import Layout
from wardledger.operators.profile import health, list_tables, publish, row_counts
from wardledger.session import tune
from wardledger.sources.readers import day_of, read_source
from wardledger.sources import sinks
from wardledger.sources.sinks import (
    export_csv,
    export_sample,
    overwrite_interval,
    overwrite_table,
    read_interval,
    stored_table,
)


def versions(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, m string").selectExpr(
        "name", "cast(m AS timestamp_ntz) AS modified"
    )


def names(df):
    return sorted(r["name"] for r in df.collect())


@pytest.fixture()
def layout(spark):
    layout = Layout("__t")
    layout.create(spark)
    return layout


def test_layout_names():
    assert Layout("__dev").table("gold", "audit_rule") == "gold__dev.audit_rule"
    assert Layout("").database("silver") == "silver"
    with pytest.raises(ValueError):
        Layout("").database("platinum")


def test_interval_overwrite(spark, layout):
    table = layout.table("bronze", "history")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    first = versions(spark, ("in", "2026-07-02"), ("late", "2026-07-02 23:59:59.9"), ("out", "2026-07-03"), ("b", "2026-07-01 12:00:00"))
    overwrite_interval(first, table, "2026-07-01", "2026-07-03")
    assert names(spark.table(table)) == ["b", "in", "late"]
    # the same interval again: no duplicates
    overwrite_interval(first, table, "2026-07-01", "2026-07-03")
    assert names(spark.table(table)) == ["b", "in", "late"]
    # the next interval leaves the earlier days alone
    overwrite_interval(first, table, "2026-07-03", "2026-07-04")
    assert names(spark.table(table)) == ["b", "in", "late", "out"]
    # a row that moved to a later day disappears from its old day, which is now empty
    moved = versions(spark, ("in", "2026-07-02"), ("late", "2026-07-02 08:00:00"))
    overwrite_interval(moved, table, "2026-07-01", "2026-07-03")
    assert names(spark.table(table)) == ["in", "late", "out"]
    assert names(read_interval(spark, table, "2026-07-02", "2026-07-03")) == ["in", "late"]
    overwrite_interval(moved.where("false"), table, "2026-07-02", "2026-07-03")
    assert names(spark.table(table)) == ["out"]


def test_interval_needs_day_boundaries():
    assert day_of("2026-07-02 00:00:00") == "2026-07-02" == day_of("2026-07-02T00:00:00")
    with pytest.raises(ValueError):
        day_of("2026-07-02 00:30:00")


def test_interval_read_prunes_partitions(spark, layout):
    table = layout.table("bronze", "pruned")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    overwrite_interval(versions(spark, ("a", "2026-07-01"), ("b", "2026-07-02")), table, "2026-07-01", "2026-07-03")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = read_interval(spark, table, "2026-07-02", "2026-07-03")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]
    assert "load_date" in filters and "2026-07-02" in filters


def test_read_source_parquet(spark, tmp_path):
    versions(spark, ("a", "2026-07-01")).write.parquet(f"{tmp_path}/tabX")
    assert names(read_source(spark, "tabX", str(tmp_path))) == ["a"]


def test_exports(spark, tmp_path):
    df = spark.range(20).selectExpr("id", "concat('say \"', id, '\", ok') AS t")
    export_csv(df, f"{tmp_path}/full.csv")
    export_sample(df, f"{tmp_path}/sample.csv")
    back = spark.read.csv(f"{tmp_path}/full.csv", header=True, escape='"')
    assert back.count() == 20 and back.where("t = 'say \"3\", ok'").count() == 1
    assert spark.read.csv(f"{tmp_path}/sample.csv", header=True).count() == 5


def test_profile_publish_and_health(spark, layout):
    for name in ("audit_finding", "audit_rule", "other"):
        spark.sql(f"DROP TABLE IF EXISTS {layout.table('gold', name)}")
    assert health(spark, layout) == {"status": "degraded", "gold_reachable": False}
    overwrite_table(versions(spark, ("a", "2026-07-01")).selectExpr("name AS finding_id"), layout.table("gold", "audit_finding"))
    overwrite_table(spark.range(0), layout.table("gold", "audit_rule"))
    overwrite_table(spark.range(3), layout.table("gold", "other"))
    assert health(spark, layout)["status"] == "ok"
    assert list_tables(spark, "gold__t", "_rule") == ["audit_rule"]
    tables = {n: spark.table(layout.table("gold", n)) for n in ("audit_finding", "audit_rule")}
    assert sorted(map(tuple, row_counts(tables).collect())) == [("audit_finding", 1, False), ("audit_rule", 0, True)]
    report = {r["table_name"]: r["status"] for r in publish(spark, layout).collect()}
    assert report["audit_finding"] == report["audit_rule"] == "ready" and report["audit_run"] == "missing"
    assert "other" not in report and spark.table(layout.view("audit_finding")).count() == 1


def test_publish_isolates_failures(spark, tmp_path):
    layout = Layout("__broken")
    layout.create(spark)
    where = f"{tmp_path}/gone"
    spark.range(3).write.parquet(where)
    spark.sql(f"CREATE TABLE {layout.table('gold', 'audit_run')} USING parquet LOCATION '{where}'")
    for part in list((tmp_path / "gone").glob("*.parquet")):
        part.write_bytes(b"broken")
    overwrite_table(spark.range(1), layout.table("gold", "audit_rule"))
    rows = publish(spark, layout, ["audit_run", "audit_rule"]).collect()
    assert {r["table_name"]: r["status"] for r in rows} == {"audit_run": "failed", "audit_rule": "ready"}
    assert {r["table_name"]: bool(r["reason"]) for r in rows} == {"audit_run": True, "audit_rule": False}


def test_views_of_two_environments(spark):
    for suffix, rows in (("__one", 1), ("__two", 2)):
        layout = Layout(suffix)
        layout.create(spark)
        overwrite_table(spark.range(rows), layout.table("gold", "audit_rule"))
        publish(spark, layout, ["audit_rule"])
    assert [spark.newSession().table(Layout(s).view("audit_rule")).count() for s in ("__one", "__two")] == [1, 2]


def test_a_late_row_is_not_lost(spark, layout, tmp_path):
    """A row that arrives while an interval is loaded is stored with the next load of it."""
    table, source = layout.table("bronze", "late"), f"{tmp_path}/source"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    versions(spark, ("a", "2026-07-01"), ("b", "2026-07-02")).write.parquet(source)

    def load():
        overwrite_interval(spark.read.parquet(source), table, "2026-07-01", "2026-07-04")

    load()
    read_once = spark.read.parquet(source)  # its files are listed now
    versions(spark, ("c", "2026-07-03")).write.mode("append").parquet(source)
    overwrite_interval(read_once, table, "2026-07-01", "2026-07-04")
    load()
    assert {r["name"] for r in spark.table(table).collect()} == {"a", "b", "c"}


def interrupted(monkeypatch, at):
    """A run that ends with an error at a step of ``sinks``."""
    def fail(*_, **__):
        raise RuntimeError("ended here")

    monkeypatch.setattr(sinks, at, fail)


def test_a_reader_sees_old_rows_or_new_ones(spark, layout, monkeypatch):
    table = layout.table("bronze", "switched")
    old, new = versions(spark, ("a", "2026-07-01"), ("b", "2026-07-02")), versions(spark, ("c", "2026-07-02 01:00:00"))
    overwrite_interval(old, table, "2026-07-01", "2026-07-04")
    seen, before = [], spark.table(table)
    real = sinks._switch

    def watched(*args, **noted):
        seen.append(names(spark.table(table)))  # all is written, nothing is switched
        real(*args, **noted)

    monkeypatch.setattr(sinks, "_switch", watched)
    overwrite_interval(new, table, "2026-07-02", "2026-07-04")
    assert seen == [["a", "b"]] and names(spark.table(table)) == ["a", "c"]
    assert names(before) == ["a", "b"]  # what was opened earlier can still be read


def test_a_failed_run_leaves_nothing_to_see(spark, layout, monkeypatch):
    days, whole = layout.table("bronze", "fail_days"), layout.table("bronze", "fail_whole")
    rows = versions(spark, ("a", "2026-07-01"), ("b", "2026-07-02"))
    overwrite_interval(rows, days, "2026-07-01", "2026-07-03")
    overwrite_table(rows, whole)
    tables = list_tables(spark, "bronze__t")
    with monkeypatch.context() as broken:
        interrupted(broken, "_switch")
        for write in (
            lambda: overwrite_interval(versions(spark, ("x", "2026-07-01"), ("y", "2026-07-03")), days, "2026-07-01", "2026-07-04"),
            lambda: overwrite_table(versions(spark, ("x", "2026-07-01")), whole),
        ):
            with pytest.raises(RuntimeError):
                write()
    assert names(spark.table(days)) == names(spark.table(whole)) == ["a", "b"]
    assert list_tables(spark, "bronze__t") == tables
    # The rows of the failed run do not come back with the next one.
    overwrite_interval(versions(spark, ("z", "2026-07-02")), days, "2026-07-02", "2026-07-03")
    assert names(spark.table(days)) == ["a", "z"]
    overwrite_table(rows.limit(1), whole)
    overwrite_table(rows.limit(1), whole)
    builds = [t for t in list_tables(spark, "bronze__t__store") if t.startswith("fail_whole_")]
    assert len(builds) == 2  # this one and the one before


def test_old_builds_are_dropped(spark, layout):
    table = layout.table("bronze", "cleaned")
    for i in range(4):
        overwrite_interval(versions(spark, (f"r{i}", "2026-07-01"), (f"s{i}", "2026-07-02")), table, "2026-07-01", "2026-07-03")
    assert names(spark.table(table)) == ["r3", "s3"]
    held = [r[0] for r in spark.sql("SHOW PARTITIONS bronze__t__store.cleaned_days").collect()]
    assert sorted(held) == [f"load_date=2026-07-0{d}/_build={b}" for d in (1, 2) for b in (3, 4)]


def test_rebuild_may_read_what_it_replaces(spark, layout):
    table = layout.table("silver", "grows")
    overwrite_table(versions(spark, (" a ", "2026-07-01")), table, shown=["trim(name) AS name", "modified"])
    for _ in range(2):
        held = stored_table(spark, table)
        overwrite_table(held.union(held), table, shown=["trim(name) AS name", "modified"])
    assert names(spark.table(table)) == ["a"] * 4 and names(stored_table(spark, table)) == [" a "] * 4


def test_buckets_and_partitions_are_pruned(spark, layout):
    table = layout.table("gold", "sliced")
    overwrite_table(spark.range(500).selectExpr("cast(id AS string) AS id", "id % 3 AS part"), table, ["part"], (8, "id"))
    # Pruned with or without this setting, but shown in the plan only with it.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    plan = spark.table(table).where("id = '77'")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan and spark.table(table).where("id = '77'").count() == 1
    plan = spark.table(table).where("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*part", plan) and spark.table(table).where("part = 1").count() == 167


def test_days_are_written_by_the_tasks_that_read_them(spark, layout):
    """No shuffle holds the rows of a load a second time; a long interval still brings a day together."""
    table, store = layout.table("bronze", "direct"), "bronze__t__store.direct_days"
    rows = spark.range(0, 300, 1, 3).selectExpr("cast(id AS string) AS name", "timestamp_ntz'2026-07-01' + make_interval(0, 0, 0, id % 2) AS modified")
    overwrite_interval(rows, table, "2026-07-01", "2026-07-03")
    files = spark.table(store).selectExpr("load_date", "input_file_name() AS f").distinct().collect()
    assert len(files) == 6 and all(r["f"].endswith(".zstd.parquet") for r in files)
    overwrite_interval(rows, table, "2026-01-01", "2026-12-31")
    files = spark.table(store).where("_build = 2").selectExpr("input_file_name() AS f").distinct().collect()
    assert len(files) == 2 and spark.table(table).count() == 300


def test_shuffle_files_go_with_their_query(spark, layout):
    assert tune(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    df = spark.range(50).repartition(3, "id").groupBy("id").count()
    assert len(df.collect()) == len(df.collect()) == df.count() == 50


def test_payloads_are_stored_tight(spark, layout, tmp_path):
    """Less than zstd takes at its usual level: long texts that differ in a few numbers."""
    text = "'{\"resourceType\":\"Thing\",\"id\":\"' || id || '\",\"subject\":{\"reference\":\"Patient/' || id * 7 % 9973 || '\"},\"context\":\"' || id * 31 || '\"}'"
    rows = spark.range(0, 60000, 1, 1).selectExpr("id", f"{text} AS payload")
    usual = {k: v for k, v in sinks.FILES.items() if not k.endswith(".level")}
    rows.write.options(**usual).parquet(str(tmp_path / "usual"))
    table = layout.table("silver", "tight")
    sinks.overwrite_table(rows, table)
    own = spark.table(table).selectExpr("input_file_name() AS f").distinct().collect()
    size = sum(Path(unquote(urlparse(r["f"]).path)).stat().st_size for r in own)
    assert size < 0.97 * sum(f.stat().st_size for f in (tmp_path / "usual").glob("*.parquet"))
    assert spark.table(table).count() == 60000


def test_payloads_and_answers_have_no_dictionary(spark, layout):
    """Not even where one would do: whether it does is known only after it was built."""
    import pyarrow.parquet as pq

    texts = [f"'a' || id % 3 AS {name}" for name in ("payload_json", "api_response", "kind")]
    table = layout.table("bronze", "texts")
    sinks.overwrite_table(spark.range(2000).coalesce(1).selectExpr(*texts), table)
    file = spark.table(table).selectExpr("input_file_name() AS f").first()["f"]
    group = pq.ParquetFile(unquote(urlparse(file).path)).metadata.row_group(0)
    held = {group.column(i).path_in_schema: group.column(i).has_dictionary_page for i in range(group.num_columns)}
    assert held == {"payload_json": False, "api_response": False, "kind": True}
