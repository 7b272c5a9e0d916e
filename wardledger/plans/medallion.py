"""Batch run over an interval: bronze, silver and gold tables of one environment."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..layout import Layout
from ..operators.clean import clean_columns, clean_text, latest_per_key, lost_winners, merge_latest
from ..operators.flatten import ACCEPTED, REJECT, flatten_resource, rejects_sql
from ..operators.profile import FLAT_SUFFIX, list_tables, row_counts
from ..operators.responses import responses_sql
from ..operators.rules import ENCOUNTER_TABLE, FINDING, Slot, active, evaluate, known_keys, reference_slots, rules
from ..session import tune
from ..sources.readers import day_of, load_bronze
from ..sources.resources import RESOURCES, Resource
from ..sources.schemas import MASTER_TABLES, bronze_tables
from ..sources.sinks import (
    LOAD_DATE,
    export_csv,
    export_sample,
    overwrite_interval,
    overwrite_table,
    publish_view,
    read_interval,
    stored_table,
)
from .audit import SCANNED, audit_run, day_totals, finding_totals, newest_versions, run_from_totals

Day = datetime | date | str
# What the dashboard filters on are the partitions; a finding is found by its bucket.
FINDING_PARTITIONS = ("audit_domain", "severity", "status", "rule_id")
FINDING_BUCKETS = 8
PARENT_DROPS = ("api_response", "payload_json", "_user_tags", "_comments", "_assign", "_liked_by")


class Medallion:
    """Builders of the three layers; ``run`` calls them in order.

    The tables of a layer do not depend on each other: ``writers`` of them are written at
    a time, so that the small ones do not leave a cluster idle.
    """

    def __init__(self, spark: SparkSession, layout: Layout, writers: int = 6) -> None:
        self.spark, self.layout, self.writers = tune(spark), layout, writers
        layout.create(spark)

    def _each(self, write: Callable[[Any], None], items: Iterable[Any]) -> None:
        with ThreadPoolExecutor(self.writers) as pool:
            list(pool.map(write, items))  # the first failure is raised here

    def table(self, layer: str, name: str) -> DataFrame:
        df = self.spark.table(self.layout.table(layer, name))
        return df.drop(LOAD_DATE)

    # ---- bronze -------------------------------------------------------------
    def load(self, read: Callable[[str], DataFrame], start: Day, end: Day) -> None:
        """Typed rows of ``[start, end)`` of every source table."""

        def write(name: str) -> None:
            overwrite_interval(load_bronze(read(name), name), self.layout.table("bronze", name), start, end)

        self._each(write, bronze_tables())

    def load_code_lists(self, code_lists: Mapping[str, DataFrame]) -> None:
        self._each(lambda name: overwrite_table(code_lists[name], self.layout.table("bronze", name)), code_lists)

    # ---- silver -------------------------------------------------------------
    def merge_master(self, name: str, start: Day, end: Day) -> None:
        """Current state of a master table from its former state and the rows of the interval.

        The former rows are kept as they came, so names are compared raw; the view shows
        them cleaned. History is read only where a replaced interval took away the newest
        row of a record.
        """
        table, bronze = self.layout.table("silver", name), self.layout.table("bronze", name)
        fresh, former = read_interval(self.spark, bronze, start, end), stored_table(self.spark, table)
        if former is None:
            state = latest_per_key(self.table("bronze", name))
        else:
            lost = lost_winners(former, fresh, day_of(start), day_of(end))
            known = {} if lost.isEmpty() else {"lost": lost, "history": self.table("bronze", name)}
            state = merge_latest(former, fresh, day_of(start), day_of(end), **known)
        overwrite_table(state, table, shown=clean_columns(state.schema))

    def build_resource(self, spec: Resource, start: Day, end: Day) -> None:
        """Cleaned parent and flat rows of the interval; one parse gives the rows and the rejects."""
        bronze = self.layout.table("bronze", spec.table)
        fresh = read_interval(self.spark, bronze, start, end)
        overwrite_interval(clean_text(fresh, drop=PARENT_DROPS), self.layout.table("silver", spec.parent_table), start, end)
        tagged = flatten_resource(fresh, spec, tagged=True)
        held = self.layout.stored("silver", spec.silver_table)
        overwrite_interval(tagged, held, start, end, partition_by=[REJECT])
        shown = ", ".join(f"`{c}`" for c in [*(c for c in tagged.columns if c != REJECT), LOAD_DATE])
        flat = self.layout.table("silver", spec.silver_table)
        publish_view(self.spark, flat, f"SELECT {shown} FROM {held} WHERE {REJECT} = '{ACCEPTED}'")
        answers = responses_sql(bronze, self.table("bronze", spec.table).schema, spec.is_array)
        publish_view(self.spark, self.layout.table("silver", spec.audit_table), answers)

    def build_silver(self, start: Day, end: Day) -> None:
        """Current state by merge; parents, flat resources, rejects and day totals of the interval."""
        self._each(lambda name: self.merge_master(name, start, end), MASTER_TABLES)
        self._each(lambda spec: self.build_resource(spec, start, end), RESOURCES.values())
        left_out = [
            rejects_sql(self.layout.stored("silver", spec.silver_table), spec.silver_table, LOAD_DATE) for spec in RESOURCES.values()
        ]
        rejects = self.layout.table("silver", "flatten_rejects")
        publish_view(self.spark, rejects, " UNION ALL ".join(left_out))
        flat = {name: self.layout.table("silver", name) for name in SCANNED if name not in MASTER_TABLES}
        days = [day_totals(read_interval(self.spark, table, start, end), name) for name, table in flat.items()]
        overwrite_interval(reduce(DataFrame.unionAll, days), self.layout.stored("silver", "day_totals"), start, end, LOAD_DATE)
        states = [day_totals(self.table("silver", name), name, LOAD_DATE) for name in SCANNED if name in MASTER_TABLES]
        overwrite_table(reduce(DataFrame.unionAll, states), self.layout.stored("silver", "state_totals"))

    # ---- gold ---------------------------------------------------------------
    def silver_tables(self, newest_only: bool = False) -> dict[str, DataFrame]:
        tables = {name: self.table("silver", name) for name in {*SCANNED, ENCOUNTER_TABLE}}
        if newest_only:
            for spec in RESOURCES.values():
                if spec.silver_table in tables:
                    tables[spec.silver_table] = newest_versions(tables[spec.silver_table], spec.grain)
        return tables

    def store_keys(self, tables: Mapping[str, DataFrame]) -> dict[Slot, DataFrame]:
        """Distinct keys of every reference, written once a run."""
        names = {slot: self.layout.stored("silver", f"{slot[0]}_keys") for slot in reference_slots(rules())}
        self._each(lambda slot: overwrite_table(known_keys(slot, tables), names[slot]), names)
        return {slot: self.spark.table(name) for slot, name in names.items()}

    def build_gold(
        self,
        registry: DataFrame,
        code_lists: Mapping[str, DataFrame],
        as_of: str,
        newest_only: bool = False,
    ) -> None:
        """Findings are written once, by what queries filter on; each check is a live view of its rule."""
        tables = self.silver_tables(newest_only)
        overwrite_table(registry, self.layout.table("gold", "audit_rule"))
        rule = self.table("gold", "audit_rule")
        tables |= code_lists
        fired = [r["rule_id"] for r in active(rule).collect()]  # one row a rule of the library
        findings = self.spark.createDataFrame([], FINDING)
        if fired:
            findings = evaluate(tables, as_of, fired, stored_keys=self.store_keys(tables))
        if newest_only:
            findings = findings.dropDuplicates(["finding_id"])
        stored = self.layout.table("gold", "audit_finding")
        shown = [f"`{c}`" for c in findings.columns]
        overwrite_table(findings, stored, FINDING_PARTITIONS, (FINDING_BUCKETS, "finding_id"), shown)
        totals = self.layout.stored("gold", "finding_totals")
        overwrite_table(finding_totals(self.table("gold", "audit_finding")), totals)
        for one in rules():
            publish_view(self.spark, self.layout.table("gold", one.table), f"SELECT * FROM {stored} WHERE rule_id = '{one.rule_id}'")
        if newest_only:
            run = audit_run(tables, rule, self.table("gold", "audit_finding"), as_of)
        else:
            kept = ["day_totals", "state_totals"]
            data = reduce(DataFrame.unionByName, [self.spark.table(self.layout.stored("silver", t)).drop(LOAD_DATE) for t in kept])
            run = run_from_totals(data, rule, self.spark.table(totals), as_of)
        overwrite_table(run, self.layout.table("gold", "audit_run"))

    def run(
        self,
        read: Callable[[str], DataFrame],
        start: Day,
        end: Day,
        registry: DataFrame,
        code_lists: Mapping[str, DataFrame],
        as_of: str,
        newest_only: bool = False,
    ) -> None:
        self.load(read, start, end)
        self.load_code_lists(code_lists)
        self.build_silver(start, end)
        self.build_gold(registry, code_lists, as_of, newest_only)

    # ---- exports and profile --------------------------------------------------
    def export(self, folder: str) -> None:
        """Samples of bronze; responses, flat resources and gold as a whole; row counts."""
        for name in list_tables(self.spark, self.layout.database("bronze")):
            export_sample(self.table("bronze", name), f"{folder}/bronze/{name}.csv")
        for spec in RESOURCES.values():
            view = self.layout.table("silver", spec.audit_table)
            if self.spark.catalog.tableExists(view):
                export_csv(self.spark.table(view), f"{folder}/silver/{spec.audit_table}.csv")
        for name in list_tables(self.spark, self.layout.database("silver"), FLAT_SUFFIX):
            export_csv(self.table("silver", name), f"{folder}/silver/{name}.csv")
        gold = list_tables(self.spark, self.layout.database("gold"))
        for name in gold:
            export_csv(self.table("gold", name), f"{folder}/gold/{name}.csv")
        export_csv(self.profile("gold"), f"{folder}/gold/_row_counts_summary.csv")

    def profile(self, layer: str, suffix: str = "") -> DataFrame:
        names = list_tables(self.spark, self.layout.database(layer), suffix)
        return row_counts({name: self.table(layer, name) for name in names})

    def empty_tables(self, layer: str) -> list[str]:
        """Names of the tables without rows."""
        return [r["table_name"] for r in self.profile(layer).where("is_empty").collect()]
