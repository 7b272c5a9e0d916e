"""The whole chain, lazily, over clinical tables derived from a folder of base tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_text, current_state
from ..operators.flatten import flatten_children, flatten_resource
from ..operators.responses import parse_responses
from ..operators.rules import check, evaluate, rules
from ..session import tune
from ..sources import derived
from ..sources.readers import RULES_CSV, load_bronze, raw_rule_schema, read_csv, typed_rules
from ..sources.resources import CHILD_VIEWS, RESOURCES
from ..sources.schemas import CODE_LISTS, MASTER_TABLES
from .audit import audit_run
from .dashboard import Queries

PARENT_DROPS = ("api_response", "payload_json", "_user_tags", "_comments", "_assign", "_liked_by")


class DerivedClinic(Mapping[str, DataFrame]):
    """``clinic[name]`` builds the frame of any table of the chain by its name."""

    def __init__(self, spark: SparkSession, folder: str, as_of: str = derived.AS_OF) -> None:
        self.spark, self.as_of = tune(spark), as_of
        self.base = derived.parquet_relation(spark, folder)
        self._sorted = derived.parquet_relation(spark, folder, sorted_rows=True)
        self._frames: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Keep the (lazy) frame, so a plan is built once and equal parts stay equal."""
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    def bronze(self, table: str) -> DataFrame:
        base = self._sorted if table in MASTER_TABLES else self.base  # the versions of a record are sorted
        return self._once(
            table, lambda: load_bronze(derived.raw_table(self.spark, base, table), table)
        )

    def master(self, table: str) -> DataFrame:
        return self._once(f"current {table}", lambda: current_state(self.bronze(table)))

    def parent(self, resource: str) -> DataFrame:
        return clean_text(self.bronze(RESOURCES[resource].table), drop=PARENT_DROPS)

    def flat(self, resource: str) -> DataFrame:
        spec = RESOURCES[resource]
        return self._once(spec.silver_table, lambda: flatten_resource(self.bronze(spec.table), spec))

    def children(self, view: str) -> DataFrame:
        return flatten_children(self.bronze(RESOURCES[CHILD_VIEWS[view]].table), view)

    def responses(self, resource: str) -> DataFrame:
        spec = RESOURCES[resource]
        return parse_responses(self.bronze(spec.table), is_array=spec.is_array)

    def code_list(self, name: str) -> DataFrame:
        return derived.code_list(self.spark, self.base, name)

    def rule_registry(self) -> DataFrame:
        shipped = read_csv(self.spark, RULES_CSV, raw_rule_schema())
        return typed_rules(shipped.unionByName(derived.raw_rules(self.spark, self.base)))

    def check(self, rule_id: str) -> DataFrame:
        return check(rules([rule_id])[0], self, self.as_of)

    def findings(self) -> DataFrame:
        return self._once("findings", lambda: evaluate(self, self.as_of, registry=self.rule_registry()))

    def run(self) -> DataFrame:
        return audit_run(self, self.rule_registry(), self.findings(), self.as_of)

    def queries(self, with_run: bool = False) -> Queries:
        return Queries(self.rule_registry(), self.findings(), self.run() if with_run else None)

    def __getitem__(self, name: str) -> DataFrame:
        if name in MASTER_TABLES:
            return self.master(name)
        if name in CODE_LISTS:
            return self.code_list(name)
        for resource in RESOURCES.values():
            if name == resource.silver_table:
                return self.flat(resource.name)
        raise KeyError(name)

    def __iter__(self) -> Iterator[str]:
        yield from (*MASTER_TABLES, *CODE_LISTS, *(r.silver_table for r in RESOURCES.values()))

    def __len__(self) -> int:
        return len(MASTER_TABLES) + len(CODE_LISTS) + len(RESOURCES)
