"""Database and table names of one environment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

LAYERS = ("bronze", "silver", "gold")
STORE = "__store"
PUBLISHED = "published"


def database_of(table: str) -> str:
    return table.rpartition(".")[0]


def store_of(database: str) -> str:
    """The database of the data behind the views of ``database``."""
    return database if database.endswith(STORE) else f"{database}{STORE}"


@dataclass(frozen=True)
class Layout:
    """``Layout("__dev").table("gold", "audit_rule")`` is ``gold__dev.audit_rule``.

    ``root``: folder of the data; left out, they lie in the warehouse.
    """

    suffix: str
    root: str | None = None

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return f"{layer}{self.suffix}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def stored(self, layer: str, name: str) -> str:
        """A table that is no part of the layer: discovery and exports do not see it."""
        return f"{store_of(self.database(layer))}.{name}"

    def view(self, name: str) -> str:
        """A published table, in a database of its own of this environment."""
        return f"{PUBLISHED}{self.suffix}.{name}"

    def create(self, spark: SparkSession) -> None:
        for layer in LAYERS:
            for name in (self.database(layer), store_of(self.database(layer))):
                where = f" LOCATION '{self.root}/{name}'" if self.root else ""
                spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{PUBLISHED}{self.suffix}`")
