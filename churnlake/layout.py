"""Where the datasets of one lakehouse live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Layout:
    """Paths below one root on shared storage.

    Silver and gold tables are published in sets. Their paths are those of the
    current set, and as long as none is published the plain place.
    """

    root: str

    def bronze(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def silver_set(self, source: str) -> str:
        """The folder in which the tables of one source are published."""
        return f"{self.root}/silver/_published/{source}"

    @property
    def gold_set(self) -> str:
        return f"{self.root}/gold/_published"

    @property
    def rollup_set(self) -> str:
        return f"{self.root}/gold/_rollup"

    @property
    def score_set(self) -> str:
        return f"{self.root}/scores/_published"

    def silver(self, source: str) -> str:
        return _published(self.silver_set(source), "clean") or f"{self.root}/silver/{source}"

    def rejected(self, source: str) -> str:
        plain = f"{self.root}/silver/_rejected/{source}"
        return _published(self.silver_set(source), "rejected") or plain

    @property
    def customer_ids(self) -> str:
        plain = f"{self.root}/silver/_reference/customer_ids"
        return _published(self.silver_set("customers"), "customer_ids") or plain

    def gold(self, table: str) -> str:
        return _published(self.gold_set, table) or f"{self.root}/gold/{table}"

    @property
    def model_set(self) -> str:
        """The folder in which the nodes of the model are published."""
        return f"{self.root}/models/_published"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"


def _published(folder: str, table: str) -> str | None:
    from churnlake.publish import current

    spark = SparkSession.getActiveSession()
    commit = current(spark, folder) if spark is not None else None
    return commit.tables[table] if commit is not None else None
