"""The registry, and the tables a query sees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


#: rows of one task that sorts them: some hundred MB, however large a table is
ROWS = 500_000


class Tables:
    """The Parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    @property
    def tasks(self) -> int:
        """The session's number of shuffle partitions."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def tasks_for(self, df: DataFrame) -> int:
        """The number of shuffle partitions, or as many as hold ``ROWS`` rows of a given table each, if that is more.

        Files know their numbers of rows, so no column is read to count them.
        """
        return max(self.tasks, -(-df.count() // ROWS))

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    """Registers ``fn(tables)`` as a query, with its SQL when there is one."""
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = lambda spark, root: fn(Tables(spark, root))
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return register
