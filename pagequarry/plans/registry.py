"""Queries with their SQL twins.

A query is a function of ``Inputs``; its SQL is run by another engine on the same
tables. Fixtures are derived tables, written once in the SQL that both engines
read, so that operators get pages, lines, cells and evidence from the test tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {}
#: Keys by which rows are dealt out for work on whole orders, and about how many of them a task gets.
ORDER_KEYS = {"orders": ("o_orderkey", 100_000), "lineitem": ("l_orderkey", 400_000)}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def fixture(name: str, text: str, *needs: str) -> None:
    """Register a derived table; ``needs`` are other fixtures that its text reads."""
    FIXTURES[name] = (needs, text)


def _chain(names: tuple[str, ...], done: dict[str, str] | None = None) -> dict[str, str]:
    done = {} if done is None else done
    for n in names:
        needs, text = FIXTURES[n]
        _chain(needs, done)
        done.setdefault(n, text)
    return done


def with_fixtures(names: tuple[str, ...], text: str) -> str:
    """``text`` after the definitions of the fixtures; a leading comma continues them with more definitions."""
    parts = ", ".join(f"{n} AS ({t})" for n, t in _chain(names).items())
    if not parts:
        return f"WITH {text.lstrip().removeprefix(',')}" if text.lstrip().startswith(",") else text
    return f"WITH {parts}{text if text.lstrip().startswith(',') else ' ' + text}"


class Inputs:
    """Tables and fixtures of a folder as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, folder: str, dealt: bool = False):
        self.spark, self.folder, self.dealt = spark, folder, dealt

    @property
    def by_order(self) -> Inputs:
        """The same with orders and lineitem dealt out by order.

        What is made of an order is in one task then and need not be shuffled again to
        be grouped by it; there are more tasks for larger tables, not larger ones.
        """
        return Inputs(self.spark, self.folder, True)

    def n_parts(self, table: str) -> int:
        """Tasks that a table is dealt out to: by its rows, or one for each core if it is not small."""
        rows, least = getattr(Inputs(self.spark, self.folder), table).count(), ORDER_KEYS[table][1]
        return 1 + max(rows // least, min(10 * rows // least, self.spark.sparkContext.defaultParallelism - 1))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            return table.repartition(self.n_parts(name), ORDER_KEYS[name][0]) if self.dealt and name in ORDER_KEYS else table
        if name not in FIXTURES:
            raise AttributeError(name)
        text = with_fixtures((name,), f"SELECT * FROM {name}")
        for t in TABLES:
            if t in text:
                getattr(self, t).createOrReplaceTempView(t)
        return self.spark.sql(text)


def query(name: str, *fixtures: str, sql: str | None = None):
    """Register a function of ``Inputs`` as a query, with its SQL over the fixtures."""

    def add(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if sql:
            text = with_fixtures(fixtures, sql)
            SQL[name] = text.replace("WITH ", "WITH RECURSIVE ", 1) if "/*recursive*/" in text else text
        return build

    return add
