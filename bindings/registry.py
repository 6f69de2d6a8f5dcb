"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from varloom.fixtures import ctes, load
from varloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """Loads a table or view of one data folder by name."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def sql(views: str, body: str, extra: str = "", recursive: bool = False) -> str:
    """Oracle text: the named views and further CTEs in front of ``body``."""
    parts = [p for p in (ctes(*views.split()), extra.strip().rstrip(",")) if p]
    head = f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" if parts else ""
    return head + body.strip()


def query(name: str, oracle: str | None = None):
    """Registers ``fn(tables) -> DataFrame``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap
