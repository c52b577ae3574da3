"""Registered queries: a Spark plan over the benchmark tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedweir.session import configure

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    operators: tuple[str, ...]
    plan: Plan
    sql: str | None
    module: str


_QUERIES: dict[str, Query] = {}


def query(name: str, *operators: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under a name, with the ids of the operators it shows."""
    if name in _QUERIES:
        raise ValueError(f"query {name} is registered twice")

    def keep(plan: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(configure(spark), sf_dir)

        _QUERIES[name] = Query(name, operators, run, sql, plan.__module__.rsplit(".", 1)[-1])
        return plan

    return keep


def all_queries() -> dict[str, Query]:
    """Every registered query; importing the plan modules registers them."""
    from feedweir.plans import changes, domains, files, loads, reports, shapes, slices, streams  # noqa: F401

    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the benchmark tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
