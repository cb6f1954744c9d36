"""Registered queries: a Spark job and, where SQL can express it, the text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.views import Tables, with_views


@dataclass(frozen=True)
class Check:
    covers: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


class Registry:
    def __init__(self) -> None:
        self.checks: dict[str, Check] = {}

    def add(self, name: str, covers: str, run: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        if name in self.checks:
            raise ValueError(f"query {name} is registered twice")
        self.checks[name] = Check(covers, run, sql)

    def queries(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def bind(run: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
            return lambda spark, sf_dir: run(Tables(spark, sf_dir))

        return {name: bind(check.run) for name, check in self.checks.items()}

    def oracle_sql(self) -> dict[str, str]:
        return {name: with_views(check.sql) for name, check in self.checks.items() if check.sql}
