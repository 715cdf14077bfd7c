"""A named query and, where SQL can say it, its twin for the comparison engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    runs: dict[str, Run] = field(default_factory=dict)
    twins: dict[str, str] = field(default_factory=dict)

    def query(self, sql: str | None = None, name: str | None = None):
        def add(run: Run) -> Run:
            key = name or run.__name__
            if key in self.runs:
                raise ValueError(f"query {key} is registered twice")
            self.runs[key] = run
            if sql is not None:
                self.twins[key] = sql
            return run

        return add


REGISTRY = Registry()
query = REGISTRY.query
