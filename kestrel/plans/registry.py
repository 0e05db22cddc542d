"""Plan registry: a query callable plus its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    name: str
    fn: QueryFn
    sql: str | None  # None → no SQL form; checked by tests on fixtures
    ops: tuple[int, ...] = ()


REGISTRY: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None, ops: tuple[int, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate plan {name}")
        REGISTRY[name] = Plan(name, fn, sql, ops)
        return fn
    return deco
