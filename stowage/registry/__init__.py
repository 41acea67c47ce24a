"""Registered queries: one Spark callable and, where SQL can say it, one check each."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..sources.testtables import Catalogue, check_sql

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_CHECKS: dict[str, str] = {}

FAMILIES = (
    "sources",
    "invalidation",
    "reconcile",
    "capacity",
    "placement",
    "requests",
    "functions",
    "containers",
    "traces",
)


def registered(name: str, sql: str | None = None):
    """Register ``f(catalogue) -> DataFrame`` under ``name``."""

    def wrap(build: Callable[[Catalogue], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} registered twice")
        _QUERIES[name] = lambda spark, sf_dir: build(Catalogue(spark, sf_dir))
        if sql is not None:
            _CHECKS[name] = check_sql(sql)
        return build

    return wrap


def load() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(_QUERIES)


def checks() -> dict[str, str]:
    load()
    return dict(_CHECKS)
