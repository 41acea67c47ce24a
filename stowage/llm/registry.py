"""Queries over the operators of this part, with their SQL checks."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_settings

FAMILIES = ("corpus_queries",)


def load() -> tuple[dict[str, Callable], dict[str, str]]:
    built, checks = {}, {}
    for family in FAMILIES:
        module = import_module(f"{__package__}.{family}")
        built |= module.QUERIES
        checks |= module.CHECKS
    return built, checks


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def with_settings(build):
        return lambda spark, sf_dir: build(apply_settings(spark), sf_dir)

    return {name: with_settings(build) for name, build in load()[0].items()}


def checks() -> dict[str, str]:
    return load()[1]
