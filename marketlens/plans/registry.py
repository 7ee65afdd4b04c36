"""Registered queries of the market-evidence operators, each with its oracle where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.sources.tables import oracle

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_MODULES = "indicators coverage relational reconcile lineage text documents decoding scalars streams".split()


def register(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with the oracle's SQL over the views."""

    def keep(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _ORACLES[f.__name__] = oracle(sql)
        return f

    return keep


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"marketlens.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
