"""One registry feeds `queries()` and `oracle_sql()`."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.tables import Tables

_JOBS: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def job(name: str, oracle: str | None = None):
    """Register a function `Tables -> DataFrame` under `name`, with the SQL that checks it."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _JOBS:
            raise ValueError(f"{name} is registered twice")
        _JOBS[name] = fn
        if oracle is not None:
            _ORACLES[name] = textwrap.dedent(oracle).strip()
        return fn

    return register


def _runner(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import tidewater.plans  # noqa: F401  (importing it fills the registry)

    return {name: _runner(fn) for name, fn in _JOBS.items()}


def oracle_sql() -> dict[str, str]:
    import tidewater.plans  # noqa: F401

    return dict(_ORACLES)
