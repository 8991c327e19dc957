"""Name -> query callable, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ratewave.plans.batch import BATCH_QUERIES
from ratewave.plans.oracle import ORACLE_SQL
from ratewave.plans.model import MODEL_QUERIES
from ratewave.plans.stream import STREAM_QUERIES
from ratewave.session import utc_session

QueryFn = Callable[[SparkSession, str], DataFrame]


def _in_utc(fn: QueryFn) -> QueryFn:
    """Event times are UTC; the caller's session keeps its own time zone."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(utc_session(spark), sf_dir)

    return run


def all_queries() -> dict[str, QueryFn]:
    return {name: _in_utc(fn) for name, fn in (BATCH_QUERIES | STREAM_QUERIES | MODEL_QUERIES).items()}


def all_oracles() -> dict[str, str]:
    names = all_queries()
    return {k: v for k, v in ORACLE_SQL.items() if k in names}
