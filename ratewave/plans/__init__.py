"""Registered queries (``queries()``) and their SQL oracles (``oracle_sql()``)."""

from ratewave.plans.registry import all_oracles, all_queries

__all__ = ["all_queries", "all_oracles"]
