"""Registered queries and end-to-end plans."""

from . import q_flows, q_indicators, q_joins, q_quality, q_reserves, q_streaming, q_text, q_vintages  # noqa: F401
from .registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
