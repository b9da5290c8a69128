"""Operators of a training-data pipeline, and their registered queries."""

from __future__ import annotations

from hebdo.llm.queries import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
