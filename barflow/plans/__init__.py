"""Registered queries and their SQL twins."""

from barflow.plans import (  # noqa: F401
    q_assemble,
    q_clean,
    q_explore,
    q_metrics,
    q_prompts,
    q_retrieval,
    q_scoring,
    q_series,
    q_sources,
)
from barflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
