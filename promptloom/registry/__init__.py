"""The registered queries: each runs an operator over whole tables and, where SQL can say it, has an oracle."""

from promptloom.registry.base import ORACLES, QUERIES
from promptloom.registry import aggregates, experiments, models, prompts, reshaping, retrieval, storage, streams  # noqa: F401  (register queries)

__all__ = ["ORACLES", "QUERIES"]
