"""All registered queries."""

from corvane.plans import (  # noqa: F401
    decoding_queries, entry_queries, retrieval_queries, store_queries, stream_queries,
    text_queries,
)
from corvane.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
