"""Registered queries: one Spark callable and, where possible, one SQL text each."""

from parley.catalog import (answers, calls, enrichment, governance, questions, rollups, scalars, search,
                            sources, streams, summaries, turns)
from parley.catalog.base import REGISTRY

__all__ = ["REGISTRY", "answers", "calls", "enrichment", "governance", "questions", "rollups", "scalars",
           "search", "sources", "streams", "summaries", "turns"]
