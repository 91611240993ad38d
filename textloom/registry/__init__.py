"""Named queries over the given tables, each with its SQL where SQL can express it."""

from textloom.registry import (  # noqa: F401
    clustering_queries,
    index_queries,
    ranking_queries,
    significance_queries,
    source_queries,
    statistics_queries,
    text_queries,
)
from textloom.registry.base import ORACLES, QUERIES  # noqa: F401
