"""All registered queries."""

from __future__ import annotations

from corvane.plans import (  # noqa: F401
    file_queries,
    graph_queries,
    model_queries,
    privacy_queries,
    score_queries,
    text_queries,
)
from corvane.plans.registry import ORACLES, QUERIES, Query


def flagship(spark, folder):
    """The classes of the smallest data set are small, hence the mild thresholds."""
    return privacy_queries.release_summary(spark, folder, k=2, l=2, t=1.0)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
