"""All registered queries, grouped by workload."""

from fathomline.plans.catalog import (  # noqa: F401  (importing registers the queries)
    checks, counts, evaluation, filings, graph, groups, joins, learning, scalars, scans, series, similarity, streams,
)
from fathomline.plans.catalog.registry import QUERIES, REFERENCE_SQL

__all__ = ["QUERIES", "REFERENCE_SQL"]
