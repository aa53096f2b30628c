"""Registered queries: one per operator, over tables derived from the given ones by Spark."""

from workload.registered import ORACLES, QUERIES

from workload import (  # noqa: E402,F401  each module registers its queries
    aggregations, delegated, filters, joins, maintenance, ordering, projections, quality,
    scalars, scans, schemas, sinks, windows,
)

__all__ = ["ORACLES", "QUERIES"]
