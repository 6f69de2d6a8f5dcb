"""Queries that bind every operator to the driver's tables, each with its SQL oracle."""

from bindings import annotation, cohort, counts, filters, keyed, learning, labels, ranges, scalars, sources, stats, trios  # noqa: F401
from bindings.registry import ORACLES, QUERIES  # noqa: F401
