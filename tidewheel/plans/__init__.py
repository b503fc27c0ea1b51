"""Ready-made queries over the standard tables, each with an equivalent SQL text where one exists."""

from tidewheel.plans.registry import ORACLES, QUERIES, Tables

from tidewheel.plans import (  # noqa: F401  (importing registers the queries)
    reports,
    scalars,
    joins,
    aggregates,
    windows,
    sets,
    files,
    loads,
    checks,
    layouts,
    streams,
)

__all__ = ["ORACLES", "QUERIES", "Tables"]
