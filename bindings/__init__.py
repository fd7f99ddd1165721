"""Registered queries: the operators of ``riskloom`` bound to the supplied tables.

Each query runs over whole tables and, where SQL can express it, carries the
equivalent SQL text next to it.
"""

from bindings import (  # noqa: F401  (importing registers the queries)
    aggregates,
    answering,
    drifting,
    fitting,
    learning,
    measuring,
    projections,
    rolling,
    streams,
    validating,
    verified,
)
from bindings.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
