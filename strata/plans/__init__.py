"""Named queries over the driver tables, with their DuckDB oracles."""

from strata.plans import (  # noqa: F401  (importing registers the queries)
    keyed_queries,
    mart_queries,
    parse_queries,
    reconcile_queries,
    silver_queries,
    stream_queries,
)
from strata.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
