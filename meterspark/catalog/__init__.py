"""Every operator as a query over the synthetic tables, next to the SQL it must agree with."""

from meterspark.catalog import (  # noqa: F401
    chunks, graph, legacy, modes, plans, readings, routing, sources, streams, supplies)
from meterspark.catalog.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
