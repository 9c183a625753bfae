"""All registered queries of the register operators and their SQL."""

from __future__ import annotations

from terraloom.plans import geo_queries, geometry_queries, incremental_queries, landed_queries, livestock_queries, overlay_queries, register_queries, release_queries, source_queries

_PARTS = (register_queries, geometry_queries, source_queries, incremental_queries, landed_queries, livestock_queries, overlay_queries, release_queries, geo_queries)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLES = {k: v for part in _PARTS for k, v in part.ORACLES.items()}
