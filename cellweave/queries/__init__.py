"""Registered queries with their SQL twins."""

from cellweave.queries import (  # noqa: F401
    cells,
    census_queries,
    composites,
    product_queries,
    registry_queries,
    source_queries,
    spatial_queries,
    tables,
    transit_queries,
    whole_products,
)
from cellweave.queries.catalog import ORACLES, QUERIES  # noqa: F401
