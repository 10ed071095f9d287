"""The operators run over the driver tables, each beside its SQL twin."""

from starfold.queries.registry import QUERIES, SQL
from starfold.queries import (  # noqa: F401  (registration)
    cleaning, dimensions, doors, facts, keys, merges, projections, upkeep,
)

__all__ = ["QUERIES", "SQL"]
