"""All queries; importing the modules registers them."""

from hourloom.plans import (  # noqa: F401
    file_queries,
    learning_queries,
    relation_queries,
    scalar_queries,
    series_queries,
)
from hourloom.plans.registry import ORACLES, QUERIES  # noqa: F401
