"""Registered queries, one module per operator family; importing the package registers them
(in pipeline order: cleaning, silver, gold, question side)."""

from listingflow.plans.queries import cleaning  # noqa: F401  (registration order matters)
from listingflow.plans.queries import silver  # noqa: F401
from listingflow.plans.queries import gold  # noqa: F401
from listingflow.plans.queries import asklog  # noqa: F401
from listingflow.plans.queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
