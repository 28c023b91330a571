"""Registered queries: one Spark job per operator family, each with its DuckDB oracle.

Every query reads the driver tables (through ``raw_listings`` or directly), over whole tables,
so its work grows with the data. Names are what ``__spark_entry__.queries()`` exposes; the
queries themselves live in ``listingflow.plans.queries`` (one module per operator family).
"""

from listingflow.plans.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
