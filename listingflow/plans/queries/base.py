"""Shared pieces of the registered queries: the registry itself and the silver inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.operators.quality import split_valid
from listingflow.plans import oracle as O
from listingflow.plans.silver import silver_transform
from listingflow.sources.fixtures import listing_versions

AS_OF = O.AS_OF

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return wrap


def _round(c: str, places: int):
    return F.round(F.col(c).cast("double"), places).alias(c)


def silver_flagged(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    if raw is not None:
        return silver_transform(raw, AS_OF)
    versions, shape = listing_versions(spark, sf_dir)
    return silver_transform(versions, AS_OF, shape=shape, narrow=True)


def silver_good(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Good silver rows. The cleaned batch and its group means are already written inside
    ``silver_transform``, so readers (even several, as in the gold queries) recompute only the
    broadcast joins and expressions on top of them; measured faster than writing a copy."""
    good, _ = split_valid(silver_flagged(spark, sf_dir, raw))
    return good
