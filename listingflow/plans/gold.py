"""Gold step: a silver batch -> SCD2 developers, SCD1 locations, insert-only profiles and the
fact rows of the batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.functions.keys import ts_literal
from listingflow.operators.dims import (developer_batch, location_batch, merge_location,
                                        merge_profile, merge_scd2, profile_batch)
from listingflow.operators.facts import fact_listings
from listingflow.session import stage


@dataclass
class GoldState:
    developers: DataFrame
    locations: DataFrame
    profiles: DataFrame
    fact_delta: DataFrame


def gold_transform(silver: DataFrame, run_ts, developers: DataFrame | None = None,
                   locations: DataFrame | None = None, profiles: DataFrame | None = None,
                   stage_dims: bool = True) -> GoldState:
    """New dimension states and the batch's fact rows (to be upserted into the fact table).

    With ``stage_dims`` the new developer and location states are written before the fact is
    built (as publishing them would), so the fact's joins are planned on their real sizes:
    broadcast when small, sort-merge with AQE skew splitting otherwise.
    """
    ts = ts_literal(run_ts)
    devs = merge_scd2(developers, developer_batch(silver), ts)
    locs = merge_location(locations, location_batch(silver))
    if stage_dims:
        devs, locs = stage(devs, "dim-developer"), stage(locs, "dim-location")
    profs = merge_profile(profiles, profile_batch(silver))
    return GoldState(devs, locs, profs, fact_listings(silver, devs, locs, ts))
