"""``DataFrame -> DataFrame`` operators of the listing lakehouse.

The most used ones are re-exported here; each module documents its family."""

from listingflow.operators.asklog import audit_queries, chat_context, parse_routes
from listingflow.operators.dims import (developer_batch, location_batch, merge_location,
                                        merge_profile, merge_scd2, profile_batch,
                                        scd2_from_history)
from listingflow.operators.facts import current_rows, fact_listings, lookup, lookup_as_of
from listingflow.operators.features import (flexibility_score, group_means, impute_down_payment,
                                            impute_mean, payment_type, ready_to_move)
from listingflow.operators.merge import dedup_latest, insert_new, latest_per_key, upsert
from listingflow.operators.quality import flag_invalid, quality_summary, split_valid

__all__ = [
    "audit_queries", "chat_context", "parse_routes", "developer_batch", "location_batch",
    "merge_location", "merge_profile", "merge_scd2", "profile_batch", "scd2_from_history",
    "current_rows", "fact_listings", "lookup", "lookup_as_of", "flexibility_score",
    "group_means", "impute_down_payment", "impute_mean", "payment_type", "ready_to_move",
    "dedup_latest", "insert_new", "latest_per_key", "upsert", "flag_invalid", "quality_summary",
    "split_valid",
]
