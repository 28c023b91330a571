"""Scans and sinks: driver tables, the listing fixture, the calendar and snapshot tables."""

from listingflow.sources.calendar import date_range, dim_date
from listingflow.sources.context import table_context
from listingflow.sources.fixtures import raw_listings
from listingflow.sources.tables import (TableStore, control_row, last_mark, max_mark,
                                        newer_than, read_table)

__all__ = [
    "date_range", "dim_date", "table_context", "raw_listings", "TableStore", "control_row",
    "last_mark", "max_mark", "newer_than", "read_table",
]
