"""Bounded stream ingest (drain new files, stop) with a growing schema."""

from listingflow.streaming.ingest import evolved_schema, ingest_stream, stamp_ingest

__all__ = ["evolved_schema", "ingest_stream", "stamp_ingest"]
