"""Structured Streaming entry points."""

from lagjoin.streaming.enrich import enrich_available, enrich_stream, start_enrichment

__all__ = ["enrich_available", "enrich_stream", "start_enrichment"]
