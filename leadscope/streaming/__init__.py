"""Structured Streaming form of the daily activity ingest (each file converted exactly once)."""

from leadscope.streaming.ingest import IngestStream, start_activity_ingest

__all__ = ["IngestStream", "start_activity_ingest"]
