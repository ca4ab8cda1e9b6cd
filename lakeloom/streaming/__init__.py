"""Structured Streaming: incremental silver loads and incrementally maintained gold totals."""

from lakeloom.streaming.incremental import stream_silver, stream_view_totals

__all__ = ["stream_silver", "stream_view_totals"]
