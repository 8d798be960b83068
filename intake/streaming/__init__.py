"""Streams over a landing folder."""

from intake.streaming.landing import ingest_stream, log_refusals

__all__ = ["ingest_stream", "log_refusals"]
