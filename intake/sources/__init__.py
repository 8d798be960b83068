"""Scans and sinks: landing files, staged batches, serving tables."""
