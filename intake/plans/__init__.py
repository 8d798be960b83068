"""Whole runs: load, ingest, backup, restore, audit."""
