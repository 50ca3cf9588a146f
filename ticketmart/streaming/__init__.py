"""Incremental runs of the ingest jobs over landing folders."""
