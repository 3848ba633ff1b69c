"""Structured Streaming jobs."""

from landinglake.streaming.incremental import ingest_new_all, ingest_new_files

__all__ = ["ingest_new_all", "ingest_new_files"]
