"""Whole dataflows: publish a table, ingest entities, refresh layers."""
