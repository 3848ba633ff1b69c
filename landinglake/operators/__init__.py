"""Operators over DataFrames: quality, partitions, tables, sinks, audit, job metadata."""
