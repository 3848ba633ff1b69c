"""Relational and warehouse scans over JDBC; the driver jar comes with the cluster."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Rows per round trip; the drivers' own defaults (often 10) starve a scan.
FETCH_SIZE = "10000"


def read_query(spark: SparkSession, url: str, sql: str,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a query the database runs, read through one connection.

    Meant for metadata queries with small results; use :func:`read_table` for bulk.
    """
    return (spark.read.format("jdbc").option("url", url).option("query", sql)
            .option("fetchsize", FETCH_SIZE).options(**(options or {})).load())


def read_table(spark: SparkSession, url: str, table: str,
               split_column: str | None = None, lower: str | int | None = None,
               upper: str | int | None = None, splits: int | None = None,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """A whole table; filters and columns are pushed to the database.

    With ``split_column`` and its bounds the table is read over ``splits`` connections. The
    bounds only place the cuts, rows outside them are read as well.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", FETCH_SIZE))
    split = (split_column, lower, upper, splits)
    if any(value is not None for value in split):
        if any(value is None for value in split):
            raise ValueError("split_column, lower, upper and splits go together")
        reader = reader.options(partitionColumn=split_column, lowerBound=str(lower),
                                upperBound=str(upper), numPartitions=str(splits))
    return reader.options(**(options or {})).load()
