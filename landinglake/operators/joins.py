"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "_key_hash"


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` in a way that lets AQE split a hot key.

    AQE splits a skewed partition only where both sides of a sort-merge join come straight
    from a shuffle. A side that is an aggregate or a join on the same key does not: its
    partitioning is reused. The hash of the key as a second key gives both sides a shuffle of
    their own; for the price of shuffling the smaller, already reduced side once more.
    """
    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn(_SPREAD, F.xxhash64(key))

    return hashed(left).join(hashed(right), [key, _SPREAD], how).drop(_SPREAD)
