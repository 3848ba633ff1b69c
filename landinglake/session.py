"""Session builder with the settings the jobs were designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does the physical tuning: it coalesces small shuffle partitions, splits skewed join
# and rebalance partitions, and turns a join into a broadcast one only after it has seen
# the real size of the side.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.sql.files.ignoreMissingFiles": "false",
}


def build_session(app_name: str = "landinglake", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session; ``conf`` wins over the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
