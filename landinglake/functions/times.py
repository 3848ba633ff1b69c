"""Time columns: lenient parsing, the four partition columns, audit time text."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landinglake.functions.quoting import quoted

# Names of the derived columns and the audit time format.
TIME_PARTS = ("year", "month", "day", "hour")
AUDIT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def parse_time(column: Column) -> Column:
    """Timestamp of a text, date, timestamp or number (epoch seconds); null where unreadable."""
    return F.try_to_timestamp(column)


def add_time_parts(df: DataFrame, column: str) -> DataFrame:
    """Append year, month, day and hour of a timestamp column."""
    moment = F.col(quoted(column))
    return df.withColumns(dict(zip(TIME_PARTS, (
        F.year(moment), F.month(moment), F.dayofmonth(moment), F.hour(moment)))))


def utc_text(moment: Column) -> Column:
    """Audit text of a timestamp, microseconds included."""
    return F.date_format(moment, AUDIT_TIME)


def utc_now_text() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
