"""Column profile, malformed records, blank rows and empty columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landinglake.functions.quoting import literal, quoted
from landinglake.sources.landing import CORRUPT_RECORD, SOURCE_FILE


def column_profile(df: DataFrame) -> DataFrame:
    """Non-null count of every column, of whatever type: (column_name, non_null_cnt).

    One pass; each task sends a single row of counts.
    """
    counts = df.selectExpr(*[f"count({quoted(c)}) as c{i}" for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"{literal(c)}, c{i}" for i, c in enumerate(df.columns))
    return counts.selectExpr(
        f"stack({len(df.columns)}, {pairs}) as (column_name, non_null_cnt)")


def profile_metric(columns: Iterable[str]) -> Column:
    """The same counts as a metric that rides along with a write: an array, in column order."""
    return F.expr(f"array({', '.join(f'count({quoted(c)})' for c in columns)})")


def null_columns(profile: Mapping[str, int]) -> list[str]:
    return [name for name, count in profile.items() if count == 0]


def drop_null_columns(df: DataFrame, profile: Mapping[str, int] | None = None) -> DataFrame:
    """Drop the columns that hold no value; without a profile one is taken first."""
    if profile is None:
        profile = {row.column_name: row.non_null_cnt for row in column_profile(df).collect()}
    return df.drop(*null_columns(profile))


def has_payload(payload: Iterable[str]) -> Column:
    """Is any of the payload columns set? Lineage and run columns always are."""
    tests = "".join(f"case when {quoted(c)} is not null then true end, " for c in payload)
    return F.expr(f"coalesce({tests}false)")


def drop_blank_rows(df: DataFrame, payload: Iterable[str]) -> DataFrame:
    return df.na.drop("all", subset=list(payload))


def accepted_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT_RECORD).isNull()).drop(CORRUPT_RECORD)


def rejected_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Malformed records, verbatim."""
    return df.filter(F.col(CORRUPT_RECORD).isNotNull()).select(CORRUPT_RECORD, *keep)


def reject_summary(df: DataFrame, *keys: str) -> DataFrame:
    """Records, rejects, and whether there is nothing but rejects; per key if any is given.

    Also right on the rows of a landing folder: the reader does not parse for the corrupt
    column alone, so the count looks at a payload column too.
    """
    payload = [c for c in df.columns if c not in (CORRUPT_RECORD, SOURCE_FILE, *keys)]
    corrupt = F.col(CORRUPT_RECORD)
    other = F.col(quoted(payload[0])).cast("string") if payload else corrupt
    rows = F.count(F.lit(1))
    rejects = F.count_if(corrupt.isNotNull() & F.coalesce(corrupt, other).isNotNull())
    return df.groupBy(*keys).agg(
        rows.alias("records_cnt"), rejects.alias("reject_records_cnt"),
        ((rows > 0) & (rows == rejects)).alias("all_rejected"))
