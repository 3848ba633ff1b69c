"""Audit rows: step records, step-result cells, status folds."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.functions.times import utc_now_text

# Audit columns, step-result columns, states.
STEP_COLUMNS = ("entity string, step string, start_dt string, end_dt string, "
                "reject_records_cnt bigint, records_cnt bigint, description string, status string")
CELL_COLUMNS = ("entity", "step", "start_dt", "end_dt", "status", "description")
SUCCESS, FAILED = "Success", "Failed"


@dataclass
class Step:
    """One audit row in the making."""

    entity: str
    step: str
    start_dt: str
    end_dt: str | None = None
    reject_records_cnt: int | None = None
    records_cnt: int | None = None
    description: str | None = None
    status: str | None = None

    @classmethod
    def start(cls, entity: str, step: str) -> Step:
        return cls(entity, step, utc_now_text())

    def end(self, status: str = SUCCESS, description: str | None = None) -> Step:
        self.end_dt, self.status = utc_now_text(), status
        self.description = description or self.description
        return self


def step_frame(spark: SparkSession, steps: Iterable[Step], job_run_id: int | None = None
               ) -> DataFrame:
    """The few step records of one entity as rows."""
    rows = spark.createDataFrame([tuple(asdict(s).values()) for s in steps], STEP_COLUMNS)
    return rows.withColumn("jobs_execution_id", F.lit(job_run_id).cast("int"))


def union_steps(*frames: DataFrame) -> DataFrame:
    """Steps of several sub-steps in one set; columns a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def order_steps(df: DataFrame) -> DataFrame:
    """Steps by start; the other columns break ties, so that equal starts sort in many tasks."""
    return df.orderBy("start_dt", *[c for c in df.columns if c != "start_dt"])


def _outside_texts(word: str, not_in: str) -> str:
    """Pattern of ``word`` where it is not part of a quoted text; group 1 is what precedes it."""
    single, double = r"'(?:[^'\\]++|\\.)*+'", r'"(?:[^"\\]++|\\.)*+"'
    return rf"(?s)\G((?:[^'\"{not_in}]++|{single}|{double}|(?!{word})[{not_in}])*+){word}"


# What Python writes differently from JSON, as (mark, pattern, JSON).
PYTHON_MARKS = ((",", r",\s*\)", ")"), ("(", r"\(", "["), (")", r"\)", "]"), ("N", "None", "null"))


def step_list_text(cell: str | Column) -> Column:
    """A list of tuples, as procedures write it, as JSON text; JSON stays what it is."""
    text = F.col(cell) if isinstance(cell, str) else cell
    column = text
    for mark, pattern, replacement in PYTHON_MARKS:
        column = F.regexp_replace(column, _outside_texts(pattern, mark), "$1" + replacement)
    return F.when(text.contains("(") | text.contains("None"), column).otherwise(text)


def step_lists(cell: str | Column) -> Column:
    """The steps of a cell as arrays of texts; null if it cannot be read as a list of lists."""
    return F.from_json(step_list_text(cell), "array<array<string>>",
                       {"allowBackslashEscapingAnyCharacter": "true"})


def is_unreadable(cell: str | Column) -> Column:
    """Is the cell no list of six-element steps? A missing one is unreadable, an empty list is
    a list without steps."""
    steps = step_lists(cell)
    return steps.isNull() | F.exists(
        steps, lambda s: F.coalesce(F.size(s), F.lit(-1)) != len(CELL_COLUMNS))


def parse_step_cells(df: DataFrame, cell: str, *keep: str) -> DataFrame:
    """Rows of a step-result cell: text of a list of six-element lists or tuples.

    An empty or missing list gives no rows, and neither does an unreadable one; see
    :func:`is_unreadable`. Elements are read as text; nothing is evaluated.
    """
    steps = step_lists(cell)
    rows = df.select(*keep, F.explode(steps).alias("_step"))
    fields = [F.get("_step", F.lit(i)).alias(name) for i, name in enumerate(CELL_COLUMNS)]
    return rows.select(*keep, *fields)


def is_failed(status: str | Column = "status") -> Column:
    """Does the status text name a failure, whatever else it says?"""
    column = F.col(status) if isinstance(status, str) else status
    return F.coalesce(column.contains(FAILED), F.lit(False))


def any_failed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.bool_or(is_failed()).alias("any_failed"))


def fold_status(df: DataFrame, *keys: str, flag: str = "ok") -> DataFrame:
    """Status of a run: true if every entity succeeded; an unknown flag counts as failure."""
    known = F.coalesce(F.col(flag), F.lit(False))
    return df.groupBy(*keys).agg(F.coalesce(F.bool_and(known), F.lit(True)).alias(flag))
