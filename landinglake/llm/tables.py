"""Intermediate tables in the shared scratch folder, and counts that size partitions."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landinglake.storage import fresh_folder


# Ids of 8 bytes that a join may send to every task.
BROADCAST_IDS = 500_000
# Files of a table whose names may pass through the driver and to every task.
BROADCAST_FILES = 20_000


# Bytes of an Arrow batch on its way to a Python worker; a longer row is a batch by itself.
BATCH_BYTES = "4m"
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives executors."""
    folder = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts together."""
    return docs.agg(F.sum(F.octet_length(column).cast("bigint"))).first()[0] or 0


def parts_for(amount: float, per_part: float) -> int:
    return max(1, int(-(-amount // per_part)))


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or the like, that no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sample_each(rows: DataFrame, by: str, most: int, *draw: str) -> DataFrame:
    """At most ``most`` rows per value of ``by``, first in the order of a hash of the columns
    ``draw``, with their ``place`` in that order."""
    mark = F.pmod(F.xxhash64(*draw), F.lit(1_000_003))
    # About twice as many as wanted pass on, so the window sees a bounded number per value. The
    # counts, one per value, go to the tasks if there are few, so that all other rows stay put.
    counts = stored(rows.groupBy(by).agg(F.count(F.lit(1)).alias("_rows")), "counts")
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_IDS else counts
    share = F.least(F.lit(1.0), (2.0 * most + 100) / F.col("_rows"))
    few = rows.join(counts, by).filter(mark < share * 1_000_003).drop("_rows")
    order = Window.partitionBy(by).orderBy(mark, *draw)
    return few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def sample_texts(rows: DataFrame, by: str, text: str, most: int) -> DataFrame:
    """At most ``most`` different texts per value of ``by``, with their ``place`` in the order of a
    hash of both: copies of a text are one text, and every value that has a text is drawn from.

    What passes the first filter is sized by the number of different texts, which is estimated
    within tasks and adds up; no text is shuffled before that, and copies meet as one row a task.
    """
    mark = F.xxhash64(by, text)
    marked = rows.select(by, text, mark.alias("mark"))
    counts = stored(marked.groupBy(by).agg(F.approx_count_distinct("mark", 0.02).alias("texts")),
                    "texts")
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_IDS else counts
    # Twice as many as wanted and some more, so that a few too low an estimate costs nothing.
    share = F.least(F.lit(1.0), (2.0 * most + 100) / F.col("texts"))
    few = marked.join(counts, by).filter(F.pmod("mark", F.lit(1_000_003)) < share * 1_000_003)
    few = few.groupBy(by, "mark").agg(F.min(text).alias(text))
    order = Window.partitionBy(by).orderBy(F.pmod("mark", F.lit(1_000_003)), "mark")
    return few.withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= most).select(by, text, "place")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number per row, the same whenever the frame is read: the place in its file
    for a Parquet table, which is not copied; any other frame is stored first. A table of more than
    ``BROADCAST_FILES`` files is stored with numbers that its writing tasks give."""
    meta = docs.metadataColumn("_metadata") if _is_parquet(docs) else None
    if meta is None:
        docs = stored(docs, "numbered")
        meta = docs.metadataColumn("_metadata")
    path, start = free_name(docs, "file_path"), free_name(docs, "file_start")
    named = docs.select(meta["file_path"].alias(path)).distinct()
    paths = sorted(r[0] for r in named.limit(BROADCAST_FILES + 1).collect())
    if len(paths) > BROADCAST_FILES:
        return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    # 2**40 rows a file. From Arrow, as a list of rows would start Python workers of another kind on
    # every executor, which stay.
    files = F.broadcast(docs.sparkSession.createDataFrame(pa.table(
        {path: pa.array(paths, pa.string()),
         start: pa.array([i << 40 for i in range(len(paths))], pa.int64())})))
    placed = docs.select("*", meta["file_path"].alias(path), meta["row_index"].alias(name))
    return placed.join(files, path).select(
        *(F.col(f"`{c}`") for c in docs.columns), (F.col(start) + F.col(name)).alias(name))


def _is_parquet(docs: DataFrame) -> bool:
    """Whether a frame is a Parquet table as read, so that a row is a place in a file."""
    plan = docs._jdf.queryExecution().analyzed()
    return plan.nodeName() == "LogicalRelation" and plan.toString().rstrip().endswith("parquet")


def without(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in ``ids`` (one column); rows without one stay.

    The ids are counted first: up to ``BROADCAST_IDS`` of them go to the tasks, so that texts need
    no shuffle; more are joined by a shuffle.
    """
    name = free_name(docs, "dropped")
    listed = stored(ids.toDF(name).filter(F.col(name).isNotNull()).distinct(), "ids")
    few = listed.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(listed) if few else listed, F.col(key) == F.col(name),
                     "left_anti")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def trimmed(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` of a Python worker, which afterwards gives what it has freed back to the system. A
    worker lives on after its task, beside those of other tasks and the heap of its executor."""
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        give_back()

    return run


def give_back() -> None:
    """Return what this process has freed to the system."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the usual C library only
    if trim:
        trim(0)


def show_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if they have nothing
    else on their path; a cluster that ships the package with the job is not affected. Arrow
    batches, which hold 10,000 rows whatever their texts, are bounded in bytes, unless the session
    has a bound of its own."""
    if spark.conf.get(_BATCH_SETTING, None) in (None, _BATCH_DEFAULT):
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    paths = [str(Path(__file__).resolve().parents[2])]
    environment = spark.sparkContext.environment
    if paths[0] not in (known := environment.get("PYTHONPATH", "").split(os.pathsep)):
        environment["PYTHONPATH"] = os.pathsep.join([p for p in known if p] + paths)
