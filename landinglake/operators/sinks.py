"""Where rows go: partitioned files, rejects, lake tables, databases, bulk loads."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.errors import SnapshotTaken
from landinglake.functions.quoting import quoted
from landinglake.operators.quality import rejected_rows
from landinglake.operators.tables import RUN_ID
from landinglake.sources.lake import snapshots
from landinglake.storage import Storage, fresh_folder, join_path

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

log = logging.getLogger(__name__)

# Times a change of a snapshot table is tried while others write.
SNAPSHOT_ATTEMPTS = 20

# Rows per JDBC batch.
BATCH_SIZE = "10000"

# Text form that gives back what went in: quotes doubled, null as a bare \N; a text that
# begins with a backslash gets another one, so that none reads as null.
CSV_EXCHANGE = {"quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\\N",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def load_prefix(load_id: str) -> str:
    """Start of the name of every file of a load."""
    if not re.fullmatch(r"[A-Za-z0-9-]+", load_id):
        raise ValueError(f"not a load id: {load_id!r}")
    return f"load-{load_id}_"


def spread(df: DataFrame, partition_cols: Iterable[str] | None) -> DataFrame:
    """Bring the rows of a partition together, so that it gets few files.

    A rebalance, not a plain hash shuffle: AQE merges small partitions and splits a large
    one over several tasks, so one hot partition value does not become one task.
    """
    columns = list(partition_cols or [])
    return df.hint("rebalance", *map(quoted, columns)) if columns else df


def write_files(df: DataFrame, path: str, file_format: str | None = None,
                partition_cols: list[str] | None = None, compression: str | None = None,
                mode: str | None = None, options: Mapping[str, str] | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write files, Parquet and overwrite unless told otherwise.

    ``mode="dynamic"`` replaces only the partitions that occur in ``df``. ``finish`` is
    applied between the shuffle and the files.
    """
    df = spread(df, partition_cols)
    if finish:
        df = finish(df)
    writer = df.write.format(file_format or "parquet")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if compression:
        writer = writer.option("compression", compression)
    if mode == "dynamic":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    elif mode in (None, "overwrite"):
        # Whatever the session default is, a plain overwrite replaces everything.
        writer, mode = writer.option("partitionOverwriteMode", "static"), "overwrite"
    writer.mode(mode).options(**(options or {})).save(path)


def write_rejects(df: DataFrame, path: str, run_id: int, load_id: str | None = None) -> None:
    """Append the malformed records as JSON, with the run that met them.

    A load that is repeated under its id replaces the rejects of its first try.
    """
    # Rejects are few and come from all tasks: brought together, they make few files.
    writer = (rejected_rows(df).withColumn(RUN_ID, F.lit(run_id)).hint("rebalance")
              .write.mode("append"))
    if load_id:
        remove_rejects(df.sparkSession, path, load_id)
        writer = writer.option("mapreduce.output.basename", load_prefix(load_id))
    writer.json(path)


def remove_rejects(spark: SparkSession, path: str, load_id: str) -> int:
    """Delete the reject files of one load."""
    storage = Storage(spark, path)
    return storage.delete_all(storage.glob(path, load_prefix(load_id) + "*"))


def append_files(df: DataFrame, path: str) -> None:
    """Append a few rows to a record table that many jobs write to at the same time.

    Each append has a folder of its own: file commits that share one folder clear away each
    other's unfinished files. :func:`landinglake.sources.lake.read_appended` reads them.
    """
    df.coalesce(1).write.parquet(join_path(path, f"append={uuid.uuid4().hex}"))


def write_snapshot(df: DataFrame, path: str, base: int | None = None) -> int:
    """Rewrite a small unpartitioned table as its next version.

    ``df`` may read the current version: it stays, and a reader goes on with it, until the
    new one is complete. ``base`` is the version that ``df`` was made from (the newest, unless
    told): if another writer has made its successor meanwhile, SnapshotTaken is raised and
    nothing changes. Rows go to a folder of their own; a file that only one writer can
    create then decides who may rename it to the next version. It names the folder, so that the
    next writer can finish for one that died in between.
    """
    spark = df.sparkSession
    storage = Storage(spark, path)
    if base is None:
        base = (snapshots(spark, path) or [0])[-1]
    claim, target = join_path(path, f"_claim={base + 1}"), join_path(path, f"version={base + 1}")
    staged = join_path(path, f"_staged={uuid.uuid4().hex}")
    (df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(staged))
    if not storage.create_exclusive(claim, staged):
        storage.delete(staged)
        other = storage.read_text(claim)
        if not storage.exists(target) and other and storage.exists(other):
            try:
                storage.rename(other, target)
            except OSError:
                log.info("version %s was finished by its own writer", base + 1)
        raise SnapshotTaken(f"{path}: version {base + 1} has been written meanwhile")
    if not storage.exists(target):  # else another writer has finished for this one
        storage.rename(staged, target)
    # The version before stays for readers that have started; older ones go, their claims stay.
    storage.delete_all(join_path(path, f"version={v}") for v in snapshots(spark, path) if v < base)
    return base + 1


def update_snapshot(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame],
                    attempts: int = SNAPSHOT_ATTEMPTS) -> int:
    """Apply ``change`` to the newest version and write the next; if another writer is faster,
    apply it again to what that one has written, so that no change is lost."""
    for attempt in range(attempts):
        versions = snapshots(spark, path)
        if not versions:
            raise FileNotFoundError(f"no complete snapshot in {path}")
        rows = spark.read.parquet(join_path(path, f"version={versions[-1]}"))
        try:
            return write_snapshot(change(rows), path, versions[-1])
        except SnapshotTaken:
            log.info("%s: version %s was taken, attempt %s", path, versions[-1] + 1, attempt + 1)
    raise SnapshotTaken(f"{path}: no success in {attempts} attempts")


def append_database(df: DataFrame, url: str, table: str,
                    options: Mapping[str, str] | None = None) -> None:
    """Append rows over JDBC in batches, one connection per task.

    A task writes in one transaction, so a lost executor leaves no half-written task; bound
    the connections with ``numPartitions`` in ``options``.
    """
    (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
     .option("batchsize", BATCH_SIZE).options(**(options or {})).save())


def load_database(df: DataFrame, url: str, table: str, *, truncate: bool = False,
                  create: bool = False, insert: bool = True,
                  options: Mapping[str, str] | None = None) -> None:
    """:func:`bulk_load` for a database table, with the same flags.

    ``create`` replaces the table, ``truncate`` empties it but keeps its definition.
    """
    if not (create or truncate or insert):
        return
    rows = df if truncate or insert else df.limit(0)
    writer = rows.write.format("jdbc").mode("overwrite" if create or truncate else "append")
    if truncate and not create:
        writer = writer.option("truncate", "true")
    (writer.option("url", url).option("dbtable", table).option("batchsize", BATCH_SIZE)
     .options(**(options or {})).save())


def create_empty(df: DataFrame, table: str, path: str | None = None) -> None:
    """(Re)create a table that has the columns of ``df`` and no rows."""
    writer = df.limit(0).write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Apply ``change`` to the text columns' values that begin with a backslash."""
    texts = {n: F.col(quoted(n)) for n, t in df.dtypes if t == "string"}
    return df.withColumns({n: F.when(c.startswith("\\"), change(c)).otherwise(c)
                           for n, c in texts.items()}) if texts else df


def stage_csv(df: DataFrame, path: str) -> None:
    """Write the text files a bulk copy takes, headerless."""
    escaped = _texts(df, lambda text: F.concat(F.lit("\\"), text))
    escaped.write.mode("overwrite").options(**CSV_EXCHANGE).option("header", "false").csv(path)


def read_staged_csv(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    rows = (spark.read.options(**CSV_EXCHANGE).option("header", "false")
            .option("mode", "FAILFAST").schema(like.schema).csv(path))
    return _texts(rows, lambda text: F.substring(text, 2, 2**31 - 1))


@contextmanager
def _whole_table_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts take the overwrite mode from the session only; all other writes here state it."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "static")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def bulk_load(df: DataFrame, table: str, *, path: str | None = None, truncate: bool = False,
              create: bool = False, insert: bool = True) -> None:
    """Load a table through a staged copy, once, whatever the flags.

    ``create`` first replaces the table by an empty one of the same columns, ``truncate``
    empties it, all of it whatever the session says of partitions, and loads, ``insert``
    loads. The copy lets ``df`` read the table that is loaded; it is Parquet, so columns of
    any type pass. :func:`stage_csv` is for copies that leave Spark.
    """
    spark = df.sparkSession
    if create:
        create_empty(df, table, path)
    if not (truncate or insert):
        return
    staged = fresh_folder(spark, "bulk")
    try:
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        with _whole_table_overwrite(spark):
            (rows.select(*map(quoted, spark.table(table).columns)).write
             .insertInto(table, overwrite=truncate))
    finally:
        scratch = staged.rsplit("/", 1)[0]
        Storage(spark, scratch).delete(scratch)


def insert_rows(df: DataFrame, table: str) -> None:
    """Append to a lake table by column name, creating it on first use."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*map(quoted, spark.table(table).columns)).write.insertInto(table)
    else:
        df.write.format("parquet").saveAsTable(table)


def purge_files(spark: SparkSession, files: Iterable[str]) -> int:
    """Delete exactly the given files, so that later arrivals stay."""
    names = list(files)
    return Storage(spark, names[0]).delete_all(names) if names else 0
