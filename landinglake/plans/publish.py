"""Publish a data set as a lake table: align, write, register, and undo on failure.

Every file of a load carries the load's id in its name. That makes the load removable as a whole: a
failure takes back exactly its own files, and what it did to the catalog by the notes of its journal.

An overwrite of a table writes a data folder of its own below the table's and then moves the table
to it, so a reader gets the former rows or the new ones, never both or none; the former folder goes
after a grace time. A dynamic load replaces the files of the partitions it touches in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from landinglake.functions.names import clean_columns, clean_name
from landinglake.functions.quoting import quoted, table_identifier
from landinglake.functions.types import align_columns
from landinglake.operators.audit import Step
from landinglake.operators.partitions import (partition_folder, read_touched,
                                             touched_metric)
from landinglake.operators.sinks import load_prefix, write_files
from landinglake.operators.swap import (GRACE, partition_names,
                                        registered_values, relative_folder, retire, swap_table,
                                        sweep, table_state)
from landinglake.operators.tables import (add_partitions, create_table, extend_table,
                                          resolve_location)
from landinglake.operators.journal import LoadMarker, take_back_dead
from landinglake.sources.lake import SNAPSHOT, TableDefinition, find_table
from landinglake.storage import DELETE_THREADS, Storage, base_name, join_path

WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")

MODES = ("append", "overwrite", "dynamic")


@dataclass
class Published:
    """What a publish did."""

    table: str
    path: str
    load_id: str
    rows: int = 0
    partitions: list[dict[str, str | int | None]] = field(default_factory=list)
    steps: list[Step] = field(default_factory=list)
    skipped: bool = False


def remove_load(spark: SparkSession, path: str, load_id: str, depth: int) -> int:
    """Delete the files one load has written, and nothing else."""
    storage = Storage(spark, path)
    return storage.delete_all(storage.glob(path, *["*=*"] * depth, load_prefix(load_id) + "*"))


def carries_name(spark: SparkSession, published: Published) -> bool:
    """Do the files of a load have its name? Looked up in one of its partitions."""
    folder = partition_folder(spark, published.path, published.partitions[0]) \
        if published.partitions else published.path
    return bool(Storage(spark, published.path).glob(
        folder, load_prefix(published.load_id) + "*"))


def remove_published(spark: SparkSession, published: Published, depth: int) -> int:
    """The same for a load whose partitions are known: only their folders are looked at."""
    if not published.partitions:
        return remove_load(spark, published.path, published.load_id, depth)
    storage, name = Storage(spark, published.path), load_prefix(published.load_id) + "*"
    folders = [partition_folder(spark, published.path, v) for v in published.partitions]
    with ThreadPoolExecutor(DELETE_THREADS) as pool:
        return sum(pool.map(lambda f: storage.delete_all(storage.glob(f, name)), folders))


def drop_former_files(spark: SparkSession, path: str, load_id: str, depth: int,
                      touched: list[str] | None = None) -> None:
    """Delete files of earlier loads: all, or those in the folders the load has written to.

    A folder without files of the load goes as a whole; the work per partition is a
    listing, done by a few threads.
    """
    storage, prefix = Storage(spark, path), load_prefix(load_id)

    def clear(folder: str) -> None:
        files = [p for p, is_folder in storage.children(folder) if not is_folder]
        former = [p for p in files if not base_name(p).startswith(prefix)]
        if len(former) < len(files) or not depth:
            for name in former:
                storage.delete(name)
        elif touched is None:
            storage.delete(folder)

    folders = touched
    if folders is None:
        folders = storage.glob(path, *["*=*"] * depth) if depth else [path]
    with ThreadPoolExecutor(DELETE_THREADS) as pool:
        list(pool.map(clear, folders))


def _register(spark: SparkSession, definition: TableDefinition | None, published: Published,
              df: DataFrame, partition_cols: list[str], mode: str, provider: str,
              marker: LoadMarker) -> None:
    """Bring the catalog up to date; each step is noted first, so that it can be taken back."""
    if definition is None:
        marker.note("create")
        create_table(spark, published.table, published.path, df.schema, partition_cols, provider)
        add_partitions(spark, published.table, published.partitions)
    elif mode == "overwrite":
        marker.note("swap", **table_state(definition, registered_values(spark, definition)))
        swap_table(spark, published.table, published.path, swapped_schema(df, partition_cols),
                   published.partitions)
    else:
        known = partition_names(spark, published.table) if partition_cols else set()
        new = [v for v in published.partitions if relative_folder(spark, v) not in known]
        marker.note("extend", schema=json.loads(definition.schema.json()), partitions=new)
        extend_table(spark, definition, df.schema)
        add_partitions(spark, published.table, new)
    spark.catalog.refreshTable(published.table)


def swapped_schema(df: DataFrame, partition_cols: list[str]) -> StructType:
    """The columns of ``df`` as a catalog has them, partition columns last."""
    fields = {f.name: f for f in df.schema}
    names = [n for n in fields if n not in partition_cols] + partition_cols
    return StructType([StructField(n, fields[n].dataType) for n in names])


def _stored_types(df: DataFrame, definition: TableDefinition | None) -> DataFrame:
    """Bring aligned columns to the type the table declares, so that its files stay readable."""
    declared = {**definition.columns, **definition.partitions} if definition else {}
    return df.selectExpr(*[
        f"try_cast({quoted(n)} as {declared[n]}) as {quoted(n)}" if declared.get(n, t) != t
        else quoted(n) for n, t in df.dtypes])


def publish(df: DataFrame, table: str, path: str | None = None, *, mode: str = "append",
            partition_cols: list[str] | None = None, compression: str | None = None,
            file_format: str = "parquet", entity: str | None = None,
            load_id: str | None = None, grace: float = GRACE,
            before_commit: Callable[[Published], None] | None = None,
            check: Callable[[Published], None] | None = None) -> Published:
    """Write ``df`` into a lake table and register table and partitions.

    ``mode`` is append, overwrite (the whole table) or dynamic (only the partitions that
    ``df`` holds). ``df`` is evaluated once: row count and touched partitions come back as
    metrics of the write. A failure removes the files of this load, brings the catalog back, and
    raises again; remains of a load that has died are taken back first. With a ``load_id`` a load
    that has finished is not repeated. ``before_commit`` may check the outcome and raise;
    ``check`` may do so when the table is registered, and then see it as a reader does.
    Data folders that overwrites have left stay for ``grace`` seconds, then the next load
    deletes them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    spark, entity, table = df.sparkSession, entity or table, table_identifier(table)
    cleaned = clean_columns(df)
    depth = len(partition_cols or [])
    definition = find_table(spark, table)
    base = resolve_location(definition, path)
    marker = LoadMarker(spark, base, load_id or uuid.uuid4().hex)
    published = Published(table, base, load_id or marker.load_id)
    if load_id and marker.finished():
        published.skipped = True
        return published
    if undo_loads(spark, base, table, depth):
        definition = find_table(spark, table)
    partition_cols = [clean_name(c) for c in partition_cols or []]
    if definition is not None and partition_cols != definition.partition_cols:
        raise ValueError(f"{table} is partitioned by {definition.partition_cols}, "
                         f"not by {partition_cols}")
    marker.start()
    former = definition.location if definition is not None else base
    swap = definition is not None and mode == "overwrite"
    path = join_path(base, SNAPSHOT + published.load_id) if swap else former
    published.path = path

    def aligned(rows: DataFrame) -> DataFrame:
        # The former definition rules the types of an overwrite too, as it does for an append.
        return _stored_types(align_columns(rows, definition and definition.columns), definition)

    step = Step.start(entity, "Load_datalake")
    try:
        seen = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        if partition_cols:
            metrics.append(touched_metric(partition_cols))
        # Aligned after the shuffle, which then moves the narrower types. Observed there too,
        # in the tasks that write: these count once even if an executor is lost and earlier
        # stages run again.
        write_files(cleaned, path, file_format, partition_cols, compression, "append",
                    {"mapreduce.output.basename": load_prefix(published.load_id)},
                    finish=lambda rows: aligned(rows).observe(seen, *metrics))
        published.rows = seen.get["rows"]
        published.partitions = read_touched(
            (row.asDict() for row in seen.get.get("partitions", [])),
            (n for n, t in aligned(cleaned).dtypes if t in WHOLE_NUMBERS))
        published.steps.append(step.end())

        # Undoing and replacing go by file name; a commit protocol that ignores it must not
        # cost data, or leave some behind.
        if published.rows and not carries_name(spark, published):
            raise RuntimeError(f"the files written to {path} do not carry the load's name")

        step = Step.start(entity, "Update_glue_schema")
        if before_commit:
            before_commit(published)
        _register(spark, definition, published, aligned(cleaned), partition_cols, mode,
                  file_format, marker)
        if check:
            check(published)
        published.steps.append(step.end())
    except Exception:
        # The marker stays: if some of this fails too, the next load does it again.
        marker.undo(table)
        if swap:
            Storage(spark, base).delete(path)
        else:
            remove_published(spark, published, depth)
        raise
    if swap:
        retire(spark, base, former)
    elif mode != "append":
        touched = [partition_folder(spark, path, v) for v in published.partitions] or [path]
        drop_former_files(spark, path, published.load_id, depth,
                          touched if mode == "dynamic" else None)
        spark.catalog.refreshTable(table)
    if load_id:
        marker.finish()
    else:
        marker.forget()
    sweep(spark, base, grace)
    return published


def undo_loads(spark: SparkSession, base: str, table: str, depth: int,
               also: Callable[[str], object] = lambda load_id: None) -> list[str]:
    """Take back the loads of a table that have started and died: catalog, files, and ``also``."""
    def remove(load_id: str) -> None:
        definition = find_table(spark, table)
        Storage(spark, base).delete(join_path(base, SNAPSHOT + load_id))
        remove_load(spark, definition.location if definition else base, load_id, depth)
        also(load_id)

    return take_back_dead(spark, base, table, None, remove)
