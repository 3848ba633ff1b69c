"""Incremental ingest: each landing file once, however often the job is started."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.functions.names import clean_name
from landinglake.functions.quoting import table_identifier
from landinglake.operators.audit import FAILED, Step
from landinglake.plans.ingest import (LOAD_STEP, PARALLEL_ENTITIES, Ingested, LoadOptions, Recorder,
                                      for_each_entity, ingest_entity, record_outcome)
from landinglake.operators.journal import LoadMarker
from landinglake.sources.landing import (Landing, arriving_files, entity_files, listed_files,
                                         read_landing, taken_files)
from landinglake.storage import Storage, join_path

log = logging.getLogger(__name__)


def ingest_new_files(spark: SparkSession, entity: str, source: str, table: str, lake_path: str,
                     reject_path: str, checkpoint: str, run_id: int = -1,
                     options: LoadOptions = LoadOptions(), archive: str | None = None,
                     files_per_batch: int | None = None, recorder: Recorder | None = None,
                     job_run_id: int = -1) -> list[Ingested]:
    """Load the files that have arrived since the last call, in sub-folders too, then end.

    The stream only tells which files have arrived; each batch of them is read as a batch load
    reads a folder, with the same choice of files, columns from folder names and, without a given
    schema, inference over the batch's files. With a ``recorder`` every batch stores its audit
    steps, column types and run mapping, as a batch load does; a batch that Spark repeats stores
    them again.

    The checkpoint remembers the files. Query and batch number make up the load id, so a
    batch that Spark repeats after a crash is not loaded twice. ``archive`` moves finished files
    away instead of deleting them; Spark does so with a delay. ``files_per_batch`` cuts a
    backlog into batches.

    At the end the folder is listed and held against the checkpoint. Files that were there and
    have not been taken, after a second run, make an outcome that is not ok.
    """
    if not Storage(spark, source).exists(source):
        return []
    files = arriving_files(spark, source, options.read_options, files_per_batch, archive)
    memory, outcomes = join_path(checkpoint, entity), []

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        names = [row.path for row in batch.select("path").collect()]
        if not names:
            return
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        landing = read_landing(session, source, options.source_format, options.schema_of(entity),
                               options.read_options, files=names)
        # The files stay with the stream source; a batch of only rejects purges none.
        outcome = ingest_entity(
            session, entity, source, table, lake_path, reject_path, run_id, options,
            landing=Landing(landing.rows, ()), load_id=f"{query}-{number}")
        if not outcome.ok and not outcome.all_rejected:
            raise RuntimeError(outcome.steps[-1].description)
        if recorder:
            outcome = record_outcome(session, outcome, table, recorder, run_id, job_run_id)
        outcomes.append(outcome)
        if number > 1:
            # Only the newest batch can be repeated.
            LoadMarker(session, lake_path, f"{query}-{number - 2}").forget()

    def run() -> None:
        (files.writeStream.foreachBatch(load).option("checkpointLocation", memory)
         .trigger(availableNow=True).start().awaitTermination())

    run()
    if missed := unread_files(spark, source, memory, options.read_options):
        run()  # some may have come while the first run went on
        still = unread_files(spark, source, memory, options.read_options)
        if left := sorted(set(missed) & set(still)):
            outcomes.append(_unread(entity, left))
    if outcomes and spark.catalog.tableExists(table_identifier(table)):
        # Batches run in a session of their own; this one may have looked up the table before.
        spark.catalog.refreshTable(table_identifier(table))
    return outcomes


def unread_files(spark: SparkSession, source: str, memory: str,
                 options: Mapping[str, str] | None = None) -> list[str]:
    """Files of a folder that its stream has not taken; as a rule none."""
    listed = listed_files(spark, source, options).select(
        F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
    if not Storage(spark, memory).exists(join_path(memory, "sources", "0")):
        return [row.path for row in listed.collect()]
    return [row.path for row in listed.join(taken_files(spark, memory), "path", "left_anti")
            .collect()]


def _unread(entity: str, files: list[str]) -> Ingested:
    step = Step.start(entity, LOAD_STEP)
    message = f"{len(files)} files have not been read, {files[0]} among them"
    log.error("%s: %s", entity, message)
    return Ingested(entity, ok=False, steps=[step.end(FAILED, message)])


def ingest_new_all(spark: SparkSession, landing_prefix: str, lake_prefix: str, error_prefix: str,
                   checkpoint: str, recorder: Recorder, run_id: int, job_run_id: int,
                   options: LoadOptions = LoadOptions(), exclude: Iterable[str] = (),
                   table_name: Callable[[str], str] = clean_name,
                   parallel: int = PARALLEL_ENTITIES) -> list[Ingested]:
    """:func:`ingest_new_files` for every entity of a prefix that has files, side by side.

    An entity that fails is an outcome, and its files are tried again by the next call.
    """
    if not Storage(spark, landing_prefix).exists(landing_prefix):
        return []
    listed = entity_files(spark, landing_prefix, exclude).select("entity").collect()

    def load(entity: str) -> list[Ingested]:
        try:
            return ingest_new_files(
                spark, entity, join_path(landing_prefix, entity), table_name(entity),
                join_path(lake_prefix, entity), join_path(error_prefix, entity), checkpoint,
                run_id, options, recorder=recorder, job_run_id=job_run_id)
        except Exception:
            log.exception("%s: incremental load failed", entity)
            return [Ingested(entity, ok=False)]

    names = sorted(row.entity for row in listed)
    return [o for found in for_each_entity(spark, names, load, parallel) for o in found]
