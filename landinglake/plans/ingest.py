"""Landing to lake: one entity, an entity with its records, all entities of a prefix.

The source is parsed once. Parsing writes a staged Parquet table into the shared scratch
folder and takes the column profile, the record and reject counts on the way; rejects and
data are then read from the staged columns. Nothing is cached on executors, so a lost one
costs its tasks only, and no parsed row passes through the driver.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landinglake.errors import AllRecordsRejected, NameCollision
from landinglake.functions.names import clean_name
from landinglake.functions.quoting import quoted, table_identifier
from landinglake.functions.times import TIME_PARTS, add_time_parts, parse_time
from landinglake.functions.types import lost_casts
from landinglake.operators.audit import FAILED, Step, fold_status, step_frame
from landinglake.operators.ledger import FileLedger
from landinglake.operators.metastore import entity_mapping
from landinglake.operators.quality import (accepted_rows, drop_null_columns, has_payload,
                                           profile_metric)
from landinglake.operators.sinks import (append_database, append_files, purge_files,
                                        remove_rejects, write_rejects)
from landinglake.operators.tables import RUN_ID, schema_rows
from landinglake.operators.journal import LoadMarker
from landinglake.plans.publish import publish, undo_loads
from landinglake.sources.lake import find_table
from landinglake.sources.landing import (CORRUPT_RECORD, Landing, entity_files, listed_files,
                                         read_landing)
from landinglake.storage import Storage, fresh_folder, join_path

log = logging.getLogger(__name__)

# Entities loaded at the same time; each is a Spark job of its own in a FAIR pool.
PARALLEL_ENTITIES = 5

LOAD_STEP = "raw_data_to_datalake"

# Columns that exist only while a folder is staged.
PAYLOAD_FLAG, LOST_FLAG = "_landing_has_payload", "_landing_lost_values"

Item = TypeVar("Item")


@dataclass(frozen=True)
class LoadOptions:
    """How files are read and a table is written; the same for all entities of a run."""

    source_format: str = "json"
    read_options: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | Mapping[str, StructType] | None = None
    file_format: str = "parquet"
    mode: str = "append"
    compression: str | None = None
    partition_cols: tuple[str, ...] = ()
    base_column: str | None = None

    def __post_init__(self):
        if self.partition_cols and not self.base_column:
            raise ValueError(f"{', '.join(self.partition_cols)} need a base column")

    def schema_of(self, entity: str) -> StructType | None:
        """The given schema of an entity; one for all, or one per entity."""
        if isinstance(self.schema, Mapping):
            return self.schema.get(entity)
        return self.schema


@dataclass
class Ingested:
    """Outcome of one entity."""

    entity: str
    ok: bool
    all_rejected: bool = False
    records: int = 0
    rejects: int = 0
    accepted: int = 0
    lost_values: int = 0
    steps: list[Step] = field(default_factory=list)
    files: tuple[str, ...] = ()
    load_id: str | None = None
    loaded_before: int = 0


class Recorder:
    """Takes the records of a run; this one keeps Parquet tables below a folder."""

    def __init__(self, root: str):
        self.root = root

    def steps(self, rows: DataFrame) -> None:
        append_files(rows, join_path(self.root, "jobs_execution_detail"))

    def schema(self, rows: DataFrame) -> None:
        append_files(rows, join_path(self.root, "entity_schema_details"))

    def mapping(self, rows: DataFrame) -> None:
        append_files(rows, join_path(self.root, "entity_process_execution_mapping"))


class DatabaseRecorder(Recorder):
    """The same records in database tables."""

    def __init__(self, url: str, options: Mapping[str, str] | None = None):
        self.url, self.options = url, options

    def steps(self, rows: DataFrame) -> None:
        append_database(rows, self.url, "jobs_execution_detail", self.options)

    def schema(self, rows: DataFrame) -> None:
        append_database(rows, self.url, "entity_schema_details", self.options)

    def mapping(self, rows: DataFrame) -> None:
        append_database(rows, self.url, "entity_process_execution_mapping", self.options)


@dataclass(frozen=True)
class Staged:
    """Parsed rows in the scratch folder, with what was counted while parsing."""

    rows: DataFrame
    folder: str
    profile: dict[str, int]
    records: int
    rejects: int
    accepted: int
    lost_values: int


def stage(landing: Landing, run_id: int, table_types: Mapping[str, str] | None = None,
          base_column: str | None = None, label: str = "stage") -> Staged:
    """Parse a landing folder into scratch Parquet and profile it in the same tasks.

    Blank rows are counted but not staged. The write has no shuffle before it, so the
    metrics come from tasks that count once.
    """
    payload = landing.payload
    if taken := [c for c in payload if clean_name(c) == RUN_ID]:
        raise NameCollision(f"payload column {taken[0]!r} has the name of the run id")
    rows = landing.rows.withColumn(RUN_ID, F.lit(run_id))
    columns = rows.columns
    base_column = base_column and find_column(payload, base_column)
    names = {c: clean_name(c) for c in payload}
    others = rows.selectExpr(*[quoted(c) for c in payload if c != base_column])
    lost = lost_casts(others, table_types, names)
    if base_column:
        moment = F.col(quoted(base_column))
        lost = lost + F.when(moment.isNotNull() & parse_time(moment).isNull(), 1).otherwise(0)
    seen = Observation()
    spark, folder = rows.sparkSession, fresh_folder(rows.sparkSession, label)
    # What takes more than a look at a column is computed before the metrics, which are
    # interpreted, in generated code.
    flagged = rows.select("*", has_payload(payload).alias(PAYLOAD_FLAG), lost.alias(LOST_FLAG))
    corrupt, filled = F.col(CORRUPT_RECORD).isNotNull(), F.col(PAYLOAD_FLAG)
    (flagged.observe(seen, F.count(F.lit(1)).alias("rows"),
                     F.count_if(~corrupt & filled).alias("accepted"),
                     F.coalesce(F.sum(LOST_FLAG), F.lit(0)).alias("lost"),
                     profile_metric(columns).alias("profile"))
     .filter(corrupt | filled).drop(PAYLOAD_FLAG, LOST_FLAG).write.parquet(folder))
    counts = seen.get
    profile = dict(zip(columns, counts["profile"]))
    rejects = profile.pop(CORRUPT_RECORD)
    return Staged(spark.read.schema(rows.schema).parquet(folder), folder, profile,
                  counts["rows"], rejects, counts["accepted"], counts["lost"])


def find_column(columns: Iterable[str], name: str) -> str | None:
    """The column Spark would resolve ``name`` to, upper or lower case alike."""
    return next((c for c in columns if c.lower() == name.lower()), None)


def shape(staged: Staged, base_column: str | None) -> DataFrame:
    """Accepted rows with time columns and without the columns that held no value."""
    rows = accepted_rows(staged.rows)
    if base_column:
        wanted, base_column = base_column, find_column(rows.columns, base_column)
        if base_column is None:
            raise ValueError(f"no column {wanted!r} to derive partitions from")
        others = {c: n for c, n in staged.profile.items() if c != base_column}
        rows = drop_null_columns(rows, others)
        if taken := [c for c in rows.columns if clean_name(c) in TIME_PARTS]:
            raise NameCollision(f"payload column {taken[0]!r} has the name of a time column")
        rows = rows.withColumn(base_column, parse_time(F.col(quoted(base_column))))
        rows = add_time_parts(rows, base_column)
        return rows if staged.profile.get(base_column, 1) else rows.drop(base_column)
    return drop_null_columns(rows, staged.profile)


def ingest_entity(spark: SparkSession, entity: str, source: str, table: str, lake_path: str,
                  reject_path: str, run_id: int = -1, options: LoadOptions = LoadOptions(),
                  landing: Landing | None = None, load_id: str | None = None,
                  purge_rejected: bool = True, once: bool = False) -> Ingested:
    """Load one entity's folder into its table; a failure is an outcome, not an exception.

    With ``once``, each file is loaded once: the table's ledger tells which files finished loads
    have read, and these are left out, whether they were purged or not and whatever else has come.
    What a load that has died has left in the table, the rejects and the catalog is taken back.

    If every record is malformed the rejects are kept, the source files are deleted, and
    the table is left alone, as it is if all records are blank. A load that fails takes its
    rejects back, so that the next try does not store them again.
    """
    step = Step.start(entity, LOAD_STEP)
    outcome = Ingested(entity, ok=False)
    staged, rejects_id, ledger, marker = None, "", None, None
    try:
        if once:
            ledger = FileLedger(spark, lake_path)
            undo_loads(spark, lake_path, table_identifier(table), len(options.partition_cols),
                       also=lambda dead: (ledger.drop(dead),
                                          remove_rejects(spark, reject_path, dead)))
            loaded = ledger.loaded()
            known = _loaded_before(spark, source, options, loaded, outcome)
            try:
                landing = landing or read_landing(
                    spark, source, options.source_format, options.schema_of(entity),
                    options.read_options, loaded)
            except FileNotFoundError:
                if not known:
                    raise
                step.records_cnt, step.reject_records_cnt = outcome.records, outcome.rejects
                outcome.all_rejected = outcome.records == outcome.rejects > 0
                outcome.files, outcome.ok = known, True
                outcome.steps.append(step.end(description="loaded before"))
                return outcome
            load_id = outcome.load_id = load_id or landing.load_id
            outcome.files = (*landing.files, *known)
            if known:  # a load that has finished, but perhaps died before it was recorded
                outcome.steps.append(replace(
                    step, records_cnt=outcome.records, reject_records_cnt=outcome.rejects).end(
                    description="loaded before"))
            marker = LoadMarker(spark, lake_path, load_id)
            marker.start()
        else:
            landing = landing or read_landing(spark, source, options.source_format,
                                              options.schema_of(entity), options.read_options)
            outcome.files = landing.files
        rejects_id = load_id or uuid.uuid4().hex
        definition = find_table(spark, table)
        staged = stage(landing, run_id, definition and definition.columns, options.base_column,
                       f"stage-{entity}")
        outcome.records = step.records_cnt = staged.records
        outcome.rejects = step.reject_records_cnt = staged.rejects
        outcome.accepted, outcome.lost_values = staged.accepted, staged.lost_values
        if ledger and landing.listed is not None:
            ledger.stage(load_id, landing.listed, staged.records, staged.rejects, staged.accepted,
                         staged.lost_values)
        if staged.rejects:
            write_rejects(staged.rows, reject_path, run_id, rejects_id)
        if staged.rejects and staged.rejects == staged.records:
            outcome.all_rejected = True
            if marker:
                marker.finish()
            if purge_rejected:
                purge_files(spark, outcome.files)
            raise AllRecordsRejected(f"{entity}: all records are malformed")
        if staged.accepted:
            published = publish(
                shape(staged, options.base_column), table, lake_path, mode=options.mode,
                partition_cols=list(options.partition_cols), compression=options.compression,
                file_format=options.file_format, entity=entity, load_id=load_id)
            outcome.steps += published.steps
        elif marker:
            marker.finish()
        lost = staged.lost_values
        outcome.steps.append(step.end(
            description=f"{lost} values did not fit their type" if lost else None))
        outcome.ok = True
    except AllRecordsRejected as error:
        log.warning("%s", error)
        outcome.steps.append(step.end(FAILED, str(error)))
    except Exception as error:
        log.exception("%s: load failed", entity)
        outcome.steps.append(step.end(FAILED, str(error)))
        if outcome.rejects:
            _clean_up(entity, lambda: remove_rejects(spark, reject_path, rejects_id))
    finally:
        if staged:
            scratch = staged.folder.rsplit("/", 1)[0]
            _clean_up(entity, lambda: Storage(spark, scratch).delete(scratch))
    return outcome


def _loaded_before(spark: SparkSession, source: str, options: LoadOptions,
                   loaded: DataFrame | None, outcome: Ingested) -> tuple[str, ...]:
    """Files that are still there though a finished load has read them; the outcome gets the
    counts of these loads."""
    if loaded is None or not Storage(spark, source).exists(source):
        return ()
    found = listed_files(spark, source, options.read_options)
    entries = found.join(loaded, found.columns).drop("length", "modified").collect()
    loads = {r.load_id: r for r in entries}.values()
    outcome.records, outcome.rejects, outcome.accepted, outcome.lost_values = (
        sum(r[c] for r in loads) for c in ("records", "rejects", "accepted", "lost_values"))
    outcome.loaded_before = len(entries)
    return tuple(sorted(r.path for r in entries))


def _clean_up(entity: str, work: Callable[[], object]) -> None:
    """What is left behind must not cost the outcome of the load, or of other entities."""
    try:
        work()
    except Exception:
        log.exception("%s: clean-up failed", entity)


def refresh_entity(spark: SparkSession, entity: str, source: str, table: str, lake_path: str,
                   reject_path: str, recorder: Recorder, run_id: int, job_run_id: int,
                   options: LoadOptions = LoadOptions(), purge: bool = True,
                   once: bool | None = None) -> Ingested:
    """Load an entity and record it: audit steps, column types, run mapping; then purge.

    The source files go last, and only those that were read. If the driver is lost between the
    load and the purge, the next call loads what has come since, records, and purges both. An
    entity with nothing but malformed records counts as done, without column types and mapping.
    ``once`` (the same as ``purge`` unless told) loads each file once; without a purge it makes
    a folder that only grows loadable again and again.
    """
    once = purge if once is None else once
    outcome = ingest_entity(spark, entity, source, table, lake_path, reject_path, run_id, options,
                            purge_rejected=purge, once=once)
    try:
        outcome = record_outcome(spark, outcome, table, recorder, run_id, job_run_id)
        if outcome.ok and purge:
            purge_files(spark, outcome.files)
        if outcome.ok and once:
            ledger = FileLedger(spark, lake_path)
            if purge:  # all files of all finished loads are gone, so they cannot come again
                ledger.forget(ledger.committed())
            elif Storage(spark, source).exists(source):
                ledger.compact(listed_files(spark, source, options.read_options))
    except Exception:
        log.exception("%s: recording failed", entity)
        return replace(outcome, ok=False)
    return outcome


def record_outcome(spark: SparkSession, outcome: Ingested, table: str, recorder: Recorder,
                   run_id: int, job_run_id: int) -> Ingested:
    """Store a load's audit steps and, if it has loaded, column types and run mapping."""
    recorder.steps(step_frame(spark, outcome.steps, job_run_id))
    if outcome.all_rejected:
        return replace(outcome, ok=True)
    if outcome.ok:
        if outcome.accepted or outcome.loaded_before and find_table(spark, table):
            recorder.schema(schema_rows(spark, table, clean_name(outcome.entity), run_id))
        recorder.mapping(entity_mapping(spark, run_id, outcome.entity))
    return outcome


def for_each_entity(spark: SparkSession, entities: Iterable[Item], work: Callable[[Item], object],
                    parallel: int = PARALLEL_ENTITIES) -> list:
    """Submit the Spark jobs of several entities side by side."""
    def submit(entity: Item) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", str(entity))
        return work(entity)
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(inheritable_thread_target(spark)(submit), entities))


def status_frame(spark: SparkSession, flags: Iterable[tuple[str, bool]]) -> DataFrame:
    return spark.createDataFrame(list(flags), "entity string, ok boolean")


def run_status(flags: DataFrame) -> bool:
    """One flag for the run: false as soon as one entity failed."""
    return fold_status(flags).first().ok


def ingest_all(spark: SparkSession, landing_prefix: str, lake_prefix: str, error_prefix: str,
               recorder: Recorder, run_id: int, job_run_id: int,
               options: LoadOptions = LoadOptions(), exclude: Iterable[str] = (),
               table_name: Callable[[str], str] = clean_name, purge: bool = True,
               parallel: int = PARALLEL_ENTITIES) -> list[Ingested]:
    """Load every entity folder below a prefix; folders without files are skipped.

    A table takes one load at a time, as concurrent file commits into one folder are not
    safe on every store; different tables are loaded side by side.
    """
    if not Storage(spark, landing_prefix).exists(landing_prefix):
        return []
    listed = entity_files(spark, landing_prefix, exclude).filter("files > 0")
    entities = sorted(row.entity for row in listed.select("entity").collect())

    def load(entity: str) -> Ingested:
        return refresh_entity(
            spark, entity, join_path(landing_prefix, entity), table_name(entity),
            join_path(lake_prefix, entity), join_path(error_prefix, entity), recorder,
            run_id, job_run_id, options, purge)

    return for_each_entity(spark, entities, load, parallel)

