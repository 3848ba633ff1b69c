"""One callable (session, table folder) -> DataFrame per operator of the blueprint.

All of them work over whole tables. Times are returned as text and integers as bigint, so
that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType)

from landinglake.functions.names import clean_columns, clean_name, clean_text
from landinglake.functions.times import TIME_PARTS, add_time_parts, parse_time, utc_text
from landinglake.functions.types import align_columns, lost_casts
from landinglake.operators import audit, metastore, quality, sinks, tables
from landinglake.operators.partitions import partition_map, partition_values
from landinglake.plans import ingest, layers
from landinglake.plans.publish import publish
from landinglake.registry.fixtures import (csv_folder, events, landing_folder, landing_tree,
                                           metadata, table, write_tree)
from landinglake.sources import lake
from landinglake.sources.landing import CORRUPT_RECORD, SOURCE_FILE, entity_files, read_landing
from landinglake.storage import Storage, fresh_folder, join_path
from landinglake.streaming import ingest_new_all, ingest_new_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DAY_PARTS = ["year", "month", "day"]
# Fixed value: the clock of the audit and status queries.
CLOCK = "2024-06-01 12:30:00.000250"


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def _new_table(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def _bigints(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _clock():
    return F.lit(CLOCK).cast("timestamp")


def _event_text(df: DataFrame) -> DataFrame:
    """Events as they come back from a lake, in comparable types."""
    return df.select("event_id", utc_text(F.col("ts")).alias("ts"), "user_id", "event_type",
                     F.col("value").cast("string").alias("value"), "props")


def _by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day columns, as a load of the lake."""
    return add_time_parts(events(spark, sf_dir), "ts").drop("hour")


# Landing: reading, rejects, lineage

@query
def landing_accept(spark, sf_dir):
    rows = read_landing(spark, landing_folder(spark, sf_dir), "json").rows
    payload = [c for c in rows.columns if c not in (CORRUPT_RECORD, SOURCE_FILE)]
    accepted = quality.drop_blank_rows(quality.accepted_rows(rows), payload)
    return clean_columns(accepted.drop(SOURCE_FILE, "note"))


@query
def reject_counts(spark, sf_dir):
    """Counts taken while the folder is parsed, without a second look at it."""
    staged = ingest.stage(read_landing(spark, landing_folder(spark, sf_dir), "json"), run_id=1)
    return spark.createDataFrame(
        [(staged.records, staged.rejects, staged.records == staged.rejects)],
        "records_cnt bigint, reject_records_cnt bigint, all_rejected boolean")


@query
def reject_lines(spark, sf_dir):
    staged = ingest.stage(read_landing(spark, landing_folder(spark, sf_dir), "json"), run_id=7)
    folder = fresh_folder(spark, "error")
    sinks.write_rejects(staged.rows, folder, run_id=7)
    return lake.read_rejects(spark, folder)


def _tree_rows(spark, sf_dir):
    tree = read_landing(spark, landing_tree(spark, sf_dir), "json",
                        options={"recursiveFileLookup": "true"})
    entity = F.regexp_extract(SOURCE_FILE, "([^/]+)/[^/]+$", 1)
    return tree.rows.withColumn("entity", entity)


@query
def all_rejected(spark, sf_dir):
    return quality.reject_summary(_tree_rows(spark, sf_dir), "entity")


@query
def landing_entities(spark, sf_dir):
    found = entity_files(spark, landing_tree(spark, sf_dir), exclude=["signup"])
    return found.filter("files > 0 and bytes > 0").select("entity")


@query
def lineage_counts(spark, sf_dir):
    return _tree_rows(spark, sf_dir).groupBy("entity").agg(F.count(F.lit(1)).alias("records"))


@query
def csv_rejects(spark, sf_dir):
    schema = StructType([StructField("s_suppkey", LongType()), StructField("s_name", StringType()),
                         StructField("s_nationkey", LongType()),
                         StructField("s_acctbal", DoubleType())])
    staged = ingest.stage(read_landing(spark, csv_folder(spark, sf_dir), "csv", schema), run_id=1)
    return staged.rows.select(
        F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey"), F.col("s_acctbal"),
        F.col(CORRUPT_RECORD).alias("rejected_line"))


# Profile and clean-up

@query
def column_profile(spark, sf_dir):
    df = events(spark, sf_dir)
    odd = F.col("event_type") == "view"
    return quality.column_profile(df.withColumns({
        "value": F.when(odd, None).otherwise(F.col("value")),
        "is_large": F.when(odd, F.col("value") > 50),
        "late_ts": F.when(F.col("value") > 50, F.col("ts")),
        "tags": F.when(~odd, F.array("event_type", "props")),
        "origin": F.when(odd, F.struct("user_id", "event_id"))}))


@query
def bulk_profile(spark, sf_dir):
    return quality.column_profile(table(spark, sf_dir, "lineitem"))


@query
def drop_null_columns(spark, sf_dir):
    df = _event_text(events(spark, sf_dir)).withColumns({
        "no_text": F.lit(None).cast("string"), "no_flag": F.lit(None).cast("boolean"),
        "no_time": F.lit(None).cast("timestamp"), "no_tags": F.lit(None).cast("array<string>")})
    return quality.drop_null_columns(df)


@query
def drop_blank_rows(spark, sf_dir):
    payload = ["user_id", "event_type", "value", "props"]
    blank = F.col("event_type") == "click"
    df = events(spark, sf_dir).select(
        "event_id", *[F.when(~blank, F.col(c)).alias(c) for c in payload])
    return quality.drop_blank_rows(df.withColumn(tables.RUN_ID, F.lit(3).cast("bigint")), payload)


# Names, times, types

@query
def sanitize_columns(spark, sf_dir):
    return clean_columns(table(spark, sf_dir, "supplier").toDF(
        "SSuppkey", "s Näme", "sNationkey", "S--acctbal"))


@query
def sanitize_values(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("clean"))


def _spoilt_times(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("at "), text))
        .otherwise(text).alias("ts"))


@query
def parse_time_query(spark, sf_dir):
    return _spoilt_times(spark, sf_dir).select(
        "event_id", utc_text(parse_time(F.col("ts"))).alias("ts"))


@query
def time_partitions(spark, sf_dir):
    return _bigints(add_time_parts(events(spark, sf_dir).select("event_id", "ts"), "ts")
                    .drop("ts"), *TIME_PARTS)


@query
def align_schema(spark, sf_dir):
    """Lineitem against a table of other types: casts, exact decimals, new columns last."""
    known = {"l_quantity": "bigint", "l_returnflag": "bigint", "l_partkey": "double",
             "l_tax": "double", "l_linenumber": "string"}
    aligned = align_columns(table(spark, sf_dir, "lineitem").drop("l_shipdate"), known)
    types = dict(aligned.dtypes)
    return aligned.select(
        "l_orderkey", "l_suppkey", "l_linestatus", "l_quantity", "l_returnflag", "l_tax",
        "l_linenumber", F.col("l_partkey").cast("string").alias("l_partkey"),
        F.col("l_extendedprice").cast("string").alias("l_extendedprice"),
        F.col("l_discount").cast("string").alias("l_discount"),
        F.lit(types["l_extendedprice"]).alias("price_type"),
        F.lit(",".join(aligned.columns[:5])).alias("first_columns"))


@query
def lost_values(spark, sf_dir):
    """How many values an alignment would turn into null."""
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_tax")
    return df.agg(F.sum(lost_casts(df, {"l_returnflag": "bigint"})).alias("lost"))


# Lake tables

def _lake(spark, *loads: tuple[DataFrame, str], partition_cols=tuple(DAY_PARTS)):
    name, path = _new_table("events"), fresh_folder(spark, "lake")
    for rows, mode in loads:
        publish(rows, name, path, mode=mode, partition_cols=list(partition_cols))
    return name, path


@query
def lake_append(spark, sf_dir):
    df, early = _by_day(spark, sf_dir), F.col("event_type").isin("view", "click")
    name, _ = _lake(spark, (df.filter(early), "append"), (df.filter(~early), "append"))
    return _event_text(spark.table(name))


@query
def lake_overwrite(spark, sf_dir):
    df = _by_day(spark, sf_dir)
    name, _ = _lake(spark, (df.withColumn("value", -F.col("value")), "append"),
                    (df.filter("day > 3"), "overwrite"))
    return _event_text(spark.table(name))


@query
def lake_dynamic(spark, sf_dir):
    df = _by_day(spark, sf_dir)
    name, _ = _lake(spark, (df, "append"),
                    (df.filter("day <= 15").withColumn("value", -F.col("value")), "dynamic"))
    return _event_text(spark.table(name))


@query
def plain_files(spark, sf_dir):
    """The bare file sink: overwrite by default, dynamic on demand, compression."""
    df, path = _by_day(spark, sf_dir), fresh_folder(spark, "files")
    sinks.write_files(df.withColumn("value", F.lit(0.0)), path, partition_cols=DAY_PARTS)
    sinks.write_files(df, path, "parquet", DAY_PARTS, "gzip", "dynamic")
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"), F.max("value").alias("max_value"))


@query
def schema_evolution(spark, sf_dir):
    """A second load with drifted types, a missing column and a new one."""
    df = _by_day(spark, sf_dir)
    drifted = df.select(
        "event_id", "ts", F.concat(F.when(F.col("event_type") == "view", "u").otherwise(""),
                                   F.col("user_id")).alias("userID"),
        F.col("value").cast("string").alias("value"), F.col("event_type").alias("kind"),
        *DAY_PARTS)
    name, _ = _lake(spark, (df.withColumn("event_id", F.col("event_id").cast("int")), "append"),
                    (drifted, "append"))
    return spark.table(name).select(
        "event_id", "user_id", F.col("value").cast("string").alias("value"), "event_type", "kind")


@query
def array_columns(spark, sf_dir):
    """Arrays pass through publish unchanged; int columns are widened."""
    name, path = _new_table("vectors"), fresh_folder(spark, "lake")
    publish(table(spark, sf_dir, "embeddings"), name, path)
    return spark.table(name).select(
        "vec_id", "label", F.size("embedding").cast("bigint").alias("dims"),
        F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 1_000_000)
                                 .cast("bigint").cast("string")), ",").alias("millionths"))


@query
def bulk_write(spark, sf_dir):
    """The largest table into month partitions, read back from the lake."""
    df = add_time_parts(table(spark, sf_dir, "lineitem"), "l_shipdate").drop("day", "hour")
    name, _ = _lake(spark, (df, "append"), partition_cols=("year", "month"))
    return spark.table(name).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("records"), F.sum("l_quantity").cast("string").alias("quantity"))


@query
def partition_pruned(spark, sf_dir):
    name, _ = _lake(spark, (_by_day(spark, sf_dir), "append"))
    return (spark.table(name).filter("year = 2024 and month = 1 and day between 10 and 12")
            .groupBy("day").agg(F.count(F.lit(1)).alias("records"),
                                F.countDistinct("user_id").alias("users")))


@query
def partition_tuples(spark, sf_dir):
    df = add_time_parts(events(spark, sf_dir).select("ts"), "ts")
    return _bigints(partition_values(df, TIME_PARTS), *TIME_PARTS)


@query
def partition_summary(spark, sf_dir):
    df = add_time_parts(events(spark, sf_dir).select("ts"), "ts")
    found = partition_map(df, list(TIME_PARTS), "lake/events")
    return found.select("prefix", F.concat_ws("|", "values").alias("values"))


@query
def table_partitions(spark, sf_dir):
    """Partitions as the catalog knows them; unreadable times have the null partition."""
    spoilt = _spoilt_times(spark, sf_dir).withColumn("ts", parse_time(F.col("ts")))
    name, _ = _lake(spark, (add_time_parts(spoilt, "ts").drop("hour"), "append"))
    return spark.sql(f"show partitions {name}")


@query
def schema_rows(spark, sf_dir):
    name, _ = _lake(spark, (_by_day(spark, sf_dir).withColumn(tables.RUN_ID, F.lit(5)), "append"))
    rows, path = tables.schema_rows(spark, name, clean_name("RawEvents"), 5), fresh_folder(spark, "schema")
    sinks.append_files(rows, path)
    return lake.read_appended(spark, path).withColumn("process_execution_id",
                                               F.col("process_execution_id").cast("bigint"))


# Job metadata

@query
def run_entities(spark, sf_dir):
    return metastore.run_entities(metadata(spark, sf_dir, "mapping"), 3)


def _job_tables(spark, sf_dir):
    names = ("jobs", "classes", "class_params", "edges", "processes", "subscribers",
             "applications", "job_values")
    return [metadata(spark, sf_dir, n) for n in names]


@query
def job_params(spark, sf_dir):
    """Every process at once."""
    return _bigints(metastore.job_params(*_job_tables(spark, sf_dir)),
                    "process_id", "is_mandatory")


@query
def job_params_of_process(spark, sf_dir):
    return _bigints(metastore.job_params(*_job_tables(spark, sf_dir), process_id=3),
                    "is_mandatory")


@query
def latest_status(spark, sf_dir):
    return metastore.latest_status(metadata(spark, sf_dir, "runs"))


@query
def latest_status_of_run(spark, sf_dir):
    return metastore.latest_status(metadata(spark, sf_dir, "runs"), run_id=3)


def _ready(spark, sf_dir, **options):
    names = ("runs", "jobs", "classes", "edges")
    return metastore.ready_jobs(*[metadata(spark, sf_dir, n) for n in names], **options)


@query
def ready_jobs(spark, sf_dir):
    """Ready runs of all processes; parents judged by one run, as the template does."""
    return _ready(spark, sf_dir, run_id=3)


@query
def ready_jobs_any_run(spark, sf_dir):
    return _ready(spark, sf_dir)


@query
def ready_jobs_own_run(spark, sf_dir):
    return _ready(spark, sf_dir, run_id=3, own_run_only=True)


@query
def timeline_entities(spark, sf_dir):
    return metastore.timeline_entities(*[metadata(spark, sf_dir, n)
                                         for n in ("timeline", "narrations", "fields")])


def _timed_runs(spark, sf_dir, *renamed: str):
    none = F.lit(None).cast("timestamp")
    status, start, end = renamed
    return metadata(spark, sf_dir, "runs").withColumnRenamed("jobs_status", status).withColumns(
        {start: none, end: none, "updated_dt": none, "updated_by": F.lit("setup")})


def _changes(spark, sf_dir, final: str):
    """Every run in state R starts; those of early processes change once more."""
    ready = metadata(spark, sf_dir, "runs").filter("jobs_status = 'R'")
    again = ready.filter("process_execution_id < 5")
    return (ready.select("id", F.lit(1).alias("seq"), F.lit("I").alias("status"))
            .union(again.select("id", F.lit(2), F.lit(final))))


def _as_text(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({c: utc_text(F.col(c)) for c in (*times, "updated_dt")})


@query
def status_start(spark, sf_dir):
    runs = _timed_runs(spark, sf_dir, "jobs_status", "jobs_start_dt", "jobs_end_dt")
    changed = metastore.start_jobs(runs, _changes(spark, sf_dir, "W"), _clock())
    return _as_text(changed, "jobs_start_dt", "jobs_end_dt")


@query
def status_end(spark, sf_dir):
    """Ends written as the next snapshot of the table that was read."""
    path = fresh_folder(spark, "jobs_execution")
    runs = _timed_runs(spark, sf_dir, "jobs_status", "jobs_start_dt", "jobs_end_dt")
    sinks.write_snapshot(runs, path)
    changes = _changes(spark, sf_dir, "S")
    sinks.update_snapshot(spark, path, lambda now: metastore.end_jobs(now, changes, _clock()))
    return _as_text(lake.read_snapshot(spark, path), "jobs_start_dt", "jobs_end_dt")


@query
def process_status(spark, sf_dir):
    runs = _timed_runs(spark, sf_dir, "status", "process_start_dt", "process_end_dt")
    changes = _changes(spark, sf_dir, "S")
    started = metastore.start_processes(runs, changes.filter("seq = 1"), _clock())
    ended = metastore.end_processes(started, changes.filter("seq = 2"), _clock())
    return _as_text(ended, "process_start_dt", "process_end_dt")


# Audit

def _step_cells(spark, sf_dir):
    """Per order the answer of a procedure: no step, or an extract and a load step."""
    order = table(spark, sf_dir, "orders")
    entity = F.concat(F.lit("customer "), F.col("o_custkey"))
    start = utc_text(F.col("o_orderdate"))
    end = utc_text(F.col("o_orderdate") + F.expr("interval 90 seconds"))
    state = F.when(F.col("o_orderpriority") == "1-URGENT", "Failed: late").otherwise("Success")
    both = F.to_json(F.array(
        F.array(entity, F.lit("extract"), start, end, F.lit("Success"), F.lit(None).cast("string")),
        F.array(entity, F.lit("load"), end, end, state,
                F.concat(F.lit('says "'), "o_orderpriority", F.lit('"')))),
        {"ignoreNullFields": "false"})
    cell = F.when(F.col("o_orderstatus") == "P", "[]").otherwise(both)
    return order.select("o_orderkey", cell.alias("cell"))


@query
def step_rows(spark, sf_dir):
    return audit.order_steps(audit.parse_step_cells(_step_cells(spark, sf_dir), "cell", "o_orderkey"))


@query
def step_failures(spark, sf_dir):
    return audit.any_failed(audit.parse_step_cells(_step_cells(spark, sf_dir), "cell"), "entity")


@query
def first_steps(spark, sf_dir):
    """First cell of the answers in order of their keys, as rows."""
    first = _step_cells(spark, sf_dir).filter("cell != '[]'").orderBy("o_orderkey").limit(1)
    return audit.parse_step_cells(first, "cell")


@query
def status_fold(spark, sf_dir):
    """Run status from per-entity flags of two sub-steps; an unknown flag is a failure."""
    runs = metadata(spark, sf_dir, "runs")
    loads = runs.select("process_execution_id", "jobs_id", (F.col("jobs_status") != "F").alias("ok"))
    layer = runs.select("process_execution_id", "jobs_id",
                        F.when(F.col("id") % 7 != 0, True).alias("ok"))
    return audit.fold_status(audit.union_steps(loads, layer), "process_execution_id", "jobs_id")


@query
def job_status_fold(spark, sf_dir):
    runs = metadata(spark, sf_dir, "runs")
    flags = runs.select("jobs_id", F.when(F.col("jobs_status") != "I", F.col("jobs_status") == "S")
                        .alias("ok"))
    return audit.fold_status(flags, "jobs_id")


# Loads, purges, failures

@query
def bulk_load(spark, sf_dir):
    """Loaded once although both truncate and insert are set, over older rows."""
    df, name = table(spark, sf_dir, "documents"), _new_table("documents")
    path = fresh_folder(spark, "bulk-table")
    sinks.bulk_load(df, name, path=path, create=True)
    sinks.bulk_load(df, name, truncate=True, insert=True)
    return spark.table(name)


@query
def empty_like(spark, sf_dir):
    name = _new_table("supplier")
    sinks.create_empty(table(spark, sf_dir, "supplier"), name, fresh_folder(spark, "empty"))
    return spark.table(name)


@query
def purge_sources(spark, sf_dir):
    """What is left of each entity after a load; a file that came meanwhile survives."""
    prefix = write_tree(spark, sf_dir)
    late = events(spark, sf_dir).agg(F.max("event_id").alias("event_id"))
    left = []
    for entity in layers.entity_names(entity_files(spark, prefix)):
        folder = join_path(prefix, entity)
        landing = read_landing(spark, folder, "json")
        late.write.mode("append").json(folder)
        sinks.purge_files(spark, landing.files)
        rows = read_landing(spark, folder, "json").rows
        left.append(rows.select(F.lit(entity).alias("entity"), "event_id"))
    return audit.union_steps(*left)


@query
def late_arrival(spark, sf_dir):
    """A file that comes while a folder is read waits, whole, for the next load."""
    folder, root = join_path(write_tree(spark, sf_dir), "view"), fresh_folder(spark, "late")
    name = _new_table("late")

    def load(landing) -> None:
        outcome = ingest.ingest_entity(spark, "view", folder, name, join_path(root, "lake"),
                                       join_path(root, "error"), landing=landing)
        if not outcome.ok:
            raise RuntimeError(outcome.steps[-1].description)
        sinks.purge_files(spark, outcome.files)

    before = read_landing(spark, folder, "json")
    (events(spark, sf_dir).filter(F.col("event_type") != "view")
     .select("event_id", F.upper("event_type").alias("fresh")).write.mode("append").json(folder))
    load(before)
    load(read_landing(spark, folder, "json"))
    return spark.table(name).select("event_id", "fresh")


@query
def insert_rows(spark, sf_dir):
    """Suppliers appended by column name in two parts, the second with its columns reversed."""
    df, name = table(spark, sf_dir, "supplier"), _new_table("supplier")
    sinks.insert_rows(df.filter("s_acctbal < 0"), name)
    rest = df.filter("not s_acctbal < 0 or s_acctbal is null")
    sinks.insert_rows(rest.select(*reversed(rest.columns)), name)
    return spark.table(name)


class _Refused(Exception):
    pass


def _refuse(_published) -> None:
    raise _Refused


@query
def staged_publish(spark, sf_dir):
    """An overwrite that fails before it is registered leaves the table as it was."""
    df = _by_day(spark, sf_dir)
    name, path = _lake(spark, (df, "append"))
    try:
        publish(df.filter("day > 15").withColumn("value", F.lit(0.0)), name, path,
                mode="overwrite", partition_cols=DAY_PARTS, before_commit=_refuse)
    except _Refused:
        pass
    return _event_text(spark.table(name))


@query
def swap_overwrite(spark, sf_dir):
    """Rows a reader gets before and after each overwrite moves the table to its new folder."""
    df, seen = _by_day(spark, sf_dir), []
    name, path = _lake(spark, (df, "append"))

    def look(published) -> None:
        seen.append(spark.table(published.table).count())

    for first in (5, 10, 15):
        publish(df.filter(F.col("day") > first), name, path, mode="overwrite",
                partition_cols=DAY_PARTS, before_commit=look, check=look)
    return spark.createDataFrame(
        [(i, *seen[2 * i:2 * i + 2]) for i in range(3)],
        "overwrite bigint, before bigint, after bigint")


@query
def journal_undo(spark, sf_dir):
    """Columns and partitions after an append, a dynamic load and an overwrite that fail when
    they are registered: those of the load before."""
    df = _by_day(spark, sf_dir)
    name, path = _lake(spark, (df.filter("day <= 20"), "append"))
    for mode in ("append", "dynamic", "overwrite"):
        try:
            publish(df.filter("day > 18").withColumn("fresh", F.lit(mode)), name, path, mode=mode,
                    partition_cols=DAY_PARTS, check=_refuse)
        except _Refused:
            pass
    columns = spark.createDataFrame([(c,) for c in spark.table(name).columns], "name string")
    days = spark.table(name).groupBy("day").agg(F.count(F.lit(1)).alias("records"))
    return audit.union_steps(
        columns.select(F.lit("column").alias("kind"), "name"),
        spark.sql(f"show partitions {name}").select(F.lit("partition").alias("kind"),
                                                    F.col("partition").alias("name")),
        days.select(F.lit("rows").alias("kind"), F.concat_ws(": ", "day", "records").alias("name")))


# Whole dataflows

HOURLY = ingest.LoadOptions(partition_cols=TIME_PARTS, base_column="ts")
DAILY = ingest.LoadOptions(partition_cols=tuple(DAY_PARTS), base_column="ts")


class _Run:
    """One ingest of the entities of a landing prefix but one, with its tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        root, tag = fresh_folder(spark, "run"), uuid.uuid4().hex
        self.spark, self.landing = spark, write_tree(spark, sf_dir)
        self.records, self.errors = join_path(root, "records"), join_path(root, "error")
        self.lake, self.tag = join_path(root, "lake"), tag
        self.recorder = ingest.Recorder(self.records)
        self.outcomes = ingest.ingest_all(
            spark, self.landing, self.lake, self.errors, self.recorder, run_id=11,
            job_run_id=21, options=DAILY, exclude=["signup"], table_name=self.table_name)

    def table_name(self, entity: str) -> str:
        return f"{clean_name(entity)}_{self.tag}"

    def record(self, name: str) -> DataFrame:
        return lake.read_appended(self.spark, join_path(self.records, name))

    def loaded(self) -> list[str]:
        return layers.entity_names(self.record("entity_process_execution_mapping"))

    def rows(self) -> DataFrame:
        parts = [self.spark.table(self.table_name(e)).withColumn("entity", F.lit(e))
                 for e in self.loaded()]
        return audit.union_steps(*parts)


def _run(spark: SparkSession, sf_dir: str) -> _Run:
    """The run that the queries below look at from several sides; once per session."""
    return _run_of(spark.sparkContext.applicationId, sf_dir)


@lru_cache(maxsize=None)
def _run_of(_session: str, sf_dir: str) -> _Run:
    return _Run(SparkSession.active(), sf_dir)


@query
def ingest_all(spark, sf_dir):
    """Rows of all entity tables after a run; one entity is excluded, one wholly broken."""
    run = _run(spark, sf_dir)
    return run.rows().select(
        "entity", "event_id", utc_text(F.col("ts")).alias("ts"), "user_id", "evenement_type",
        F.col("value").cast("string").alias("value"), "props", "process_execution_id", *TIME_PARTS)


@query
def ingest_audit(spark, sf_dir):
    """Audit steps of the run, without their times."""
    run = _run(spark, sf_dir)
    own = run.record("jobs_execution_detail").filter("jobs_execution_id = 21")
    return own.select(
        "entity", "step", "status", "records_cnt", "reject_records_cnt", "description",
        F.col("jobs_execution_id").cast("bigint").alias("jobs_execution_id"),
        (F.col("start_dt") <= F.col("end_dt")).alias("in_order"))


@query
def ingest_schema_rows(spark, sf_dir):
    return _bigints(_run(spark, sf_dir).record("entity_schema_details"), "process_execution_id")


@query
def ingest_rejects(spark, sf_dir):
    """Rejects of the run by entity, from the files under the error prefix."""
    found = lake.read_rejects(spark, _run(spark, sf_dir).errors).withColumn(
        "entity", F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1))
    return found.groupBy("entity", tables.RUN_ID).agg(
        F.count(CORRUPT_RECORD).alias("rejects"),
        F.sum(F.length(CORRUPT_RECORD)).alias("characters"))


@query
def ingest_status(spark, sf_dir):
    """Flag per entity, the status of the run, and what is left in the landing folders."""
    run = _run(spark, sf_dir)
    flags = ingest.status_frame(spark, [(o.entity, o.ok) for o in run.outcomes])
    left = entity_files(spark, run.landing).select("entity", "files")
    return flags.join(left, "entity", "left").select(
        "entity", "ok", F.lit(ingest.run_status(flags)).alias("run_ok"),
        F.coalesce("files", F.lit(0).cast("bigint")).alias("files_left"))


@query
def curated_layer(spark, sf_dir):
    """Users per entity and day, refreshed for the entities the run has loaded."""
    run = _run(spark, sf_dir)
    path, name = fresh_folder(spark, "curated"), lambda e: f"curated_{run.table_name(e)}"
    layers.refresh_curated(
        spark, run.record("entity_process_execution_mapping"), 11,
        source=lambda e: spark.table(run.table_name(e)), table_name=name, path=path,
        transform=lambda df: df.groupBy("evenement_type", "month", "day").agg(
            F.count(F.lit(1)).alias("records"), F.countDistinct("user_id").alias("users")),
        recorder=ingest.Recorder(fresh_folder(spark, "records")), job_run_id=22, partition_cols=["month"])
    return audit.union_steps(*[spark.table(name(e)) for e in run.loaded()])


def _timeline(spark, sf_dir, layer: str, transform):
    """Orders by status as entities, of which those with narrations and fields are enabled."""
    order = table(spark, sf_dir, "orders")
    entities = order.select(F.col("o_orderstatus").alias("entity"),
                            F.when(F.col("o_orderstatus") == "P", "Disabled")
                            .otherwise("Enabled").alias("status"))
    names = order.select(F.col("o_orderstatus").alias("entity"))
    recorder = ingest.Recorder(fresh_folder(spark, "records"))
    path, tag = fresh_folder(spark, layer), uuid.uuid4().hex
    flags = layers.refresh_timeline(
        spark, entities, names, names, layer_name=layer,
        source=lambda e: order.filter(F.col("o_orderstatus") == e),
        table_name=lambda e: f"{layer}_{clean_name(e)}_{tag}", path=path, transform=transform,
        recorder=recorder, job_run_id=23)
    done = [row.entity for row in flags.filter("ok").collect()]
    return audit.union_steps(*[spark.table(f"{layer}_{clean_name(e)}_{tag}")
                               .withColumn("entity", F.lit(e)) for e in sorted(done)])


@query
def timeline_layer(spark, sf_dir):
    return _timeline(spark, sf_dir, "timeline", lambda df: df.groupBy(
        F.col("o_custkey").alias("customer")).agg(
            F.count(F.lit(1)).alias("orders"), utc_text(F.min("o_orderdate")).alias("first_order")))


@query
def container_timeline_layer(spark, sf_dir):
    return _timeline(spark, sf_dir, "container_timeline", lambda df: df.groupBy(
        F.col("o_orderpriority").alias("priority")).agg(
            F.count(F.lit(1)).alias("orders"), utc_text(F.max("o_orderdate")).alias("last_order")))


@query
def procedure_layer(spark, sf_dir):
    """Per-entity calls that answer with a step cell; failures are recorded, then reported, and
    an answer that cannot be read is a failure without steps."""
    order, path = table(spark, sf_dir, "orders"), fresh_folder(spark, "records")

    def call(entity: str) -> DataFrame:
        counted = order.filter(F.col("o_orderpriority") == entity).agg(F.count(F.lit(1)).alias("n"))
        state = F.lit("Failed" if entity.startswith("1") else "Success")
        step = F.array(F.lit(entity), F.lit("count"), F.lit(CLOCK), F.lit(CLOCK), state,
                       F.col("n").cast("string"))
        answer = F.to_json(F.array(step))
        if entity.startswith("4"):
            answer = F.substring(answer, F.lit(1), (F.length(answer) - 2).cast("int"))  # cut off
        return counted.select((F.lit(None).cast("string") if entity.startswith("5") else answer)
                              .alias("answer"))

    names = layers.entity_names(order.select(F.col("o_orderpriority").alias("entity")).distinct())
    flags = layers.refresh_by_call(spark, names, call, ingest.Recorder(path), job_run_id=24)
    steps = lake.read_appended(spark, join_path(path, "jobs_execution_detail"))
    return flags.join(steps, "entity", "left").select("entity", "ok", "step", "status", "description")


EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", StringType()),
    StructField("userID", LongType()), StructField("Événement type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType())])


@query
def incremental(spark, sf_dir):
    """Two arrivals, three starts: the files of each arrival are loaded once."""
    arrivals, path = write_tree(spark, sf_dir), fresh_folder(spark, "incremental")
    landing, name = fresh_folder(spark, "inbox"), _new_table("inbox")
    storage = Storage(spark, landing)
    options = ingest.LoadOptions(schema=EVENT_SCHEMA, base_column="ts",
                                 partition_cols=("year", "month", "day"))

    def arrive(entities: list[str]) -> None:
        for entity in entities:
            for file, _ in storage.children(join_path(arrivals, entity)):
                storage.rename(file, join_path(landing, f"{entity}-{file.rsplit('/', 1)[-1]}"))

    def start() -> None:
        ingest_new_files(spark, "inbox", landing, name, join_path(path, "lake"),
                         join_path(path, "error"), join_path(path, "checkpoint"), 31, options)

    storage.make_folder(landing)
    arrive(["view", "error"])
    start()
    arrive(["click", "purchase", "signup"])
    start()
    start()
    return _inbox_rows(spark.table(name))


def _inbox_rows(df: DataFrame) -> DataFrame:
    return df.select("event_id", utc_text(F.col("ts")).alias("ts"), "user_id", "evenement_type",
                     F.col("value").cast("string").alias("value"), "props")


@query
def incremental_nested(spark, sf_dir):
    """Files in sub-folders, one level of which is a column: the stream, in two arrivals and three
    starts, and a batch load of the same tree."""
    arrivals, path = write_tree(spark, sf_dir), fresh_folder(spark, "nested")
    landing, tag = fresh_folder(spark, "inbox"), uuid.uuid4().hex
    storage = Storage(spark, landing)
    options = ingest.LoadOptions(schema=EVENT_SCHEMA, base_column="ts",
                                 partition_cols=("year", "month", "day"))

    def start(arrival: str, entities: list[str]) -> None:
        for entity in entities:
            folder = join_path(landing, f"arrival={arrival}", entity, "deep er+")
            storage.make_folder(folder)
            for file, _ in storage.children(join_path(arrivals, entity)):
                storage.rename(file, join_path(folder, file.rsplit("/", 1)[-1]))
        found = ingest_new_files(spark, "inbox", landing, f"stream_{tag}", join_path(path, "a"),
                                 join_path(path, "error"), join_path(path, "checkpoint"), 31,
                                 options)
        if not all(o.ok for o in found):
            raise RuntimeError(found[-1].steps[-1].description)

    storage.make_folder(landing)
    start("first", ["view", "error"])
    start("second", ["click", "purchase", "signup"])
    start("none", [])
    done = ingest.ingest_entity(spark, "inbox", landing, f"batch_{tag}", join_path(path, "b"),
                                join_path(path, "error"), 32, options)
    if not done.ok:
        raise RuntimeError(done.steps[-1].description)
    return audit.union_steps(*[
        _inbox_rows(spark.table(f"{how}_{tag}")).withColumn("how", F.lit(how)).join(
            spark.table(f"{how}_{tag}").select("event_id", "arrival"), "event_id")
        for how in ("stream", "batch")])


@query
def ledger_reload(spark, sf_dir):
    """Two arrivals in a folder that is not purged, and four loads of it: each file is loaded
    once, and the last load, which purges, finds nothing new."""
    arrivals, path = write_tree(spark, sf_dir), fresh_folder(spark, "ledger")
    landing, name = fresh_folder(spark, "inbox"), _new_table("ledger")
    storage, recorder = Storage(spark, landing), ingest.Recorder(join_path(path, "records"))
    options = ingest.LoadOptions(schema=EVENT_SCHEMA, base_column="ts",
                                 partition_cols=("year", "month", "day"))

    def load(entities: list[str], purge: bool = False) -> None:
        storage.make_folder(landing)
        for entity in entities:
            for file, _ in storage.children(join_path(arrivals, entity)):
                storage.rename(file, join_path(landing, f"{entity}-{file.rsplit('/', 1)[-1]}"))
        outcome = ingest.refresh_entity(
            spark, "inbox", landing, name, join_path(path, "lake"), join_path(path, "error"),
            recorder, 51, 52, options, purge=purge, once=True)
        if not outcome.ok:
            raise RuntimeError(outcome.steps[-1].description)

    load(["view", "error"])
    load([])
    load(["click", "purchase", "signup"])
    load([], purge=True)
    if storage.children(landing):
        raise RuntimeError("files are left")
    return _inbox_rows(spark.table(name))


@query
def incremental_all(spark, sf_dir):
    """All entities of a prefix in two arrivals, then the curated layer of what the run loaded."""
    arrivals, root = write_tree(spark, sf_dir), fresh_folder(spark, "incremental")
    landing, tag = fresh_folder(spark, "inbox"), uuid.uuid4().hex
    storage, recorder = Storage(spark, landing), ingest.Recorder(join_path(root, "records"))
    options = ingest.LoadOptions(schema=EVENT_SCHEMA, base_column="ts",
                                 partition_cols=("year", "month", "day"))
    name = lambda e: f"new_{clean_name(e)}_{tag}"
    files = [(e, file) for e, _ in storage.children(arrivals) for file, _ in storage.children(e)]
    for arrival in (0, 1):
        for folder, file in files[arrival::2]:
            target = join_path(landing, folder.rstrip("/").rsplit("/", 1)[-1])
            storage.make_folder(target)
            storage.rename(file, join_path(target, file.rsplit("/", 1)[-1]))
        ingest_new_all(spark, landing, join_path(root, "lake"), join_path(root, "error"),
                       join_path(root, "checkpoint"), recorder, 41, 42, options,
                       exclude=["signup"], table_name=name)
    mapping = lake.read_appended(spark, join_path(root, "records",
                                                  "entity_process_execution_mapping"))
    curated = lambda e: f"curated_{name(e)}"
    flags = layers.refresh_curated(
        spark, mapping, 41, source=lambda e: spark.table(name(e)), table_name=curated,
        transform=lambda df: df.groupBy("evenement_type", "month", "day").agg(
            F.count(F.lit(1)).alias("records"), F.countDistinct("user_id").alias("users")),
        path=join_path(root, "curated"), recorder=recorder, job_run_id=43,
        partition_cols=["month"])
    return audit.union_steps(*[spark.table(curated(r.entity))
                               for r in flags.filter("ok").orderBy("entity").collect()])


@query
def flagship(spark, sf_dir):
    """The whole path: JSON lines to a registered lake table, read back per day."""
    root, name = fresh_folder(spark, "flagship"), _new_table("events")
    outcome = ingest.ingest_entity(
        spark, "events", landing_folder(spark, sf_dir), name, join_path(root, "lake"),
        join_path(root, "error"), run_id=1, options=HOURLY)
    if not outcome.ok:
        raise RuntimeError(outcome.steps[-1].description)
    return (spark.table(name).filter("year is not null").groupBy("year", "month", "day")
            .agg(F.count(F.lit(1)).alias("records"), F.countDistinct("user_id").alias("users"),
                 F.sum("value").cast("string").alias("total_value")))
