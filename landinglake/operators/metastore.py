"""Queries and updates over the job metadata tables.

Each function takes the tables as DataFrames, so they may be lake files or JDBC scans.
Column names follow the metadata schema, its spelling (``subsriber_id``) included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.operators.joins import skew_join
from landinglake.sources.lake import query_rows

# Run states.
READY, IN_PROGRESS, DONE, BROKEN = "R", "I", "S", "F"

# Who signs an update unless the caller says so.
UPDATED_BY = "landinglake"


def latest_status(runs: DataFrame, run_id: int | None = None) -> DataFrame:
    """Status of the newest run record of each job, of one process run if given.

    An aggregate, not a window: each task sends one row per job, so a job with very many
    records does not load one task.
    """
    if run_id is not None:
        runs = runs.filter(F.col("process_execution_id") == run_id)
    newest = F.max(F.struct("id", "jobs_status"))
    return (runs.groupBy("jobs_id").agg(newest.alias("newest"))
            .select("jobs_id", F.col("newest.jobs_status").alias("job_status")))


def parent_states(edges: DataFrame, latest: DataFrame) -> DataFrame:
    """Per job, how many parents have a status, and how many are in each state."""
    states = latest.select(F.col("jobs_id").alias("parent_jobs_id"),
                           F.col("job_status").alias("parent_status"))
    status = F.col("parent_status")
    # Most edges may hang on one parent, or have none.
    return (skew_join(edges.select("jobs_id", "parent_jobs_id"), states, "parent_jobs_id", "left")
            .groupBy("jobs_id").agg(
                F.count(status).alias("parent_jobs_total_count"),
                F.count_if(status == DONE).alias("parent_jobs_success_count"),
                F.count_if(status == BROKEN).alias("parent_jobs_failed_count"),
                F.count_if(status == READY).alias("parent_jobs_ready_count"),
                F.count_if(status == IN_PROGRESS).alias("parent_jobs_inprogess_count")))


def ready_jobs(runs: DataFrame, jobs: DataFrame, classes: DataFrame, edges: DataFrame,
               run_id: int | None = None, own_run_only: bool = False) -> DataFrame:
    """Runs in state R with the states of their jobs' parents.

    ``run_id`` restricts the parents; the ready runs too only with ``own_run_only``.

    Parents are counted per job before they meet the runs, so the join does not multiply
    runs by edges. Equal run records are folded before it (``n``), which leaves the join
    last in the plan, where a job with very many runs can be split.
    """
    parents = parent_states(edges, latest_status(runs, run_id))
    named = (jobs.select(F.col("id").alias("job_id"), F.col("name").alias("job_name"),
                         F.col("jobs_execution_class_id").alias("class_id"))
             .join(classes.select(F.col("id").alias("class_id"),
                                  F.col("name").alias("execution_class")), "class_id")
             .groupBy("job_id", "job_name", "execution_class")
             .agg(F.count(F.lit(1)).alias("job_n")))
    ready = runs.filter(F.col("jobs_status") == READY)
    if own_run_only:
        ready = ready.filter(F.col("process_execution_id") == run_id)
    ready = (ready.groupBy(F.col("id").alias("job_execution_id"), "process_execution_id",
                           F.col("jobs_id").alias("job_id"),
                           F.col("jobs_status").alias("job_status"))
             .agg(F.count(F.lit(1)).alias("n")))
    counts = [c for c in parents.columns if c != "jobs_id"]
    described = named.join(parents.withColumnRenamed("jobs_id", "job_id"), "job_id")
    return skew_join(ready, described, "job_id").select(
        "job_execution_id", "process_execution_id", "job_id", "job_name", "execution_class",
        "job_status", *[(F.col(c) * F.col("n") * F.col("job_n")).alias(c) for c in counts])


def job_params(jobs: DataFrame, classes: DataFrame, class_params: DataFrame, edges: DataFrame,
               processes: DataFrame, subscribers: DataFrame, applications: DataFrame,
               job_values: DataFrame, process_id: int | None = None) -> DataFrame:
    """Parameters of the jobs of a process: the job's value, else the default, placeholders filled.

    Without ``process_id`` all processes are resolved, with their id as a further column.
    """
    members = edges.select("process_id", "jobs_id")
    if process_id is not None:
        members = members.filter(F.col("process_id") == process_id)
        processes = processes.filter(F.col("id") == process_id)
    owners = (processes.select(F.col("id").alias("process_id"), F.col("subsriber_id"),
                               F.col("applications_id"))
              .join(subscribers.select(F.col("id").alias("subsriber_id"),
                                       F.col("name").alias("subscriber")), "subsriber_id")
              .join(applications.select(F.col("id").alias("applications_id"),
                                        F.col("name").alias("application")), "applications_id"))
    known = classes.select(F.col("id").alias("jobs_execution_class_id")).distinct()
    params = (class_params.join(known, "jobs_execution_class_id", "left_semi")
              .select(F.col("id").alias("param_id"), "jobs_execution_class_id",
                      F.lower("name").alias("param_key"), "default_param_value", "is_mandatory"))
    owned = (members.distinct()
             .join(jobs.select(F.col("id").alias("jobs_id"), F.col("name").alias("job_name"),
                               "jobs_execution_class_id"), "jobs_id")
             .join(owners.select("process_id", "subscriber", "application"), "process_id"))
    own_values = job_values.select(
        "jobs_id", F.col("jobs_execution_class_param_id").alias("param_id"), "param_value")
    raw = F.coalesce("param_value", "default_param_value")
    value = F.replace(F.replace(raw, F.lit("<application>"), F.col("application")),
                      F.lit("<subscriber>"), F.col("subscriber"))
    resolved = (skew_join(owned, params, "jobs_execution_class_id")
                .join(own_values, ["jobs_id", "param_id"], "left")
                .select("process_id", F.col("jobs_id").alias("job_id"), "job_name", "param_key",
                        value.alias("param_value"), "is_mandatory"))
    return (resolved if process_id is None else resolved.drop("process_id")).distinct()


def run_entities(mapping: DataFrame, run_id: int) -> DataFrame:
    """Entities a process run has loaded."""
    return query_rows(
        mapping.sparkSession,
        "select distinct entity from {mapping} where process_execution_id = :run_id",
        {"run_id": run_id}, mapping=mapping)


def entity_mapping(spark: SparkSession, run_id: int, entity: str) -> DataFrame:
    """The row that records that a run has loaded an entity."""
    return spark.createDataFrame([(run_id, entity)], "process_execution_id int, entity string")


def timeline_entities(entities: DataFrame, narrations: DataFrame, fields: DataFrame) -> DataFrame:
    """Enabled entities that have both narrations and fields.

    Semi joins: the other tables only have to contain the entity, their rows do not multiply.
    Each side is reduced to its entities first, in the tasks that read it, so that the many
    rows of one entity are not sent to one task.
    """
    enabled = entities.filter(F.col("status") == "Enabled").select("entity").distinct()
    return (enabled.join(narrations.select("entity").distinct(), "entity", "left_semi")
            .join(fields.select("entity").distinct(), "entity", "left_semi"))


def _updates(changes: DataFrame) -> DataFrame:
    """Last change per id, where ``seq`` orders the changes."""
    return (changes.groupBy("id").agg(F.max(F.struct("seq", "status")).alias("last"))
            .select("id", F.col("last.status").alias("new_status"), F.lit(True).alias("changed")))


def _change_status(rows: DataFrame, changes: DataFrame, status: str, time_column: str,
                   now: Column | None, updated_by: str) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    changed = F.coalesce(F.col("changed"), F.lit(False))
    fresh = {status: F.col("new_status"), time_column: now, "updated_dt": now,
             "updated_by": F.lit(updated_by)}
    joined = skew_join(rows, _updates(changes), "id", "left")
    return joined.select(*[
        F.when(changed, fresh[c]).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c)
        for c in rows.columns])


def start_jobs(runs: DataFrame, changes: DataFrame, now: Column | None = None,
               updated_by: str = UPDATED_BY) -> DataFrame:
    """Job runs after ``changes`` (id, seq, status) that set the start time."""
    return _change_status(runs, changes, "jobs_status", "jobs_start_dt", now, updated_by)


def end_jobs(runs: DataFrame, changes: DataFrame, now: Column | None = None,
             updated_by: str = UPDATED_BY) -> DataFrame:
    """The same for changes that set the end time."""
    return _change_status(runs, changes, "jobs_status", "jobs_end_dt", now, updated_by)


def start_processes(runs: DataFrame, changes: DataFrame, now: Column | None = None,
                    updated_by: str = UPDATED_BY) -> DataFrame:
    return _change_status(runs, changes, "status", "process_start_dt", now, updated_by)


def end_processes(runs: DataFrame, changes: DataFrame, now: Column | None = None,
                  updated_by: str = UPDATED_BY) -> DataFrame:
    return _change_status(runs, changes, "status", "process_end_dt", now, updated_by)
