"""Layers over the lake: one refresh per entity, with the user's own transform.

The same refresh serves the curated layer (entities a run has loaded) and the timeline
layers (enabled entities); they differ in the list of entities and in the transform.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.errors import StepFailed
from landinglake.functions.quoting import quoted
from landinglake.operators.audit import (FAILED, Step, is_failed, is_unreadable, order_steps,
                                         parse_step_cells, step_frame)
from landinglake.operators.metastore import run_entities, timeline_entities
from landinglake.plans.ingest import (PARALLEL_ENTITIES, Recorder, for_each_entity, status_frame)
from landinglake.plans.publish import publish
from landinglake.storage import join_path

log = logging.getLogger(__name__)


def entity_names(entities: DataFrame) -> list[str]:
    """The entity list of a run; as short as the list of tables."""
    return sorted(row.entity for row in entities.select("entity").collect())


def refresh_layer(spark: SparkSession, entities: Iterable[str], layer: str,
                  source: Callable[[str], DataFrame],
                  transform: Callable[[DataFrame], DataFrame],
                  table_name: Callable[[str], str], path: str, recorder: Recorder,
                  job_run_id: int, mode: str = "overwrite",
                  partition_cols: list[str] | None = None,
                  parallel: int = PARALLEL_ENTITIES) -> DataFrame:
    """Run ``transform`` over each entity's rows and publish the result as a layer table.

    Returns (entity, ok). Audit steps are stored for failed entities as well.
    """
    def refresh(entity: str) -> tuple[str, bool]:
        step, steps, ok = Step.start(entity, layer), [], True
        try:
            published = publish(transform(source(entity)), table_name(entity),
                                join_path(path, entity), mode=mode, entity=entity,
                                partition_cols=partition_cols)
            step.records_cnt = published.rows
            steps = [*published.steps, step.end()]
        except Exception as error:
            log.exception("%s: refresh of %s failed", entity, layer)
            steps, ok = [*steps, step.end(FAILED, str(error))], False
        try:
            recorder.steps(order_steps(step_frame(spark, steps, job_run_id)))
        except Exception:
            log.exception("%s: recording failed", entity)
            ok = False
        return entity, ok

    return status_frame(spark, for_each_entity(spark, entities, refresh, parallel))


def refresh_by_call(spark: SparkSession, entities: Iterable[str],
                    call: Callable[[str], DataFrame], recorder: Recorder, job_run_id: int,
                    parallel: int = PARALLEL_ENTITIES) -> DataFrame:
    """Run a procedure per entity that answers with a step-result cell.

    ``call`` returns the rows of the answer, its first cell holds the steps. They are
    stored first, then a failed step fails the entity, and so does an answer without a row or
    with a cell that is no list of steps; an empty list is success.
    """
    def refresh(entity: str) -> tuple[str, bool]:
        try:
            answer = call(entity)
            # One cell; kept as it is, so that the procedure runs only once.
            cells = answer.select(F.col(quoted(answer.columns[0])).cast("string")).take(1)
            cell = spark.createDataFrame(cells or [(None,)], "cell string")
            steps = parse_step_cells(cell, "cell").withColumn(
                "jobs_execution_id", F.lit(job_run_id).cast("int"))
            rows = order_steps(steps).collect()
            if rows:
                kept = spark.createDataFrame(rows, steps.schema)
                recorder.steps(kept)
                if not kept.filter(is_failed()).isEmpty():
                    raise StepFailed(f"{entity}: a step has failed")
            if not cell.filter(is_unreadable("cell")).isEmpty():
                raise StepFailed(f"{entity}: the answer cannot be read")
        except Exception:
            log.exception("%s: call failed", entity)
            return entity, False
        return entity, True

    return status_frame(spark, for_each_entity(spark, entities, refresh, parallel))


def refresh_curated(spark: SparkSession, mapping: DataFrame, run_id: int, **layer) -> DataFrame:
    """Curated layer: the entities that the run has loaded."""
    return refresh_layer(spark, entity_names(run_entities(mapping, run_id)), "curated", **layer)


def refresh_timeline(spark: SparkSession, entities: DataFrame, narrations: DataFrame,
                     fields: DataFrame, layer_name: str = "timeline", **layer) -> DataFrame:
    """Timeline layer, or with another name and transform the container timeline."""
    names = entity_names(timeline_entities(entities, narrations, fields))
    return refresh_layer(spark, names, layer_name, **layer)
