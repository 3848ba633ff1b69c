"""What Spark is asked to do: scans, shuffles, skew."""

import contextlib

import pytest
from pyspark.sql import functions as F

from landinglake.operators import audit, metastore, quality
from landinglake.operators.joins import skew_join
from landinglake.operators.partitions import partition_values
from landinglake.plans.ingest import stage
from landinglake.plans.publish import publish
from landinglake.registry import QUERIES
from landinglake.registry.fixtures import landing_folder, metadata, table
from landinglake.sources.landing import read_landing


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@contextlib.contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SMALL_PARTS = {"spark__sql__autoBroadcastJoinThreshold": "-1",
               "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
               "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
               "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2"}

METADATA_QUERIES = ("job_params", "latest_status", "ready_jobs", "timeline_entities",
                    "status_start", "step_failures", "status_fold")


@pytest.mark.parametrize("name", METADATA_QUERIES)
def test_metadata_queries_avoid_costly_operators(spark, sf_dir, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name](spark, sf_dir))
    for word in ("Window", "Cartesian", "NestedLoop", "SinglePartition", "Python"):
        assert word not in text


def test_values_stay_in_the_jvm(spark, sf_dir):
    for name in ("sanitize_values", "parse_time", "align_schema", "time_partitions"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "Exchange" not in text


def test_profile_is_one_pass(spark, sf_dir):
    text = plan(quality.column_profile(table(spark, sf_dir, "lineitem")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "partial_count" in text


def test_rejects_read_one_staged_column(spark, sf_dir):
    staged = stage(read_landing(spark, landing_folder(spark, sf_dir), "json"), run_id=1)
    text = plan(quality.rejected_rows(staged.rows))
    assert "PushedFilters: [IsNotNull(_corrupt_record)], ReadSchema: struct<_corrupt_record:string>" in text


def test_partition_tuples_read_the_base_column_only(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan(partition_values(df, ["day"]))


def test_lake_reads_are_pruned(spark, sf_dir, folder, new_table):
    df = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    publish(df, new_table, folder, partition_cols=["day"])
    text = plan(spark.table(new_table).filter("day = 3").groupBy("event_type").count())
    assert "PartitionFilters: [isnotnull(day" in text and "ReadSchema: struct<event_type:string>" in text


def test_filter_on_the_run_reaches_the_scan(spark, folder, sf_dir):
    metadata(spark, sf_dir, "runs").write.parquet(folder + "/runs")
    text = plan(metastore.latest_status(spark.read.parquet(folder + "/runs"), 3))
    assert "EqualTo(process_execution_id,3)" in text
    assert "ReadSchema: struct<id:bigint,process_execution_id:bigint,jobs_id:bigint,jobs_status:string>" in text


def hot(spark, rows, column, value, keys):
    return spark.range(0, rows, 1, 8).withColumn(
        column, F.when(F.col("id") % 3 == 0, F.lit(value).cast("bigint")).otherwise(F.col("id") % keys))


@pytest.mark.parametrize("how, value", [("inner", 7), ("left", 7), ("left", None)])
def test_skew_join_splits_a_hot_key(spark, how, value):
    left = hot(spark, 200_000, "k", value, 1000)
    right = spark.range(0, 50_000, 1, 8).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
    with settings(spark, **SMALL_PARTS):
        joined = skew_join(left, right, "k", how)
        text = final_plan(joined)
        rows = joined.count()
    assert "skew=true" in text
    expected = left.join(right, "k", how).count()
    assert rows == expected and joined.columns == ["k", "id", "s"]


def test_ready_jobs_split_a_hot_job(spark):
    runs = hot(spark, 150_000, "jobs_id", 7, 500).withColumns(
        {"process_execution_id": F.lit(1), "jobs_status": F.lit("R")})
    jobs = spark.range(500).selectExpr("id", "concat('job ', id) name", "id % 5 jobs_execution_class_id")
    classes = spark.range(5).selectExpr("id", "'c' name")
    edges = hot(spark, 100_000, "parent_jobs_id", 7, 500).selectExpr("id % 500 jobs_id", "parent_jobs_id")
    with settings(spark, **SMALL_PARTS):
        ready = metastore.ready_jobs(runs, jobs, classes, edges)
        text = final_plan(ready)
    assert text.count("skew=true") >= 2
    row = ready.filter("job_execution_id = 3").first()
    assert (row.job_id, row.parent_jobs_total_count, row.parent_jobs_ready_count) == (7, 200, 200)


def test_semi_joins_get_reduced_sides(spark):
    entities = spark.range(0, 90_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('e', id % 10)) entity", "'Enabled' status")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(metastore.timeline_entities(entities, entities, entities))
        assert text.count("Exchange") == 3 and text.count("HashAggregate") == 6
        assert metastore.timeline_entities(entities, entities, entities).count() == 11


def test_equal_starts_sort_in_many_tasks(spark):
    steps = spark.range(0, 50_000, 1, 8).selectExpr("'s' start_dt", "uuid() entity")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sizes = audit.order_steps(steps).select(F.spark_partition_id().alias("p")).groupBy("p").count()
        assert sizes.count() == 8
