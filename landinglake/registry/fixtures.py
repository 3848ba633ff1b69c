"""Landing folders and metadata tables derived from the given tables, by Spark.

Which lines are broken, blank or have an unreadable time follows from their own ``value``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.functions.times import utc_text
from landinglake.storage import Storage, base_name, fresh_folder, join_path

# The kinds of lines. From BROKEN_FROM on a line is cut in half, below
# BLANK_BELOW it is an empty record, from there to BAD_TIME_BELOW its time is unreadable.
BROKEN_FROM, BLANK_BELOW, BAD_TIME_BELOW = 150, 2, 3
BROKEN_ENTITY = "error"
BAD_TIME = "not a time"
# Suppliers with less on their account get a line that is too short.
SHORT_BELOW = 1000

# Metadata tables over the given ones. Both engines read this text, with the table names
# filled in.
METADATA = {
    "runs": """
        select o_orderkey as id, o_orderkey % 10 as process_execution_id, o_custkey as jobs_id,
          case when o_orderpriority like '1-%' then 'F' when o_orderstatus = 'O' then 'R'
               when o_orderstatus = 'F' then 'S' else 'I' end as jobs_status
        from {orders}""",
    "edges": """
        select c_nationkey as process_id, c_custkey as jobs_id,
          case when c_custkey = 0 then null else c_custkey - 1 end as parent_jobs_id
        from {customer}
        union all
        select c_nationkey, c_custkey, c_custkey - 7 from {customer}
        where c_mktsegment = 'MACHINERY' and c_custkey > 7""",
    "jobs": """
        select c_custkey as id, c_name as name, c_nationkey % 5 as jobs_execution_class_id
        from {customer}""",
    "classes": "select r_regionkey as id, r_name as name from {region}",
    "class_params": """
        select n_nationkey as id, n_regionkey as jobs_execution_class_id, n_name as name,
          concat('<application>/<subscriber>/', n_nationkey) as default_param_value,
          n_nationkey % 2 as is_mandatory
        from {nation}""",
    "processes": """
        select n_nationkey as id, n_regionkey as subsriber_id, n_nationkey as applications_id
        from {nation}""",
    "subscribers": "select r_regionkey as id, r_name as name from {region}",
    "applications": "select n_nationkey as id, n_name as name from {nation}",
    "job_values": """
        select o_custkey as jobs_id, cast(o_orderkey % 25 as int) as jobs_execution_class_param_id,
          concat('<subscriber>:', min(o_orderpriority)) as param_value
        from {orders} group by 1, 2""",
    "mapping": """
        select o_orderkey % 10 as process_execution_id, o_orderpriority as entity
        from {orders}""",
    "timeline": """
        select c_name as entity,
          case when c_mktsegment = 'BUILDING' then 'Disabled' else 'Enabled' end as status
        from {customer}""",
    "narrations": """
        select c.c_name as entity from {customer} c join {orders} o on o.o_custkey = c.c_custkey
        where o.o_orderstatus = 'F'""",
    "fields": """
        select c.c_name as entity from {customer} c join {orders} o on o.o_custkey = c.c_custkey
        where o.o_orderpriority like '1-%'""",
}
SOURCES = ("orders", "customer", "nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def metadata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = METADATA[name]
    used = {s: table(spark, sf_dir, s) for s in SOURCES if "{" + s + "}" in sql}
    return spark.sql(sql, **used)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_lines(df: DataFrame, broken: Column | None = None) -> Column:
    """One JSON line per event, some of them spoilt."""
    value = F.col("value")
    broken = (value >= BROKEN_FROM) if broken is None else broken | (value >= BROKEN_FROM)
    spoilt_time = (value >= BLANK_BELOW) & (value < BAD_TIME_BELOW)
    moment = F.when(spoilt_time, BAD_TIME).otherwise(utc_text(F.col("ts")))
    record = F.struct("event_id", moment.alias("ts"), F.col("user_id").alias("userID"),
                      F.col("event_type").alias("Événement type"), "value", "props",
                      F.lit(None).cast("string").alias("note"))
    line = F.to_json(record, {"ignoreNullFields": "false"})
    half = F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))
    return F.when(broken, half).when(value < BLANK_BELOW, "{}").otherwise(line)


def _key(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """All events in one landing folder of JSON lines; written once per session."""
    return _landing_folder(_key(spark), sf_dir)


@lru_cache(maxsize=None)
def _landing_folder(_session: str, sf_dir: str) -> str:
    spark = SparkSession.active()
    folder = fresh_folder(spark, "landing")
    df = events(spark, sf_dir)
    df.select(event_lines(df).alias("value")).write.text(folder)
    return folder


def write_tree(spark: SparkSession, sf_dir: str) -> str:
    """A new landing prefix: one folder per event type, one wholly broken, one empty."""
    prefix = fresh_folder(spark, "landings")
    df = events(spark, sf_dir)
    lines = event_lines(df, F.col("event_type") == BROKEN_ENTITY)
    (df.select(F.col("event_type").alias("entity"), lines.alias("value"))
     .write.partitionBy("entity").text(prefix))
    storage = Storage(spark, prefix)
    for folder in storage.glob(prefix, "entity=*"):
        storage.rename(folder, join_path(prefix, base_name(folder).split("=")[1]))
    storage.make_folder(join_path(prefix, "nothing_yet"))
    return prefix


def landing_tree(spark: SparkSession, sf_dir: str) -> str:
    """The same prefix for queries that only read it; written once per session."""
    return _landing_tree(_key(spark), sf_dir)


@lru_cache(maxsize=None)
def _landing_tree(_session: str, sf_dir: str) -> str:
    return write_tree(SparkSession.active(), sf_dir)


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers as CSV; a supplier with little money has lost the line after the name."""
    folder = fresh_folder(spark, "csv")
    full = F.concat_ws(",", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    short = F.concat_ws(",", "s_suppkey", "s_name")
    (table(spark, sf_dir, "supplier")
     .select(F.when(F.col("s_acctbal") < SHORT_BELOW, short).otherwise(full)).write.text(folder))
    return folder
