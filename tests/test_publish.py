"""Publishing: modes, catalog, evolution, guards, failures, skew."""

import glob
import os
import random

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from landinglake.errors import LocationMismatch, NameCollision
from landinglake.operators.partitions import partition_map
from landinglake.operators.sinks import write_files
from landinglake.operators.tables import schema_rows
from landinglake.plans.ingest import stage
from landinglake.plans.publish import publish
from landinglake.sources.lake import find_table
from landinglake.sources.landing import CORRUPT_RECORD, SOURCE_FILE, Landing


def rows(spark, sql):
    return spark.sql(sql)


def content(spark, table, *columns):
    return sorted(tuple(r) for r in spark.table(table).select(*columns).collect())


def files(folder):
    return sorted(glob.glob(folder + "/**/*.parquet", recursive=True))


def load(spark, values, **options):
    df = spark.sql(f"select * from values {values} as t(v, day)")
    return publish(df, partition_cols=["day"], **options)


def test_append_registers_and_reports(spark, folder, new_table):
    done = load(spark, "('a', 1), ('b', 2), ('c', 2)", table=new_table, path=folder)
    assert (done.rows, sorted(p["day"] for p in done.partitions)) == (3, [1, 2])
    assert [s.step for s in done.steps] == ["Load_datalake", "Update_glue_schema"]
    load(spark, "('d', 2)", table=new_table)
    assert content(spark, new_table, "v", "day") == [("a", 1), ("b", 2), ("c", 2), ("d", 2)]
    found = find_table(spark, new_table)
    assert (found.columns, found.partitions) == ({"v": "string"}, {"day": "bigint"})


@pytest.mark.parametrize("mode, left", [
    ("overwrite", [("x", 2), ("y", 4)]),
    ("dynamic", [("a", 1), ("c", 3), ("x", 2), ("y", 4)])])
def test_replacing(spark, folder, new_table, mode, left):
    load(spark, "('a', 1), ('b', 2), ('c', 3)", table=new_table, path=folder)
    load(spark, "('x', 2), ('y', 4)", table=new_table, mode=mode)
    assert content(spark, new_table, "v", "day") == left
    assert content(spark, new_table, "v") == sorted((v,) for v, _ in left)
    location = find_table(spark, new_table).location
    assert sorted(r[0] for r in spark.read.parquet(location).select("v").collect()) == \
        sorted(v for v, _ in left)
    days = {r[0] for r in spark.sql(f"show partitions {new_table}").collect()}
    assert days == {f"day={d}" for _, d in left}


def test_unpartitioned(spark, folder, new_table):
    publish(rows(spark, "select 1 a"), new_table, folder)
    publish(rows(spark, "select 2 a"), new_table, folder + "/")
    assert content(spark, new_table, "a") == [(1,), (2,)]
    publish(rows(spark, "select 3 a, 'n' b"), new_table, mode="overwrite")
    assert content(spark, new_table, "a", "b") == [(3, "n")]
    publish(rows(spark, "select 4 a, 'm' b"), new_table, mode="dynamic")
    assert content(spark, new_table, "a", "b") == [(4, "m")]


def test_overwrite_with_nothing_empties(spark, folder, new_table):
    load(spark, "('a', 1)", table=new_table, path=folder)
    publish(spark.sql("select 'a' v, 1 day where false"), new_table, partition_cols=["day"],
            mode="overwrite", grace=0)
    assert content(spark, new_table, "v") == [] and files(folder) == []


def test_null_and_odd_partition_values(spark, folder, new_table):
    df = spark.sql("select * from values (1, 'a b/c'), (2, null), (3, \"it's\"), (4, 'x:y=z%') as t(v, p)")
    publish(df, new_table, folder, partition_cols=["p"])
    assert sorted(spark.table(new_table).collect(), key=lambda r: r.v) == [
        (1, "a b/c"), (2, None), (3, "it's"), (4, "x:y=z%")]
    publish(df.withColumn("v", F.col("v") + 10), new_table, partition_cols=["p"], mode="dynamic")
    assert sorted(r.v for r in spark.table(new_table).collect()) == [11, 12, 13, 14]


def test_types_drift(spark, folder, new_table):
    publish(rows(spark, "select 1 a, 1.5D b, 'x' c, true gone"), new_table, folder)
    publish(rows(spark, "select '2' a, 'no' b, 3 c, 2.5D fresh"), new_table)
    found = find_table(spark, new_table)
    assert found.columns == {"a": "bigint", "b": "decimal(38,6)", "c": "string",
                             "gone": "boolean", "fresh": "decimal(38,6)"}
    got = {r.a: (r.b and float(r.b), r.c, r.gone, r.fresh and float(r.fresh))
           for r in spark.table(new_table).collect()}
    assert got == {1: (1.5, "x", True, None), 2: (None, "3", None, 2.5)}


def test_ints_are_widened_in_the_files(spark, folder, new_table):
    publish(rows(spark, "select 1 a"), new_table, folder)
    assert spark.read.parquet(folder).dtypes == [("a", "bigint")]


def test_foreign_double_table_stays_readable(spark, folder, new_table):
    spark.sql(f"create table {new_table} (a double, b double) using parquet location '{folder}'")
    publish(rows(spark, "select '1.23456789' a, 2.123456789D b"), new_table, folder)
    assert content(spark, new_table, "a", "b") == [(1.234568, 2.123456789)]


def test_guards(spark, folder, new_table):
    load(spark, "('a', 1)", table=new_table, path=folder + "/t")
    with pytest.raises(LocationMismatch):
        load(spark, "('a', 1)", table=new_table, path=folder + "/other")
    with pytest.raises(ValueError, match="needs a path"):
        load(spark, "('a', 1)", table=new_table + "_x")
    with pytest.raises(ValueError, match="partitioned by"):
        publish(rows(spark, "select 'a' v, 1 day"), new_table)
    with pytest.raises(ValueError, match="mode"):
        load(spark, "('a', 1)", table=new_table, mode="merge")
    with pytest.raises(NameCollision):
        publish(spark.range(1).selectExpr("id as `a-b`", "id as `a b`"), new_table + "_y", folder + "/y")


class Refused(Exception):
    pass


def refuse(_published):
    raise Refused


@pytest.mark.parametrize("mode", ["append", "overwrite", "dynamic"])
def test_failure_leaves_the_table(spark, folder, new_table, mode):
    load(spark, "('a', 1), ('b', 2)", table=new_table, path=folder)
    before = files(folder)
    with pytest.raises(Refused):
        load(spark, "('x', 2), ('y', 3)", table=new_table, mode=mode, before_commit=refuse)
    assert files(folder) == before
    assert content(spark, new_table, "v", "day") == [("a", 1), ("b", 2)]


def test_failure_after_the_definition_is_replaced(spark, folder, new_table, monkeypatch):
    import landinglake.plans.publish as module
    load(spark, "('a', 1), ('b', 2)", table=new_table, path=folder)

    swap = module.swap_table

    def broken(*args):
        swap(*args)
        raise Refused
    monkeypatch.setattr(module, "swap_table", broken)
    with pytest.raises(Refused):
        load(spark, "('x', 2), ('y', 3)", table=new_table, mode="overwrite")
    monkeypatch.undo()
    assert {r[0] for r in spark.sql(f"show partitions {new_table}").collect()} == {"day=1", "day=2"}
    assert content(spark, new_table, "v", "day") == [("a", 1), ("b", 2)]


def test_repeated_load_id(spark, folder, new_table):
    first = load(spark, "('a', 1)", table=new_table, path=folder, load_id="run-1")
    again = load(spark, "('a', 1)", table=new_table, path=folder, load_id="run-1")
    assert (first.skipped, again.skipped) == (False, True)
    assert content(spark, new_table, "v") == [("a",)]


def test_load_id_after_a_crash(spark, folder, new_table):
    load(spark, "('a', 1)", table=new_table, path=folder)
    with pytest.raises(Refused):
        load(spark, "('b', 1)", table=new_table, load_id="run-2", before_commit=refuse)
    # As if the failing driver had died before it could take its files back.
    write_files(spark.sql("select 'b' v, 1L day"), folder, partition_cols=["day"], mode="append",
                options={"mapreduce.output.basename": "load-run-2_"})
    load(spark, "('b', 1)", table=new_table, load_id="run-2")
    assert content(spark, new_table, "v") == [("a",), ("b",)]


def test_hot_partition_is_split_over_tasks(spark, folder, new_table):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)
    spark.conf.set(keys[0], "200k")
    try:
        hot = spark.range(0, 400_000, 1, 16).select(
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 20) + 2).alias("day"))
        publish(hot, new_table, folder, partition_cols=["day"])
    finally:
        spark.conf.unset(keys[0])
    assert len(glob.glob(folder + "/day=1/*.parquet")) >= 8
    assert spark.table(new_table).count() == 400_000


def test_partition_map(spark):
    df = spark.sql("select * from values (2024, 1), (2024, null), (2024, 1) as t(year, month)")
    assert sorted((r.prefix, r["values"]) for r in partition_map(df, ["year", "month"], "s3://b/t/").collect()) == [
        ("s3://b/t/year=2024/month=1/", ["2024", "1"]),
        ("s3://b/t/year=2024/month=__HIVE_DEFAULT_PARTITION__/",
         ["2024", "__HIVE_DEFAULT_PARTITION__"])]


def test_schema_rows(spark, folder, new_table):
    df = spark.sql("select 1 a, 2.5D b, 9 process_execution_id, 2024 year, 1 month, array(1) c")
    publish(df, new_table, folder, partition_cols=["year", "month"])
    got = schema_rows(spark, new_table, "e", 9).collect()
    assert [(r.column_name, r.data_type, r.entity, r.process_execution_id) for r in got] == [
        ("a", "bigint", "e", 9), ("b", "decimal(38,6)", "e", 9), ("c", "array<int>", "e", 9)]


def test_compression_and_format(spark, folder, new_table):
    publish(rows(spark, "select 1 a"), new_table, folder, file_format="orc", compression="zlib")
    assert any(".zlib" in f for f in os.listdir(folder))
    assert content(spark, new_table, "a") == [(1,)]


def test_path_with_pattern_characters(spark, folder, new_table):
    path = folder + "/a [b] {c,d}"
    load(spark, "('a', 1), ('b', 2)", table=new_table, path=path)
    load(spark, "('x', 2)", table=new_table, mode="overwrite")
    with pytest.raises(Refused):
        load(spark, "('y', 2)", table=new_table, before_commit=refuse)
    assert content(spark, new_table, "v", "day") == [("x", 2)]


def test_replacing_needs_named_files(spark, folder, new_table, monkeypatch):
    import landinglake.plans.publish as module
    load(spark, "('a', 1), ('b', 2)", table=new_table, path=folder)
    write = module.write_files

    def nameless(df, *args, **kwargs):
        *head, _options = args
        write(df, *head, {}, **kwargs)
    monkeypatch.setattr(module, "write_files", nameless)
    with pytest.raises(RuntimeError, match="name"):
        load(spark, "('x', 3)", table=new_table, mode="overwrite")
    assert content(spark, new_table, "v", "day") == [("a", 1), ("b", 2)]


def flaky(spark, rows):
    """Rows of which every second task fails at its end, the first time it runs."""
    @F.udf("bigint")
    def last_row_fails(value, is_last):
        context = TaskContext.get()
        if is_last and context.attemptNumber() == 0 and context.partitionId() % 2:
            raise RuntimeError("lost")
        return value
    per_task = rows // 8
    df = spark.range(0, rows, 1, 8)
    return df.select(last_row_fails("id", F.col("id") % per_task == per_task - 1).alias("v"),
                     (F.col("id") % 3).alias("day"))


@pytest.mark.parametrize("partition_cols", [[], ["day"]])
def test_repeated_tasks_count_once(spark, folder, new_table, partition_cols):
    done = publish(flaky(spark, 8000), new_table, folder, partition_cols=partition_cols)
    assert (done.rows, spark.table(new_table).count()) == (8000, 8000)
    assert sorted(p["day"] for p in done.partitions) == [0, 1, 2][:3 * len(partition_cols)]


def test_staging_counts_once_over_repeated_tasks(spark):
    rows = flaky(spark, 8000).withColumns(
        {CORRUPT_RECORD: F.when(F.col("v") % 4 == 0, "x"), SOURCE_FILE: F.lit("f")})
    staged = stage(Landing(rows, ()), run_id=1)
    assert (staged.records, staged.rejects, staged.profile["v"]) == (8000, 2000, 8000)
    assert staged.rows.count() == 8000


def test_nested_types_come_back_and_match_the_catalog(spark, folder, new_table):
    wide = ", ".join(f"{i} as field_number_{i}" for i in range(60))
    df = spark.sql(f"select 1L id, struct({wide}) as s, map('k', array(1.5D)) as m, "
                   "array(struct('x' as y)) as a, struct(1 as `odd: name`, 2 as `b``c`) as o")
    publish(df, new_table, folder)
    publish(df, new_table)
    assert find_table(spark, new_table).columns == dict(df.dtypes)
    assert [r for r in spark.table(new_table).collect()] == df.collect() * 2


@pytest.mark.parametrize("value", ["date'2024-02-29'", "true", "1.5D", "2.25BD", "'a=b/c%20'",
                                   "timestamp_ntz'2024-02-29 01:02:03.5'", "''", "' x '"])
def test_partition_value_types(spark, folder, new_table, value):
    df = spark.sql(f"select 1 v, {value} p union all select 2, null")
    publish(df, new_table, folder, partition_cols=["p"])
    publish(df.withColumn("v", F.col("v") + 10), new_table, mode="dynamic", partition_cols=["p"])
    assert sorted(r.v for r in spark.table(new_table).collect()) == [11, 12]
    stored = {r.v: r.p for r in spark.table(new_table).collect()}
    plain = {r.v: r.p for r in spark.sql(f"select 11 v, {value} p").collect()}
    assert stored[11] == (plain[11] if value != "''" else None) or float(stored[11]) == plain[11]
    assert stored[12] is None


def test_partition_columns_are_cleaned(spark, folder, new_table):
    publish(spark.sql("select 1 v, 'x' `Event Day`"), new_table, folder, partition_cols=["Event Day"])
    assert find_table(spark, new_table).partitions == {"event_day": "string"}


@pytest.mark.parametrize("algorithm", ["1", "2"])
@pytest.mark.parametrize("partition_cols", [[], ["day"]])
def test_failing_write_leaves_nothing(spark, folder, new_table, algorithm, partition_cols):
    """With the second algorithm finished tasks have put their files in place already."""
    key = "mapreduce.fileoutputcommitter.algorithm.version"
    publish(spark.sql("select 0L v, 0L day"), new_table, folder, partition_cols=partition_cols)
    before = files(folder)
    df = spark.range(0, 800, 1, 8).selectExpr(
        "if(id = 799, raise_error('no'), id) v", "id % 40 day")
    spark.conf.set(key, algorithm)
    try:
        with pytest.raises(Exception, match="no"):
            publish(df, new_table, partition_cols=partition_cols)
    finally:
        spark.conf.unset(key)
    assert files(folder) == before and spark.table(new_table).count() == 1


@pytest.mark.parametrize("seed", range(4))
def test_any_sequence_of_loads(spark, folder, new_table, seed):
    """Against a dictionary of days; some loads fail and must not show."""
    chance, model = random.Random(seed), {}
    for number in range(6):
        mode = chance.choice(["append", "append", "overwrite", "dynamic"])
        fails, days = chance.random() < 0.3, chance.sample(range(5), chance.randrange(1, 4))
        new = {day: [number * 100 + i for i in range(chance.randrange(1, 4))] for day in days}
        df = spark.createDataFrame([(v, d) for d, vs in new.items() for v in vs], "v long, day long")
        try:
            publish(df, new_table, folder, mode=mode, partition_cols=["day"],
                    before_commit=refuse if fails else None, grace=0)
        except Refused:
            continue
        if mode == "overwrite":
            model = {}
        for day, values in new.items():
            model[day] = values + (model.get(day, []) if mode == "append" else [])
    expected = sorted((v, day) for day, values in model.items() for v in values)
    assert content(spark, new_table, "v", "day") == expected
    location = find_table(spark, new_table).location
    assert sorted(tuple(r) for r in spark.read.parquet(location).select("v", "day").collect()) == expected
    assert {r[0] for r in spark.sql(f"show partitions {new_table}").collect()} == {f"day={d}" for d in model}
