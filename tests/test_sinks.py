"""File, bulk and database sinks."""

import datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from landinglake.operators import sinks
from landinglake.plans.ingest import DatabaseRecorder, Recorder
from landinglake.plans.layers import refresh_by_call, refresh_layer
from landinglake.sources.databases import read_query, read_table
from landinglake.sources.lake import read_appended


def test_modes_of_the_bare_sink(spark, folder):
    df = spark.sql("select * from values (1, 1), (2, 2) as t(v, p)")
    one = df.filter("p = 1").withColumn("v", F.lit(9))
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(folder + "/t").collect())
    sinks.write_files(df, folder + "/t", partition_cols=["p"])
    sinks.write_files(one, folder + "/t", partition_cols=["p"], mode="dynamic")
    assert read() == [(2, 2), (9, 1)]
    sinks.write_files(one, folder + "/t", partition_cols=["p"], mode="append")
    assert read() == [(2, 2), (9, 1), (9, 1)]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_files(one, folder + "/t", partition_cols=["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert read() == [(9, 1)]


TEXTS = ["", " pad ", 'q"uote', "a,b", "line\nbreak", "cr\r\nlf", "back\\slash", '"', "\\N", "\\\\N", "NULL", None, "é"]


def test_bulk_exchange_gives_back_what_went_in(spark, folder, new_table):
    when = datetime.datetime(2024, 2, 29, 1, 2, 3, 456789)
    rows = [(i, t, 0.1 * i, when, when.date(), None if i % 2 else True) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "i int, t string, d double, ts timestamp, dt date, b boolean")
    df = df.withColumn("ntz", F.col("ts").cast("timestamp_ntz")).withColumn(
        "dec", F.col("d").cast("decimal(38,6)"))
    sinks.bulk_load(df, new_table, path=folder, create=True)
    assert sorted(spark.table(new_table).collect()) == sorted(df.collect())
    sinks.bulk_load(df.select(*reversed(df.columns)), new_table, truncate=True, insert=True)
    assert sorted(spark.table(new_table).collect()) == sorted(df.collect())
    sinks.bulk_load(df, new_table)
    assert spark.table(new_table).count() == 2 * len(TEXTS)
    sinks.bulk_load(df, new_table, path=folder, create=True, insert=False)
    assert spark.table(new_table).count() == 0


def test_insert_rows(spark, folder, new_table):
    df = spark.sql("select 1 a, 'x' b")
    sinks.insert_rows(df, new_table)
    sinks.insert_rows(df.select("b", "a"), new_table)
    assert [tuple(r) for r in spark.table(new_table).collect()] == [(1, "x")] * 2


def test_appends_side_by_side(spark, folder):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: sinks.append_files(spark.range(i, i + 1), folder), range(16)))
    assert sorted(r.id for r in read_appended(spark, folder).collect()) == list(range(16))


def test_purge(spark, folder):
    for name in "abc":
        open(f"{folder}/{name}", "w").close()
    assert sinks.purge_files(spark, [f"{folder}/a", f"file://{folder}/b", f"{folder}/none"]) == 2
    assert sinks.purge_files(spark, []) == 0


# Databases: there is none here, so only what Spark is asked for is checked.

class Chain(MagicMock):
    """A reader or writer that records its options and returns itself."""

    def asked(self):
        found = {}
        for name, args, kwargs in self.mock_calls:
            if name.endswith("option"):
                found[args[0]] = args[1]
            elif name.endswith("options"):
                found.update(kwargs)
        return found


@pytest.fixture
def chain():
    chain = Chain()
    for step in ("format", "option", "options", "mode"):
        getattr(chain, step).return_value = chain
    return chain


def test_database_query(chain):
    read_query(MagicMock(read=chain), "jdbc:x:y", "select 1", {"user": "u"})
    assert chain.asked() == {"url": "jdbc:x:y", "query": "select 1", "fetchsize": "10000", "user": "u"}


def test_database_table_in_splits(chain):
    read_table(MagicMock(read=chain), "jdbc:x:y", "t", "id", 0, 100, 4)
    assert chain.asked() == {"url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000",
                             "partitionColumn": "id", "lowerBound": "0", "upperBound": "100",
                             "numPartitions": "4"}
    with pytest.raises(ValueError, match="go together"):
        read_table(MagicMock(read=chain), "jdbc:x:y", "t", split_column="id")


def test_database_append(chain):
    DatabaseRecorder("jdbc:x:y", {"numPartitions": "2"}).steps(MagicMock(write=chain))
    assert chain.asked() == {"url": "jdbc:x:y", "dbtable": "jobs_execution_detail",
                             "batchsize": "10000", "numPartitions": "2"}
    chain.mode.assert_called_once_with("append")


@pytest.mark.parametrize("flags, mode, truncate, rows", [
    ({}, "append", None, "all"), ({"truncate": True}, "overwrite", "true", "all"),
    ({"create": True}, "overwrite", None, "all"),
    ({"create": True, "truncate": True}, "overwrite", None, "all"),
    ({"create": True, "insert": False}, "overwrite", None, "none"), ({"insert": False}, None, None, None)])
def test_database_load(chain, flags, mode, truncate, rows):
    df = MagicMock(write=chain)
    df.limit.return_value.write = chain
    sinks.load_database(df, "jdbc:x:y", "t", **flags)
    assert [c.args for c in chain.mode.call_args_list] == ([(mode,)] if mode else [])
    assert chain.asked().get("truncate") == truncate
    assert df.limit.called == (rows == "none") and chain.save.called == bool(rows)


# Layers

def test_layer_refresh_records_failures(spark, folder, new_table):
    def transform(df):
        return df.selectExpr("id", "raise_error('broken') as x") if df.count() == 2 else df

    recorder = Recorder(folder + "/records")
    flags = refresh_layer(
        spark, ["a", "b"], "curated", source=lambda e: spark.range(2 if e == "b" else 3),
        transform=transform, table_name=lambda e: f"{new_table}_{e}", path=folder + "/layer",
        recorder=recorder, job_run_id=1)
    assert {r.entity: r.ok for r in flags.collect()} == {"a": True, "b": False}
    assert spark.table(new_table + "_a").count() == 3
    steps = read_appended(spark, folder + "/records/jobs_execution_detail").collect()
    assert {(s.entity, s.step, s.status) for s in steps} == {
        ("a", "Load_datalake", "Success"), ("a", "Update_glue_schema", "Success"),
        ("a", "curated", "Success"), ("b", "curated", "Failed")}
    assert {s.records_cnt for s in steps if s.step == "curated"} == {3, None}


def test_calls(spark, folder):
    answers = {"good": '[["good","s","2","3","Success",null]]', "none": "[]",
               "bad": '[["bad","t","2","3","Failed","d"],["bad","s","1","2","Success",null]]'}

    def call(entity):
        if entity == "gone":
            raise OSError("no such procedure")
        return spark.createDataFrame([(answers[entity],)], "`the answer` string")

    flags = refresh_by_call(spark, ["good", "none", "bad", "gone"], call, Recorder(folder), 6)
    assert {r.entity: r.ok for r in flags.collect()} == {
        "good": True, "none": True, "bad": False, "gone": False}
    steps = read_appended(spark, folder + "/jobs_execution_detail").collect()
    assert {(s.entity, s.step, s.status, s.jobs_execution_id) for s in steps} == {
        ("good", "s", "Success", 6), ("bad", "t", "Failed", 6), ("bad", "s", "Success", 6)}
