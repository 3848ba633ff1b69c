"""Landing to lake: one entity, all entities, records, purge, incremental."""

import os
from collections import Counter

import pytest
from pyspark.sql.types import StructType
from test_landing import put

import landinglake.plans.ingest as module
from landinglake.operators.audit import fold_status
from landinglake.plans.ingest import (LoadOptions, Recorder, ingest_all, ingest_entity, run_status,
                                      status_frame)
from landinglake.sources.lake import find_table, read_appended, read_rejects
from landinglake.streaming import ingest_new_files

HOURLY = LoadOptions(partition_cols=("year", "month", "day", "hour"), base_column="createdAt")
GOOD = '{"id": 1, "createdAt": "2024-03-01 05:00:00", "amount": 1.25, "note": null}\n'
LATE = '{"id": 2, "createdAt": "whenever", "amount": 2.5, "note": null}\n'


class Place:
    def __init__(self, spark, folder, table):
        self.spark, self.folder, self.table = spark, folder, table
        self.landing, self.lake, self.errors = (f"{folder}/{p}" for p in ("in", "lake", "error"))
        self.recorder = Recorder(folder + "/records")

    def entity(self, options=HOURLY, **more):
        return ingest_entity(self.spark, "orders", self.landing, self.table, self.lake,
                             self.errors, 4, options, **more)

    def all(self, options=HOURLY, **more):
        return ingest_all(self.spark, self.landing, self.lake, self.errors, self.recorder, 4, 8,
                          options, table_name=lambda e: f"{self.table}_{e}", **more)

    def record(self, name):
        return read_appended(self.spark, f"{self.folder}/records/{name}").collect()


@pytest.fixture
def place(spark, folder, new_table):
    return Place(spark, folder, new_table)


def test_entity(spark, place):
    put(place.landing, "a.json", GOOD + LATE + '{"id": 3, "crea\n{}\n')
    done = place.entity()
    assert (done.ok, done.records, done.rejects, done.lost_values) == (True, 4, 1, 1)
    assert [(s.step, s.status) for s in done.steps] == [
        ("Load_datalake", "Success"), ("Update_glue_schema", "Success"),
        ("raw_data_to_datalake", "Success")]
    last = done.steps[-1]
    assert (last.records_cnt, last.reject_records_cnt) == (4, 1)
    assert last.description == "1 values did not fit their type"
    found = find_table(spark, place.table)
    assert list(found.columns) == ["amount", "created_at", "id", "source_file_name",
                                   "process_execution_id"]
    assert list(found.partitions) == ["year", "month", "day", "hour"]
    rows = spark.table(place.table).orderBy("id").collect()
    assert [(r.id, float(r.amount), r.year, r.hour, r.process_execution_id) for r in rows] == [
        (1, 1.25, 2024, 5, 4), (2, 2.5, None, None, 4)]
    assert [tuple(r) for r in read_rejects(spark, place.errors).collect()] == [('{"id": 3, "crea', 4)]
    assert os.listdir(os.path.dirname(spark.conf.get("spark.checkpoint.dir"))) is not None


def test_staged_files_are_removed(spark, place):
    put(place.landing, "a.json", GOOD)
    root = spark.conf.get("spark.checkpoint.dir")
    place.entity()
    left = [f for f in os.listdir(root) if f.startswith("stage-orders")
            and os.path.exists(os.path.join(root, f, "data"))]
    assert left == []


def test_base_column_in_another_case(spark, place):
    put(place.landing, "a.json", GOOD)
    options = LoadOptions(partition_cols=("year",), base_column="CREATEDAT")
    assert place.entity(options).ok
    assert spark.table(place.table).first().year == 2024


def test_all_malformed(spark, place):
    put(place.landing, "a.json", "x\n{\n")
    done = place.entity()
    assert (done.ok, done.all_rejected, done.rejects) == (False, True, 2)
    assert not spark.catalog.tableExists(place.table)
    assert os.listdir(place.landing) in ([], [".a.json.crc"])
    assert read_rejects(spark, place.errors).count() == 2


def test_rejects_of_earlier_runs_stay(spark, place):
    for _ in range(2):
        put(place.landing, "a.json", GOOD + "x\n")
        place.entity()
    assert read_rejects(spark, place.errors).count() == 2


def test_missing_base_column_fails_the_entity(place):
    put(place.landing, "a.json", '{"id": 1}\n')
    done = place.entity()
    assert not done.ok and "createdAt" in done.steps[-1].description


def test_partitions_need_a_base_column():
    with pytest.raises(ValueError, match="base column"):
        LoadOptions(partition_cols=("year",))


def test_colliding_names_fail_before_writing(spark, place):
    put(place.landing, "a.json", '{"a-b": 1, "a b": 2}\n')
    done = place.entity(LoadOptions())
    assert not done.ok and "'a b' and 'a-b'" in done.steps[-1].description
    assert not os.path.exists(place.lake)


def test_an_empty_column_does_not_collide(spark, place):
    put(place.landing, "a.json", '{"a-b": 1, "a b": null}\n')
    assert place.entity(LoadOptions()).ok
    assert spark.table(place.table).first().a_b == 1


def test_second_load_drifts(spark, place):
    put(place.landing, "a.json", '{"id": 1, "n": 1.5, "gone": true}\n')
    place.entity(LoadOptions())
    put(place.landing, "a.json", '{"id": "2", "n": "x", "fresh": [1]}\n{"id": "?", "n": "2"}\n')
    done = place.entity(LoadOptions())
    assert done.lost_values == 2
    rows = spark.table(place.table).select("id", "n", "gone", "fresh").collect()
    assert Counter((r.id, r.n and float(r.n), r.gone, tuple(r.fresh or ())) for r in rows) == Counter(
        [(1, 1.5, True, ()), (2, None, None, (1,)), (None, 2.0, None, ())])


def fill(place):
    put(place.landing, "one/a.json", GOOD)
    put(place.landing, "two/a.json", GOOD + "x\n")
    put(place.landing, "bad/a.json", "x\n")
    put(place.landing, "failing/a.json", '{"id": 1}\n')
    put(place.landing, "left-out/a.json", GOOD)
    os.makedirs(place.landing + "/nothing")


def test_all_entities(spark, place):
    fill(place)
    done = {d.entity: d for d in place.all(exclude=["left-out"])}
    assert {e: d.ok for e, d in done.items()} == {"one": True, "two": True, "bad": True, "failing": False}
    assert run_status(status_frame(spark, [(e, d.ok) for e, d in done.items()])) is False
    steps = place.record("jobs_execution_detail")
    assert Counter((s.entity, s.status) for s in steps) == Counter({
        ("one", "Success"): 3, ("two", "Success"): 3, ("bad", "Failed"): 1, ("failing", "Failed"): 1})
    assert {s.jobs_execution_id for s in steps} == {8}
    assert {(m.process_execution_id, m.entity) for m in place.record(
        "entity_process_execution_mapping")} == {(4, "one"), (4, "two")}
    assert Counter(r.entity for r in place.record("entity_schema_details")) == Counter(one=4, two=4)
    left = {e: [f for f in os.listdir(f"{place.landing}/{e}") if f.endswith(".json")]
            for e in os.listdir(place.landing)}
    assert left == {"one": [], "two": [], "bad": [], "failing": ["a.json"], "left-out": ["a.json"],
                    "nothing": []}


def test_purge_spares_later_files(place, monkeypatch):
    put(place.landing, "one/a.json", GOOD)
    entity = module.schema_rows

    def meanwhile(*args):
        put(place.landing, "one/late.json", GOOD)
        return entity(*args)
    monkeypatch.setattr(module, "schema_rows", meanwhile)
    assert [d.ok for d in place.all()] == [True]
    assert [f for f in os.listdir(place.landing + "/one") if f.endswith(".json")] == ["late.json"]


def test_failed_record_keeps_the_source(place, monkeypatch):
    put(place.landing, "one/a.json", GOOD)

    def broken(*_args):
        raise OSError("no metastore")
    monkeypatch.setattr(Recorder, "mapping", broken)
    assert [d.ok for d in place.all()] == [False]
    assert "a.json" in os.listdir(place.landing + "/one")


def test_status_fold(spark):
    assert run_status(status_frame(spark, [])) is True
    assert run_status(status_frame(spark, [("a", True)])) is True
    assert fold_status(status_frame(spark, [("a", True), ("b", None)])).first().ok is False


def stream(place, **more):
    schema = StructType.fromDDL("id bigint, createdAt string, amount double")
    options = LoadOptions(schema=schema, partition_cols=("year", "month"), base_column="createdAt")
    return ingest_new_files(place.spark, "orders", place.landing, place.table, place.lake,
                            place.errors, place.folder + "/checkpoint", 4, options, **more)


def test_incremental(spark, place):
    assert stream(place) == []
    put(place.landing, "a.json", GOOD + "x\n")
    assert [(o.records, o.rejects) for o in stream(place)] == [(2, 1)]
    put(place.landing, "b.json", LATE)
    assert [o.records for o in stream(place)] == [1]
    assert stream(place) == []
    put(place.landing, "c.json", "only\nbad\n")
    assert [o.all_rejected for o in stream(place)] == [True]
    assert sorted(r.id for r in spark.table(place.table).collect()) == [1, 2]
    assert read_rejects(spark, place.errors).count() == 3


def test_incremental_in_batches(spark, place):
    for i in range(3):
        put(place.landing, f"{i}.json", GOOD)
    assert len(stream(place, files_per_batch=1)) == 3
    assert spark.table(place.table).count() == 3
    assert len([m for m in os.listdir(place.lake + "/_loads") if m.endswith(".done")]) == 2


def test_repeated_batch_loads_once(spark, place):
    """Spark repeats a batch whose commit is not in the checkpoint."""
    put(place.landing, "a.json", GOOD + "x\n")
    stream(place)
    commits = place.folder + "/checkpoint/orders/commits"
    for name in os.listdir(commits):
        os.unlink(os.path.join(commits, name))
    stream(place)
    assert spark.table(place.table).count() == 1
    assert read_rejects(spark, place.errors).count() == 1


def test_failed_batch_is_raised_and_tried_again(spark, place, monkeypatch):
    put(place.landing, "a.json", GOOD)

    def broken(*_args, **_kwargs):
        raise OSError("store is away")
    with monkeypatch.context() as patched:
        patched.setattr(module, "publish", broken)
        with pytest.raises(Exception, match="store is away"):
            stream(place)
    assert [o.records for o in stream(place)] == [1]
    assert spark.table(place.table).count() == 1


def test_incremental_infers_a_schema_per_batch(spark, place):
    put(place.landing, "a.json", '{"id": 1}\n')
    def start():
        return ingest_new_files(spark, "orders", place.landing, place.table, place.lake,
                                place.errors, place.folder + "/checkpoint")
    assert [o.records for o in start()] == [1]
    put(place.landing, "b.json", '{"id": 2, "fresh": "x"}\n')
    assert [o.ok for o in start()] == [True]
    assert sorted(map(tuple, spark.table(place.table).select("id", "fresh").collect())) == [
        (1, None), (2, "x")]


def test_archived_files_are_not_loaded_again(spark, place):
    archive = place.folder + "/archive"
    for i in range(3):
        put(place.landing, f"{i}.json", GOOD)
        stream(place, archive=archive)
    assert spark.table(place.table).count() == 3


def test_schema_per_entity(spark, place):
    put(place.landing, "one/a.json", '{"a": 1}\n')
    put(place.landing, "two/a.json", '{"a": 1}\n')
    options = LoadOptions(schema={"one": StructType.fromDDL("a string")})
    assert all(d.ok for d in place.all(options))
    assert [dict(spark.table(f"{place.table}_{e}").dtypes)["a"] for e in ("one", "two")] == [
        "string", "bigint"]


def test_nothing_to_load(place):
    assert place.all() == []
    os.makedirs(place.landing + "/empty")
    assert place.all() == []


def test_failed_load_takes_its_rejects_back(spark, place, monkeypatch):
    put(place.landing, "a.json", GOOD + "x\n")

    def broken(*_args, **_kwargs):
        raise OSError("store is away")
    with monkeypatch.context() as patched:
        patched.setattr(module, "publish", broken)
        assert not place.entity().ok
    assert place.entity().ok
    assert read_rejects(spark, place.errors).count() == 1


def test_landing_in_partition_folders(spark, place):
    put(place.landing, "dt=2024-01-01/a.json", GOOD)
    put(place.landing, "dt=2024-01-02/a.json", GOOD + "x\n")
    done = place.entity()
    assert (done.ok, done.records, done.rejects, len(done.files)) == (True, 3, 1, 2)
    assert {str(r.dt) for r in spark.table(place.table).collect()} == {"2024-01-01", "2024-01-02"}


def test_only_blank_records(spark, place):
    put(place.landing, "one/a.json", '{"id": null}\n{}\n')
    done, = place.all()
    assert (done.ok, done.records, done.accepted) == (True, 2, 0)
    assert not spark.catalog.tableExists(f"{place.table}_one")


def test_without_purge(spark, place):
    put(place.landing, "one/a.json", GOOD)
    put(place.landing, "bad/a.json", "x\n")
    assert [d.ok for d in place.all(purge=False)] == [True, True]
    assert all(os.path.exists(f"{place.landing}/{e}/a.json") for e in ("one", "bad"))
