"""The file ledger: each landing file once, whatever dies in between; and nested arrivals."""

import os

import pytest
from pyspark.sql.types import StructType

import landinglake.plans.ingest as module
from landinglake.operators.ledger import FileLedger
from landinglake.plans.ingest import LoadOptions, Recorder, refresh_entity
from landinglake.sources.lake import read_appended
from landinglake.sources.landing import arriving_files, listed_files, read_landing
from landinglake.streaming import ingest_new_all, ingest_new_files
from landinglake.streaming import incremental


def put(folder, name, *ids, tail=""):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write("".join(f'{{"id": {i}}}\n' for i in ids) + tail)


class Place:
    def __init__(self, spark, folder, table):
        self.spark, self.table = spark, table
        self.landing, self.lake, self.errors, self.records = (
            os.path.join(folder, n) for n in ("in", "lake", "error", "records"))
        os.makedirs(self.landing)

    def load(self, **options):
        return refresh_entity(self.spark, "e", self.landing, self.table, self.lake, self.errors,
                              Recorder(self.records), 1, 2, **options)

    def ids(self):
        return sorted(r.id for r in self.spark.table(self.table).collect())

    def left(self):
        return sorted(f for _, _, fs in os.walk(self.landing) for f in fs if f.endswith(".json"))


@pytest.fixture
def place(spark, folder, new_table):
    return Place(spark, folder, new_table)


def die(monkeypatch, name):
    """The driver dies when it comes to ``name``: what follows does not happen."""
    patched = pytest.MonkeyPatch()

    def dead(*_args, **_kwargs):
        raise KeyboardInterrupt(name)
    patched.setattr(module, name, dead)
    return patched


def test_crash_before_the_purge_and_a_new_file(place, monkeypatch):
    put(place.landing, "a.json", 1, 2)
    patched = die(monkeypatch, "purge_files")
    with pytest.raises(KeyboardInterrupt):
        place.load()
    patched.undo()
    put(place.landing, "sub/b.json", 3)
    done = place.load()
    assert done.ok and place.ids() == [1, 2, 3] and place.left() == []
    assert place.load().ok is False  # nothing is there any more
    assert FileLedger(place.spark, place.lake).loaded() is None


def test_crash_before_the_records_keeps_their_counts(place, monkeypatch):
    put(place.landing, "a.json", 1, 2, tail="broken\n")
    patched = die(monkeypatch, "record_outcome")
    with pytest.raises(KeyboardInterrupt):
        place.load()
    patched.undo()
    put(place.landing, "b.json", 3)
    assert place.load().ok
    rows = read_appended(place.spark, place.records + "/jobs_execution_detail").filter(
        "step = 'raw_data_to_datalake'").collect()
    assert sorted((r.records_cnt, r.reject_records_cnt) for r in rows) == [(1, 0), (3, 1)]
    assert place.ids() == [1, 2, 3] and place.left() == []


def test_crash_during_the_load_and_a_new_file(place, monkeypatch):
    """Files are in the table, the load has not ended: they are taken back and loaded again."""
    import landinglake.plans.publish as publishing

    put(place.landing, "a.json", 1, 2, tail="broken\n")
    patched = pytest.MonkeyPatch()

    def dead(*_args, **_kwargs):
        raise KeyboardInterrupt
    patched.setattr(publishing.LoadMarker, "finish", dead)
    with pytest.raises(KeyboardInterrupt):
        place.load()
    patched.undo()
    assert place.ids() == [1, 2]
    put(place.landing, "b.json", 3)
    assert place.load().ok and place.ids() == [1, 2, 3] and place.left() == []
    from landinglake.sources.lake import read_rejects
    assert read_rejects(place.spark, place.errors).count() == 1


def test_a_folder_that_only_grows(place):
    for number in range(3):
        put(place.landing, f"{number}.json", number)
        done = place.load(purge=False, once=True)
        assert (done.ok, done.loaded_before) == (True, number)
    again = place.load(purge=False, once=True)
    assert again.ok and again.loaded_before == 3 and place.ids() == [0, 1, 2]
    put(place.landing, "1.json", 10, 11)  # another content is another file
    assert place.load(purge=False, once=True).ok and place.ids() == [0, 1, 2, 10, 11]
    assert len(place.left()) == 3


def test_rejected_and_blank_files_are_loaded_once_too(place):
    more = {"purge": False, "once": True,
            "options": LoadOptions(schema=StructType.fromDDL("id bigint"))}
    put(place.landing, "a.json", tail="broken\n")
    assert place.load(**more).ok
    put(place.landing, "b.json", tail="{}\n")
    assert place.load(**more).ok
    put(place.landing, "c.json", 7)
    assert place.load(**more).ok and place.ids() == [7]
    from landinglake.sources.lake import read_rejects
    assert read_rejects(place.spark, place.errors).count() == 1


def test_the_ledger_is_compacted_to_what_is_there(place, monkeypatch):
    monkeypatch.setattr(FileLedger.compact, "__defaults__", (3,))
    for number in range(7):
        put(place.landing, f"{number}.json", number)
        assert place.load(purge=False, once=True).ok
        if number == 4:
            os.unlink(place.landing + "/0.json")
    ledger = FileLedger(place.spark, place.lake)
    assert len(ledger.committed()) < 3
    assert sorted(os.path.basename(r.path) for r in ledger.loaded().collect()) == [
        f"{n}.json" for n in range(1, 7)]
    assert place.ids() == list(range(7))
    assert place.load(purge=False, once=True).loaded_before == 6 and place.ids() == list(range(7))


def stream(place, options=LoadOptions(), **more):
    return ingest_new_files(place.spark, "e", place.landing, place.table, place.lake, place.errors,
                            place.landing + "_memory", 1, options, **more)


def test_nested_files_come_with_the_stream_as_with_a_batch(place, spark):
    put(place.landing, "a.json", 1)
    put(place.landing, "sub/deeper/b c+%.json", 2)
    put(place.landing, "kind=x/c.json", 3)  # as not all files have a kind, it is no column
    put(place.landing, "_hidden/d.json", 9)
    put(place.landing, ".e.json", 9)
    put(place.landing, "f.txt", 9)
    options = LoadOptions(schema=StructType.fromDDL("id bigint, kind string"),
                          read_options={"pathGlobFilter": "*.json"})
    batch = read_landing(spark, place.landing, "json", options.schema, options.read_options)
    expected = sorted((r.id, r.source_file_name) for r in batch.rows.collect())
    assert [o.records for o in stream(place, options)] == [3]
    found = spark.table(place.table)
    assert sorted((r.id, r.source_file_name) for r in found.collect()) == expected
    assert stream(place, options) == []
    put(place.landing, "kind=y/late.json", 4)
    os.utime(place.landing + "/kind=y/late.json", (1, 1))  # an old file that comes late
    assert [o.records for o in stream(place, options)] == [1]
    assert place.ids() == [1, 2, 3, 4]


def test_folders_named_as_columns_are_columns_of_both(place, spark):
    put(place.landing, "kind=x/day=1/c.json", 3)
    put(place.landing, "kind=y/day=2/sub/d.json", 4)
    batch = read_landing(spark, place.landing, "json").rows
    expected = [(3, "x", 1), (4, "y", 2)]
    assert sorted(map(tuple, batch.select("id", "kind", "day").collect())) == expected
    assert all(o.ok for o in stream(place))
    assert sorted(map(tuple, spark.table(place.table).select("id", "kind", "day").collect())) \
        == expected


def test_an_entity_whose_files_are_not_read_is_not_ok(place, spark, monkeypatch):
    put(place.landing, "e/a.json", 1)
    put(place.landing, "e/sub/b.json", 2)
    monkeypatch.setattr(incremental, "arriving_files", lambda s, path, *_a, **_k: arriving_files(
        s, path + "/sub"))  # a source that misses a file
    outcomes = ingest_new_all(
        spark, place.landing, place.lake, place.errors, place.landing + "_memory",
        Recorder(place.records), 1, 2, table_name=lambda e: place.table)
    assert [o.ok for o in outcomes] == [True, False]
    assert "a.json" in outcomes[1].steps[0].description


def test_times_cannot_choose_files_of_a_stream(place):
    with pytest.raises(ValueError, match="modifiedAfter"):
        stream(place, LoadOptions(read_options={"modifiedAfter": "2020-01-01T00:00:00"}))


def test_listing_does_not_open_files(place, spark):
    put(place.landing, "a.json", 1)
    plan = listed_files(spark, place.landing)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
