"""Overwrites under readers, loads taken back, and folders that go after their time."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from landinglake.operators.journal import LoadMarker, dead_loads
from landinglake.operators.swap import partition_names
from landinglake.plans.publish import publish
from landinglake.sources.lake import find_table


class Refused(Exception):
    pass


def refuse(_published):
    raise Refused


def version(spark, number, days, rows=400):
    return spark.range(rows).selectExpr(f"{number} as version", "id as v",
                                        f"id % {days} + {number} as day")


@pytest.mark.parametrize("partition_cols", [[], ["day"]])
def test_readers_see_one_version_during_twenty_overwrites(spark, folder, new_table, partition_cols):
    """Each version has other days; a reader never misses the table and never sees two versions."""
    publish(version(spark, 0, 5), new_table, folder, partition_cols=partition_cols)
    seen, faults, over = set(), [], threading.Event()

    def read():
        while not over.is_set():
            try:
                found = spark.table(new_table).groupBy("version").count().collect()
                if len(found) != 1 or found[0]["count"] != 400:
                    faults.append(found)
                seen.add(found[0].version)
            except Exception as error:  # noqa: BLE001 - whatever it is, a reader must not get it
                faults.append(error)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    try:
        for number in range(1, 21):
            publish(version(spark, number, 3 + number % 4), new_table, folder, mode="overwrite",
                    partition_cols=partition_cols)
    finally:
        over.set()
        for reader in readers:
            reader.join()
    assert not faults, faults[:1]
    assert len(seen) > 3
    assert {r.version for r in spark.table(new_table).collect()} == {20}
    if partition_cols:
        assert partition_names(spark, new_table) == {f"day={d}" for d in range(20, 23)}


def data_folders(folder):
    return sorted(n for n in os.listdir(folder) if not n.startswith(("_", ".")))


def test_former_folders_go_after_the_grace_time(spark, folder, new_table):
    publish(version(spark, 0, 2), new_table, folder, partition_cols=["day"])
    publish(version(spark, 1, 2), new_table, mode="overwrite", partition_cols=["day"])
    assert {"day=0", "day=1"} < set(data_folders(folder))
    held = spark.table(new_table)
    publish(version(spark, 2, 2), new_table, mode="overwrite", partition_cols=["day"])
    assert held.count() == 400
    assert len([n for n in data_folders(folder) if n.startswith("snapshot-")]) == 2
    publish(version(spark, 3, 2), new_table, mode="overwrite", partition_cols=["day"], grace=0)
    assert data_folders(folder) == [os.path.basename(find_table(spark, new_table).location)]


def test_loads_after_an_overwrite_go_to_its_folder(spark, folder, new_table):
    publish(version(spark, 0, 2), new_table, folder, partition_cols=["day"])
    publish(version(spark, 1, 2), new_table, folder, mode="overwrite", partition_cols=["day"])
    publish(version(spark, 5, 1, 7), new_table, folder, partition_cols=["day"], load_id="more")
    publish(version(spark, 5, 1, 7), new_table, folder, partition_cols=["day"], load_id="more")
    publish(version(spark, 1, 1, 9), new_table, folder, partition_cols=["day"], mode="dynamic")
    found = {(r.version, r.day): r["count"] for r in
             spark.table(new_table).groupBy("version", "day").count().collect()}
    assert found == {(1, 1): 9, (1, 2): 200, (5, 5): 7}


def test_an_overwrite_changes_columns(spark, folder, new_table):
    publish(spark.sql("select 1 a, 'x' gone, 1 day"), new_table, folder, partition_cols=["day"])
    publish(spark.sql("select '2' a, 2.5D fresh, 1 day"), new_table, mode="overwrite",
            partition_cols=["day"])
    assert spark.table(new_table).columns == ["a", "fresh", "day"]
    assert [(r.a, float(r.fresh), r.day) for r in spark.table(new_table).collect()] == [(2, 2.5, 1)]
    assert dict(spark.table(new_table).dtypes)["a"] == "bigint"


def test_odd_partition_values_move_along(spark, folder, new_table):
    values = ["a b/c", None, "it's", "x:y=z%", "", "ü"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "v int, p string")
    publish(df, new_table, folder, partition_cols=["p"])
    publish(df.filter("v < 5").withColumn("v", F.col("v") + 10), new_table, mode="overwrite",
            partition_cols=["p"])
    assert sorted((r.v, r.p) for r in spark.table(new_table).collect()) == [
        (10, "a b/c"), (11, None), (12, "it's"), (13, "x:y=z%"), (14, None)]


def catalog_state(spark, table):
    found = find_table(spark, table)
    parts = partition_names(spark, table) if found.partition_cols else set()
    return found.schema, found.location, parts, sorted(map(tuple, spark.table(table).collect()))


@pytest.mark.parametrize("mode", ["append", "dynamic", "overwrite"])
@pytest.mark.parametrize("partition_cols", [[], ["day"]])
def test_a_load_that_fails_after_registration_leaves_the_catalog(
        spark, folder, new_table, mode, partition_cols):
    publish(version(spark, 0, 3, 30), new_table, folder, partition_cols=partition_cols)
    before = catalog_state(spark, new_table)
    with pytest.raises(Refused):
        publish(version(spark, 1, 6, 40).withColumn("fresh", F.lit("x")), new_table, mode=mode,
                partition_cols=partition_cols, check=refuse)
    assert catalog_state(spark, new_table) == before
    publish(version(spark, 1, 6, 40), new_table, mode=mode, partition_cols=partition_cols)
    assert spark.table(new_table).filter("version = 1").count() == 40


def test_a_first_load_that_fails_leaves_no_table(spark, folder, new_table):
    with pytest.raises(Refused):
        publish(version(spark, 0, 3), new_table, folder, partition_cols=["day"], check=refuse)
    assert find_table(spark, new_table) is None
    publish(version(spark, 0, 3), new_table, folder, partition_cols=["day"])
    assert spark.table(new_table).count() == 400


@pytest.mark.parametrize("mode", ["append", "dynamic", "overwrite"])
@pytest.mark.parametrize("load_id", [None, "run-7"])
def test_the_next_load_takes_back_one_whose_driver_died(
        spark, folder, new_table, monkeypatch, mode, load_id):
    """Nothing runs after the registration: no undo, no marker of the end."""
    import landinglake.plans.publish as module

    publish(version(spark, 0, 3, 30), new_table, folder, partition_cols=["day"])
    before = catalog_state(spark, new_table)
    with monkeypatch.context() as patched:
        patched.setattr(LoadMarker, "undo", lambda *_: 0)
        patched.setattr(module, "remove_published", lambda *_: 0)
        patched.setattr(module.Storage, "delete", lambda *_: False)
        with pytest.raises(Refused):
            publish(version(spark, 1, 6, 40).withColumn("fresh", F.lit("x")), new_table, folder,
                    mode=mode, partition_cols=["day"], load_id=load_id, check=refuse)
    assert catalog_state(spark, new_table) != before and len(dead_loads(spark, folder)) == 1
    publish(version(spark, 2, 1, 5), new_table, folder, partition_cols=["day"], load_id="next")
    assert dead_loads(spark, folder) == []
    found = catalog_state(spark, new_table)
    assert found[0] == before[0] and found[2] == before[2] | {"day=2"}
    expected = before[3] if mode != "dynamic" else before[3]
    assert found[3] == sorted([*expected, *((2, v, 2) for v in range(5))])
