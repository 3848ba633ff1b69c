"""Job metadata queries against loops over plain rows, with duplicates, nulls and skew."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from landinglake.operators import audit, metastore, sinks
from landinglake.sources.lake import query_rows, read_snapshot, snapshots


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def world():
    """A third of all runs and edges belong to one job; some ids repeat, some are null."""
    chance = random.Random(5)
    job = lambda: 7 if chance.random() < 0.34 else chance.randrange(12)
    runs = [(i, chance.randrange(3), job(), chance.choice("RSFI")) for i in range(300)]
    runs += [(300, 1, 2, None), (301, 1, None, "R"), (5, *runs[5][1:])]
    jobs = [(i, f"job {i}", i % 3) for i in range(11)] + [(4, "job 4", 1), (9, "again", 0)]
    classes = [(i, f"class {i}") for i in range(3)] + [(1, "class 1")]
    edges = [(chance.randrange(3), job(), chance.choice([None, job(), job()])) for _ in range(60)]
    return runs, jobs, classes, edges


def tables(spark, world):
    runs, jobs, classes, edges = world
    return (frame(spark, runs, "id bigint, process_execution_id bigint, jobs_id bigint, jobs_status string"),
            frame(spark, jobs, "id bigint, name string, jobs_execution_class_id bigint"),
            frame(spark, classes, "id bigint, name string"),
            frame(spark, edges, "process_id bigint, jobs_id bigint, parent_jobs_id bigint"))


def newest(runs, run_id):
    latest = {}
    for i, process, job, status in sorted(runs, key=lambda r: r[0]):
        if run_id is None or process == run_id:
            latest[job] = status
    return latest


@pytest.mark.parametrize("run_id", [None, 1])
def test_latest_status(spark, world, run_id):
    got = metastore.latest_status(tables(spark, world)[0], run_id).collect()
    assert {r.jobs_id: r.job_status for r in got} == newest(world[0], run_id)
    assert len(got) == len(newest(world[0], run_id))


@pytest.mark.parametrize("run_id, own", [(None, False), (1, False), (1, True)])
def test_ready_jobs(spark, world, run_id, own):
    runs, jobs, classes, edges = world
    latest, expected = newest(runs, run_id), defaultdict(list)
    for i, process, job, status in runs:
        if status != "R" or (own and process != run_id):
            continue
        for job_id, name, class_id in jobs:
            for cid, class_name in classes:
                for _, edge_job, parent in edges:
                    if job_id == job and cid == class_id and edge_job == job:
                        expected[i, process, job, name, class_name, status].append(
                            latest.get(parent) if parent is not None else None)
    expected = Counter((*key, sum(s is not None for s in states), *(states.count(x) for x in "SFRI"))
                       for key, states in expected.items())
    got = metastore.ready_jobs(*tables(spark, world), run_id=run_id, own_run_only=own)
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_job_params(spark):
    got = metastore.job_params(
        frame(spark, [(1, "j1", 10), (2, "j2", 10), (3, "j3", 99)],
              "id bigint, name string, jobs_execution_class_id bigint"),
        frame(spark, [(10, "c"), (10, "c")], "id bigint, name string"),
        frame(spark, [(100, 10, "PATH", "/<application>/<subscriber>", 1), (101, 10, "Mode", None, 0)],
              "id bigint, jobs_execution_class_id bigint, name string, default_param_value string, is_mandatory int"),
        frame(spark, [(5, 1, None), (5, 1, 2), (5, 2, None), (6, 2, None)],
              "process_id bigint, jobs_id bigint, parent_jobs_id bigint"),
        frame(spark, [(5, 50, 500), (6, 50, 501)], "id bigint, subsriber_id bigint, applications_id bigint"),
        frame(spark, [(50, "sub")], "id bigint, name string"),
        frame(spark, [(500, "app"), (501, "other")], "id bigint, name string"),
        frame(spark, [(1, 101, "<subscriber>!"), (2, 100, None), (1, 999, "x")],
              "jobs_id bigint, jobs_execution_class_param_id bigint, param_value string"), process_id=5)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (1, "j1", "path", "/app/sub", 1), (1, "j1", "mode", "sub!", 0),
        (2, "j2", "path", "/app/sub", 1), (2, "j2", "mode", None, 0)], key=str)


def test_timeline_entities(spark):
    names = lambda *n: frame(spark, [(x,) for x in n], "entity string")
    got = metastore.timeline_entities(
        frame(spark, [("a", "Enabled"), ("a", "Enabled"), ("b", "enabled"), ("c", "Enabled"),
                      (None, "Enabled"), ("d", "Enabled")], "entity string, status string"),
        names("a", "a", "b", "c", None), names("a", "a", "b", "d", None))
    assert [r.entity for r in got.collect()] == ["a"]


def test_run_entities(spark):
    mapping = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (1, None)], "process_execution_id int, entity string")
    assert {r.entity for r in metastore.run_entities(mapping, 1).collect()} == {"a", None}
    row = metastore.entity_mapping(spark, 3, "it's")
    assert [r.entity for r in metastore.run_entities(mapping.union(row), 3).collect()] == ["it's"]


def test_status_changes(spark):
    runs = frame(spark, [(1, "R"), (2, "R"), (3, "R"), (None, "R")], "id bigint, jobs_status string").withColumns(
        {"jobs_start_dt": F.lit(None).cast("timestamp"), "jobs_end_dt": F.lit(None).cast("timestamp"),
         "updated_dt": F.lit(None).cast("timestamp"), "updated_by": F.lit("me")})
    changes = frame(spark, [(1, 1, "I"), (2, 2, "I"), (2, 1, "F"), (9, 1, "I"), (3, 1, None)],
                    "id bigint, seq int, status string")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    started = metastore.start_jobs(runs, changes, now)
    got = {r.id: (r.jobs_status, r.jobs_start_dt is not None, r.jobs_end_dt is not None, r.updated_by)
           for r in started.collect()}
    signed = metastore.UPDATED_BY
    assert got == {1: ("I", True, False, signed), 2: ("I", True, False, signed),
                   3: (None, True, False, signed), None: ("R", False, False, "me")}
    ended = metastore.end_jobs(started, changes.filter("id = 2"), now).collect()
    assert {r.id for r in ended if r.jobs_end_dt} == {2}
    assert metastore.start_jobs(runs, changes).filter("jobs_start_dt <= now()").count() == 3


def test_snapshots(spark, folder):
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, folder)
    sinks.write_snapshot(spark.range(1), folder)
    for _ in range(3):
        old = read_snapshot(spark, folder)
        sinks.write_snapshot(old.selectExpr("id + 1 as id"), folder)
    assert [r.id for r in read_snapshot(spark, folder).collect()] == [3]
    assert snapshots(spark, folder) == [3, 4]


def test_query_rows(spark):
    df = frame(spark, [(1, "x"), (2, "o'clock")], "id int, name string")
    got = query_rows(spark, "select id from {t} where name = :name", {"name": "o'clock"}, t=df)
    assert [r.id for r in got.collect()] == [2]


def test_step_cells(spark):
    cells = frame(spark, [(1, '[["e","s","1","2","Success",null],["e","t","3","4","Failed: x","d"]]'),
                          (2, "[]"), (3, None), (4, "[[\"e\",\"s\",7]]"), (5, "__import__('os')")],
                  "k int, cell string")
    got = sorted(map(tuple, audit.parse_step_cells(cells, "cell", "k").collect()), key=str)
    assert got == [(1, "e", "s", "1", "2", "Success", None), (1, "e", "t", "3", "4", "Failed: x", "d"),
                   (4, "e", "s", "7", None, None, None)]
    steps = audit.parse_step_cells(cells, "cell", "k")
    assert {r.k: r.any_failed for r in audit.any_failed(steps, "k").collect()} == {1: True, 4: False}


def test_step_cells_as_tuples(spark):
    chance = random.Random(3)
    texts = ["Success", "Failed", "it's", 'a "b"', "(x)", "None", "f('y', [1])", "", "\\", "é, ü", None,
             "x" * 20_000, "None)", "a\\'b\"c("]
    answers = {k: [tuple(chance.choice(texts) for _ in range(6)) for _ in range(chance.randrange(5))]
               for k in range(200)}
    cells = [(k, repr(v if k % 2 else tuple(v))) for k, v in answers.items()]
    got = audit.parse_step_cells(frame(spark, cells, "k int, cell string"), "cell", "k").collect()
    expected = Counter((k, *row) for k, rows in answers.items() for row in rows)
    assert Counter(tuple(r) for r in got) == expected


def test_step_frames(spark):
    step = audit.Step.start("e", "s").end(audit.FAILED, "why")
    row = audit.step_frame(spark, [step], 3).first()
    assert (row.entity, row.status, row.description, row.jobs_execution_id) == ("e", "Failed", "why", 3)
    assert row.start_dt <= row.end_dt and len(row.start_dt) == 26
    other = spark.sql("select 'x' entity, 'Success' status")
    assert audit.union_steps(audit.step_frame(spark, [step]), other).count() == 2
