"""Landing folders: formats, malformed records, profile, listing."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landinglake.operators import quality
from landinglake.plans.ingest import stage
from landinglake.sources.landing import (CORRUPT_RECORD, SOURCE_FILE, entity_files, landing_files,
                                         read_landing)
from landinglake.storage import fresh_folder, scratch_root


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)
    return path


def rejects(staged):
    return sorted(r[0] for r in quality.rejected_rows(staged.rows).collect())


def test_mixed_json(spark, folder):
    put(folder, "a.json", '{"a": 1, "b": {"c": [1, 2]}, "gone": null}\n{"a": 2, "b"\n\n{}\n')
    put(folder, "b.json", 'no json\n{"a": 3, "t": true}\n')
    landing = read_landing(spark, folder, "json")
    assert sorted(landing.payload) == ["a", "b", "gone", "t"]
    staged = stage(landing, run_id=9)
    assert (staged.records, staged.rejects) == (5, 2)
    assert rejects(staged) == ["no json", '{"a": 2, "b"']
    assert staged.profile == {"a": 2, "b": 1, "gone": 0, "t": 1, SOURCE_FILE: 5,
                              "process_execution_id": 5}
    good = quality.accepted_rows(staged.rows)
    assert {(r.a, r.process_execution_id) for r in good.collect()} == {(1, 9), (3, 9)}
    assert sorted(os.path.basename(f) for f in landing.files) == ["a.json", "b.json"]
    assert {os.path.basename(r[0]) for r in good.select(SOURCE_FILE).collect()} == {"a.json", "b.json"}


@pytest.mark.parametrize("multiline", ["false", "true"])
def test_only_malformed_json(spark, folder, multiline):
    put(folder, "a.json", "x\n\ny\n")
    landing = read_landing(spark, folder, "json", options={"multiLine": multiline})
    assert landing.payload == []
    staged = stage(landing, run_id=1)
    assert rejects(staged) == (["x", "y"] if multiline == "false" else ["x\n\ny\n"])
    assert staged.records == staged.rejects


def test_empty_files(spark, folder):
    put(folder, "a.json", "")
    staged = stage(read_landing(spark, folder, "json"), run_id=1)
    assert (staged.records, staged.rejects) == (0, 0)


def test_csv_with_header_infers_and_rejects(spark, folder):
    put(folder, "a.csv", 'id,name,at\n1,"a, b",2024-01-01\n2\n3,c,2024-01-02,more\n')
    landing = read_landing(spark, folder, "csv", options={"header": "true"})
    assert dict(landing.rows.dtypes)["id"] == "int"
    staged = stage(landing, run_id=1)
    assert rejects(staged) == ["2", "3,c,2024-01-02,more"]
    assert [r.name for r in quality.accepted_rows(staged.rows).collect()] == ["a, b"]


def test_csv_without_header(spark, folder):
    put(folder, "a.csv", "1,x\n2,y\n")
    staged = stage(read_landing(spark, folder, "csv"), run_id=1)
    assert {tuple(r) for r in staged.rows.select("_c0", "_c1").collect()} == {(1, "x"), (2, "y")}


def test_xml(spark, folder):
    put(folder, "a.xml", "<all><row><a>1</a></row><row><a>2</a><b>x</b></row></all>")
    landing = read_landing(spark, folder, "xml", options={"rowTag": "row"})
    staged = stage(landing, run_id=1)
    assert {(r.a, r.b) for r in staged.rows.collect()} == {(1, None), (2, "x")}


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
def test_columnar_sources(spark, folder, file_format):
    path = folder + "/in"
    spark.range(10).withColumn("x", F.lit("a")).write.format(file_format).save(path)
    staged = stage(read_landing(spark, path, file_format), run_id=1)
    assert (staged.records, staged.rejects, staged.rows.count()) == (10, 0, 10)


def test_given_schema_saves_inference_and_sorts_out_misfits(spark, folder):
    put(folder, "a.json", '{"a": 1}\n{"a": "x"}\n')
    schema = StructType.fromDDL("a bigint, b string")
    staged = stage(read_landing(spark, folder, "json", schema), run_id=1)
    assert rejects(staged) == ['{"a": "x"}']


def test_odd_names_survive_staging(spark, folder):
    put(folder, "a.json", '{"a b": 1, "x.y": 2, "é À": 3, "p`q": 4, "s,t;u": 5, "n": null}\n')
    staged = stage(read_landing(spark, folder, "json"), run_id=1)
    assert staged.profile["x.y"] == staged.profile["p`q"] == 1
    assert quality.drop_null_columns(staged.rows, staged.profile).first()["x.y"] == 2


def test_listing(spark, folder):
    for name in ("one/a.json", "one/b.json", "two/deep/er/c.json", "loose.json", "two/_hidden"):
        put(folder, name, "{}")
    os.makedirs(folder + "/empty")
    found = {(r.entity, r.files, r.bytes) for r in entity_files(spark, folder).collect()}
    assert found == {("one", 2, 4), ("two", 1, 2)}
    assert {r.entity for r in entity_files(spark, folder + "/", ["one"]).collect()} == {"two"}
    assert landing_files(spark, "file://" + folder).count() == 3


def test_listing_does_not_open_files(spark, folder):
    put(folder, "one/a.bin", "x" * 100)
    plan = entity_files(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_profile_counts_every_type(spark):
    df = spark.sql("select * from values (1, true, timestamp'2024-01-01', array(1), named_struct('x', 1)), "
                   "(null, null, null, null, null) as t(i, b, t, a, s)").withColumn("x.y", F.lit(None))
    counts = {r.column_name: r.non_null_cnt for r in quality.column_profile(df).collect()}
    assert counts == {"i": 1, "b": 1, "t": 1, "a": 1, "s": 1, "x.y": 0}
    assert quality.drop_null_columns(df).columns == ["i", "b", "t", "a", "s"]


def test_blank_rows_ignore_technical_columns(spark):
    df = spark.sql("select * from values (1, null, 7), (null, null, 7), (null, 'x', 7) as t(a, b, run)")
    assert quality.drop_blank_rows(df, ["a", "b"]).count() == 2
    assert df.filter(quality.has_payload(["a", "b"])).count() == 2


def test_reject_summary(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "y"), ("b", "z")],
                               f"entity string, {CORRUPT_RECORD} string")
    rows = {r.entity: (r.records_cnt, r.reject_records_cnt, r.all_rejected)
            for r in quality.reject_summary(df, "entity").collect()}
    assert rows == {"a": (2, 1, False), "b": (2, 2, True)}
    assert quality.reject_summary(df.limit(0)).first().all_rejected is False


def test_scratch_follows_the_session(spark, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == configured
    assert fresh_folder(spark, "a/b c").startswith(configured + "/a-b-c-")


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda _key, default: default)

    class sparkContext:
        master = "yarn"


def test_no_machine_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(_Cluster())
