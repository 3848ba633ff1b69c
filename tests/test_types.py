"""Alignment with the catalog, and what it loses."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landinglake.functions.times import add_time_parts, parse_time, utc_text
from landinglake.functions.types import align_columns, catalog_types, lenient_cast, lost_casts


def test_new_columns(spark):
    df = spark.sql("select 1 a, 2L b, 1.5D c, float(1.5) d, array(1) e, struct(1.5D as x) f")
    assert dict(align_columns(df).dtypes) == {
        "a": "bigint", "b": "bigint", "c": "decimal(38,6)", "d": "float", "e": "array<int>",
        "f": "struct<x:double>"}
    assert catalog_types(df, ["b"]) == (
        {"a": "bigint", "c": "double", "d": "float", "e": "array<int>", "f": "struct<x:double>"},
        {"b": "bigint"})


def test_known_columns_first_in_table_types(spark):
    df = spark.sql("select 'new' n, '7' a, 1.25D b, 3 c, 1.25D d, float(2.5) e")
    known = {"a": "bigint", "b": "double", "c": "double", "d": "string", "e": "double", "x": "int"}
    aligned = align_columns(df, known)
    assert aligned.dtypes == [
        ("a", "bigint"), ("b", "double"), ("c", "decimal(38,6)"), ("d", "string"),
        ("e", "decimal(38,6)"), ("n", "string")]
    row = aligned.first()
    assert (row.a, row.b, row.c, row.d, row.e) == (7, 1.25, Decimal("3.000000"), "1.25",
                                                   Decimal("2.500000"))


def test_lost_values_are_null_and_counted(spark):
    df = spark.sql("select * from values ('1', 1.0D), ('x', double('NaN')), (null, 1e33D), "
                   "('2', null), ('y', 99999999999999999999999999999999.0D) as t(a, b)")
    aligned = align_columns(df, {"a": "bigint"}).collect()
    assert [r.a for r in aligned] == [1, None, None, 2, None]
    assert [r.b is None for r in aligned] == [False, True, True, True, True]
    assert [r[0] for r in df.select(lost_casts(df, {"a": "bigint"})).collect()] == [0, 2, 1, 0, 2]
    assert df.select("a").select(lost_casts(df.select("a"))).first()[0] == 0


TEXTS = ["1", "-1", "+7", " 12 ", "12.5", "-12.9", ".5", "-.5", "5.", ".", "+.", "-.", " . ", "", " ", "+", "-", "1e3",
         "1.5E2", "1e", "0x1", "1 2", "1.2.3", "9223372036854775807", "9223372036854775808",
         "-9223372036854775808", "300", "99999999999999999999999999", "NaN", "Infinity", "١",
         "1d", "1.0f", "--1", "1_000", "\t3\n", "0007", "1234567.1234565", "1" * 40]


@pytest.mark.parametrize("target", ["bigint", "int", "smallint", "tinyint", "decimal(38,6)",
                                    "double", "boolean", "date", "timestamp"])
def test_text_casts_as_without_ansi(spark, target):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, "true", "n", "2024-02-29", "2024-2-9 1:2"]], "t string")
    ours = {r.t: r.c for r in df.select("t", F.expr(lenient_cast("t", "string", target)).alias("c")).collect()}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        theirs = {r.t: r.c for r in df.selectExpr("t", f"cast(t as {target}) c").collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    same = lambda a, b: a == b or (a != a and b != b)
    assert {t: (ours[t], theirs[t]) for t in ours if not same(ours[t], theirs[t])} == {}


def test_quoted_names(spark):
    df = spark.sql("select 1.5D `a b`, 'x' `select`")
    assert align_columns(df, {"select": "bigint"}).columns == ["select", "a b"]


def test_times(spark):
    df = spark.sql("select * from values ('2024-02-29 23:59:59.123456'), ('2024-02-30'), ('x'), "
                   "(null) as t(s)")
    rows = df.select(utc_text(parse_time(F.col("s"))).alias("t")).collect()
    assert [r.t for r in rows] == ["2024-02-29 23:59:59.123456", None, None, None]
    epoch = spark.sql("select 86400L s, 1.5D f").select(
        parse_time(F.col("s")).alias("t"), utc_text(parse_time(F.col("f"))).alias("f"))
    parts = add_time_parts(epoch, "t").first()
    assert (parts.year, parts.month, parts.day, parts.hour) == (1970, 1, 2, 0)
    assert parts.f == "1970-01-01 00:00:01.500000"
