"""Documents with every awkward case, and workers that can import the package."""

import pytest

from landinglake.llm.tables import show_package

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    show_package(spark)


def awkward_rows():
    prose = " ".join(f"word{i % 97}x{i % 31}" for i in range(120))
    near = prose.replace("word5x5", "changed")
    secret = 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" and é'
    texts = [None, "", " \t\n ", "one", "Three little words", prose, prose, near, near.upper(),
             "a\nb\n\na\nb\n", secret, secret, f"x {secret} password: abc, AKIA{'Z' * 16}",
             "ééé ßß 日本語 no spaces", "\x00 odd\x1cbytes\x85 here", "<|endoftext|> <s> ▁ text",
             " ".join([prose] * 40), "z" * 200_000, prose + " " + " ".join("tail%d" % i for i in range(80)),
             "123 456 !!! ###"]
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 4}" if i % 5 else None, len(t or ""))
            for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, "no id at all here", None, None, None), (7, "same id", "en", "s", 7)]


@pytest.fixture(scope="session")
def awkward(spark):
    """All awkward rows, with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)
    extra = ("key", "spans", "part", "value", "n", "_id", "_key", "_spans", "words", "row_id",
             "label", "quality", "stratum", "windows", "set_id")
    return frame.withColumns({name: F.lit("x") for name in extra})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    from landinglake.llm.tables import documents

    return documents(spark, "/root/testdata/sf0.001")
