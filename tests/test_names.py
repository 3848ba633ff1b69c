"""Clean names: hand cases, the rule stated on its own, driver and column in step."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landinglake.errors import NameCollision
from landinglake.functions.names import _FOLD_END, accent_table, clean_columns, clean_name, clean_text

CASES = {
    "CustomerID": "customer_id", "HTTPServer": "httpserver", "é À name": "e_a_name",
    "a--b": "a_b", "x.y": "x_y", "order2Line": "order2_line", "": "", "漢字": "_",
    "İstanbul": "istanbul", "ǅungla": "_ungla", "_x_": "_x_", "K": "k", "éA": "e_a",
    "a b": "a_b", "ﬁt": "_t", "\U0001f600x": "_x",
}


def by_steps(name: str) -> str:
    """The rule character by character, without tables or patterns."""
    letters = [c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn"]
    out = ""
    for c in letters:
        if c.isascii() and (c.isalnum() or c == "_"):
            out += c
        elif not out.endswith("\0"):
            out += "\0"
    out = out.replace("\0", "_")
    split, previous_used = "", False
    for i, c in enumerate(out):
        hump = i > 0 and c.isupper() and (out[i - 1].islower() or out[i - 1].isdigit())
        split += "_" + c if hump else c
    return split.lower()


@pytest.mark.parametrize("raw, clean", CASES.items())
def test_hand_cases(raw, clean):
    assert clean_name(raw) == clean == by_steps(raw)


@given(st.text())
def test_driver_rule(text):
    assert clean_name(text) == by_steps(text)


def test_no_ascii_base_beyond_the_table():
    for code in range(_FOLD_END, 0x110000):
        assert not unicodedata.normalize("NFD", chr(code))[0].isascii()
    assert len(accent_table()) == 490


def test_column_rule_is_the_driver_rule(spark):
    samples = list(CASES)

    @settings(max_examples=500, database=None)
    @given(st.text(st.characters(exclude_categories=["Cs"])))
    def gather(text):
        samples.append(text)

    gather()
    rows = spark.createDataFrame([(s,) for s in samples], "raw string")
    for row in rows.select("raw", clean_text("raw").alias("clean")).collect():
        assert row.clean == clean_name(row.raw), repr(row.raw)


def test_columns_and_collisions(spark):
    df = spark.range(1).select(F.lit(1).alias("CustomerID"), F.lit(2).alias("x.y"))
    assert clean_columns(df).columns == ["customer_id", "x_y"]
    with pytest.raises(NameCollision, match="a-b.*a b"):
        clean_columns(df.toDF("a-b", "a b"))
