"""The filter audit against a walk through all orders, document by document."""

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from landinglake.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    """{row number: letters} of rows (doc_id, text, lang)."""
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    for doc, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        tests = (len(words) < 100, 100 * len(set(words)) < 80 * len(words),
                 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                 bool(re.search(r"[#$%&*|]", text)), doc is not None and least[text] < doc)
        yield {f for f, bad in zip("ABCDE", tests) if bad}


def walk(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    found, shapley = {}, Counter()
    parts = {lang or "" for _, _, lang in rows}
    fails = list(failing(rows))
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in parts:
            left = [i for i, r in enumerate(rows) if (r[2] or "") == part]
            own = set(left)
            for step, letter in enumerate(order, 1):
                hit = [i for i in left if letter in fails[i]]
                left = [i for i in left if letter not in fails[i]]
                shapley[part, letter] += len(hit)
                found[part, order, step] = (
                    letter, len(left), len(hit),
                    sum(letter in fails[i] for i in own) - len(hit),
                    sum(fails[i] == {letter} for i in own),
                    sum(rows[i][0] in good for i in hit), sum(rows[i][0] in toxic for i in hit))
    return sorted((p, o, s, *f, shapley[p, f[0]]) for (p, o, s), f in found.items())


COLUMNS = ("part", "filter_order", "step", "filter", "kept", "removed", "redundant",
           "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("docs", ["awkward", "small", "nothing"])
def test_every_order_and_step(spark, request, docs):
    docs = request.getfixturevalue(docs)
    labels = [(i, i % 3, i % 2) for i in range(25)] + [(3, 1, 0), (4, 1, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn(
        "text", F.lit("x"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    found = filter_audit.filter_interactions(docs, frame)
    assert found.columns == list(COLUMNS)
    assert sorted(map(tuple, found.collect())) == walk(rows, labels)


def test_copies_and_repeated_rows(spark):
    prose = " ".join(f"w{i}" for i in range(150))
    rows = [*((i, prose, "en") for i in range(50)), (0, prose, "en"), (7, prose, "de"),
            (None, prose, "en"), (None, None, None), (60, None, "en"), (61, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    labels = [(d, 1, 1) for d in range(0, 60, 4)]
    found = filter_audit.filter_interactions(
        docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert sorted(map(tuple, found.collect())) == walk(rows, labels)
    first = found.filter("part = 'en' and filter_order = 'EABCD' and step = 1").first()
    assert (first.removed, first.unique_fails) == (50, 49)


def test_intervals_cover_every_order_once_per_mask():
    orders = list(itertools.permutations(range(5)))
    seen = {}
    for mask, step, bit, first, last in filter_audit.order_intervals():
        for rank in range(first, last):
            assert (mask, rank) not in seen
            seen[mask, rank] = (step, bit)
    for mask in range(32):
        for rank, order in enumerate(orders):
            expected = next(((step, bit) for step, bit in enumerate(order, 1) if mask >> bit & 1),
                            None)
            assert seen.get((mask, rank)) == expected
