"""Periodic runs against a search through all periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from landinglake.llm import periodic
from landinglake.llm.queries import QUERIES, with_planted_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def all_runs(words, least=12):
    """Sorted (start, length, period)."""
    n, found = len(words), {}
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            if j > i and j + period - i >= max(least, 2 * period):
                found.setdefault((i, j + period - i), period)
            i = j + 1
    return sorted((i, length, q) for (i, length), q in found.items())


def collapsed(words, runs):
    drop = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def changed(doc, text):
    """Words of a text after the query's own rule."""
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("docs", ["awkward", "small", "nothing"])
def test_runs_and_collapsed_texts(request, docs):
    docs = request.getfixturevalue(docs)
    rows = [r for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 9000]
    found = periodic.periodic_runs(docs).collect()
    long = {r.doc_id for r in docs.collect() if len(r.text or "") >= 9000}  # see the test below
    found, rows = ([r for r in x if r.doc_id not in long] for x in (found, rows))
    expected = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        runs = all_runs(words)
        expected.append((doc, len(words), runs, collapsed(words, runs)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text)
                   for r in found), key=str) == sorted(expected, key=str)


def nested(rng, size):
    """Repeats of repeats, cut short."""
    words = []
    while len(words) < size:
        unit = rng.integers(0, 3, rng.integers(1, 9)).tolist() * int(rng.integers(1, 6))
        words += unit[:int(rng.integers(1, len(unit) + 1))] * int(rng.integers(1, 4))
        if not rng.integers(3):
            words += words
    return words[:size]


def test_nested_repeats_of_many_texts():
    rng = np.random.default_rng(11)
    for _ in range(150):
        texts = [nested(rng, int(rng.integers(0, 150))) for _ in range(4)]
        values, expected, at = [], [], 0
        for number, text in enumerate(texts):
            values += [number * 100 + w for w in text] + [10**9 + number]
            expected += [(at + i, length, q) for i, length, q in all_runs(text)]
            at += len(text) + 1
        found = periodic.find_runs(np.array(values, np.uint64))
        assert sorted(zip(*(x.tolist() for x in found))) == sorted(expected)


def test_long_runs_and_words_of_neighbouring_texts(spark):
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    texts = {0: "x " * 50_000, 1: " ".join(map(str, range(700))) * 1 + " ",
             2: (" ".join(map(str, range(701))) + " ") * 9, 3: " ".join(fib[-1][:400]), 4: "x x",
             5: "x " * 11, 6: "x " * 12}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1)
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic_runs(docs).collect()}
    assert found[0] == [(0, 50_000, 1)] and found[1] == [] and found[4] == [] and found[5] == []
    assert found[2] == [(0, 6309, 701)] and found[6] == [(0, 12, 1)]
    assert found[3] == all_runs(fib[-1][:400])


def test_range_successor():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 64, 300):
        values = rng.permutation(size)
        ask = periodic.RangeSuccessor(values)
        low = rng.integers(0, size, 200)
        high = low + rng.integers(0, size - low + 1)
        x = rng.integers(0, size + 3, 200)
        expected = [min((v for v in values[a:b] if v >= y), default=-1)
                    for a, b, y in zip(low, high, x)]
        assert ask(low, high, x).tolist() == expected


def test_query_rows(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(folder + "/documents.parquet")
    texts = {r.doc_id: r.text for r in with_planted_repeats(docs).collect()}
    found = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    for doc, text in ((r.doc_id, r.text) for r in rows if len(r.text or "") < 6000):
        words = changed(doc, text)
        assert WORD.findall(texts[doc] or "") == words
        runs = all_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))
        row = found[doc]
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(
            collapsed(words, runs).encode()).hexdigest()


def test_planted_rule_on_awkward_rows(awkward):
    by_id = {}
    for row in awkward.collect():
        by_id.setdefault(row.doc_id, []).append(changed(row.doc_id, row.text))
    for row in with_planted_repeats(awkward).collect():
        assert WORD.findall(row.text or "") in by_id[row.doc_id]
