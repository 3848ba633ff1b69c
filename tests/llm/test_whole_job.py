"""Cases in which an operator once did less than its whole job."""

import collections
import gzip
import math
import re
import sys
from array import array
from pathlib import Path

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landinglake.llm import decontamination, language, ngram_join, packing, toxicity, warc
from landinglake.llm.queries import tokenizer_path
from landinglake.llm.tables import numbered

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402


def test_toxicity_compares_whole_texts(spark):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"W{w}" for w in rng.integers(0, 150, rng.integers(4, 30))) + ".")
            for i in range(60)]
    labels = [(i, int(i % 4 == 0)) for i in range(0, 40)]
    counts = {i: collections.Counter(re.findall("[a-z0-9]+", t.lower())) for i, t in rows}
    examples = dict(labels)
    frequency = collections.Counter(w for c in counts.values() for w in c)
    weight = {}
    for word in {w for i in examples for w in counts[i]}:
        a = sum(word in counts[i] for i, toxic in labels if toxic)
        b = sum(word in counts[i] for i, toxic in labels if not toxic)
        c, d = 10 - a, 30 - b
        link = (a * d - b * c) ** 2 / ((a + b) * (c + d) * 10 * 30) if c + d else 0
        weight[word] = 1 + toxicity.LINK * link

    def vector(i):
        own = {w: (1 + math.log(n)) * math.log1p(60 / (1 + frequency[w])) * weight.get(w, 1)
               for w, n in counts[i].items()}
        length = math.sqrt(sum(v * v for v in own.values()))
        return {w: v / length for w, v in own.items()}

    vectors = {i: vector(i) for i in counts}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    found = toxicity.score_toxicity(docs, model).collect()
    assert len(found) == 60
    for row in found:
        cosines = sorted((sum(v * vectors[e].get(w, 0) for w, v in vectors[row.doc_id].items())
                          for e in examples), reverse=True)[:toxicity.EVIDENCE]
        assert np.allclose([e.similarity for e in row.evidence], cosines)
        assert all(e.toxic == examples[e.doc_id] for e in row.evidence)

    def vote(doc, out=None):
        near = sorted(((sum(v * vectors[e].get(w, 0) for w, v in vectors[doc].items()), e)
                       for e in examples if e != out), reverse=True)[:toxicity.NEIGHBOURS]
        shares = [(1 / (toxicity.NEAR + max(0, 1 - c)), examples[e]) for c, e in near if c > 0]
        total = sum(s for s, _ in shares)
        return min(max(sum(s * y for s, y in shares) / total, 0.005), 0.995) if shares else None

    def logit(share):
        return math.log(share / (1 - share))

    own = [(vote(e, e), y) for e, y in examples.items()]
    own = [(logit(v), y) for v, y in own if v is not None]
    slope, shift = toxicity.logistic(np.array([v for v, _ in own]), np.array([y for _, y in own]),
                                     np.ones(len(own)))
    for row in found:
        expected = 1 / (1 + math.exp(-(slope * logit(vote(row.doc_id)) + shift)))
        assert math.isclose(row.score, expected, abs_tol=1e-9), (row, expected)
        assert row.predicted == (expected >= toxicity.THRESHOLD)


def test_derivatives_keep_the_headers_of_their_source(spark, folder, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\n<p>text</p>"
    given = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x>", "WARC-Target-URI": "u",
             "WARC-Date": "d", "WARC-Payload-Digest": "sha1:OTHER", "warc-block-digest": "md5:B",
             "WARC-IP-Address": "192.0.2.1", "WARC-Truncated": "length",
             "WARC-Identified-Payload-Type": "text/html", "X-Crawl": "a: b",
             "Content-Type": "application/http", "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in given.items()).encode()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(
        gzip.compress(b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"))
    derived = warc.derive(warc.responses(warc.read_warc(spark, folder + "/in")))
    rows = derived.collect()
    assert [r.warc_type for r in rows] == ["metadata", "conversion"]
    for row in rows:
        assert row.source_headers == given and row.source_digest == warc.digest(b"<p>text</p>")
        assert (row.source_payload_digest, row.source_block_digest) == ("sha1:OTHER", "md5:B")
    warc.write_warc(derived, folder + "/out")
    written = warc.read_warc(spark, folder + "/out/*.gz").collect()
    assert len(written) == 2
    for record in written:
        for name, value in given.items():
            if name not in ("WARC-Record-ID", "WARC-Target-URI", "WARC-Date"):
                field = "WARC-Source-" + re.sub("^WARC-", "", name, flags=re.I)
                assert record.headers[field] == value
        assert record.headers["WARC-Refers-To"] == "<urn:x>"
        own = next(r for r in rows if r.warc_type == record.headers["WARC-Type"])
        assert record.headers["WARC-Block-Digest"] == own.block_digest

    nothing = warc.page_responses(spark.createDataFrame(
        [(1, "u", "x")], "page_id bigint, url string, html string"), "d").selectExpr(
        "* except (headers)", "cast(null as map<string,string>) AS headers")
    rows = warc.derive(nothing)
    assert rows.filter("source_headers is null").count() == 2
    assert rows.select(warc.warc_text(rows).alias("t")).filter("t like 'WARC/1.1%x%'").count() == 2


def test_languages_of_many_scripts_are_told_apart(spark):
    rng = np.random.default_rng(11)
    # A long Latin text fills any small alphabet; the others have letters of their own.
    alphabets = {"la": [chr(c) for c in (*range(0x61, 0x7B), *range(0xE0, 0xF7),
                                         *range(0x101, 0x150, 2))],
                 "zh": [chr(0x4E00 + c) for c in range(300)],
                 "ja": [chr(0x3042 + c) for c in range(60)],
                 "ko": [chr(0xAC00 + 7 * c) for c in range(300)],
                 "go": [chr(0x10330 + c) for c in range(24)]}

    def text(letters, words):
        return " ".join("".join(rng.choice(letters, 4)) for _ in range(words))

    rows = [(i, lang, text(alphabets[lang], 400 if lang == "la" else 30))
            for i, lang in enumerate(list(alphabets) * 12)]
    docs = spark.createDataFrame([*rows, (99, None, chr(0x1F600) * 5)],
                                 "doc_id bigint, lang string, text string")
    model = language.fit(docs, F.col("doc_id") < 30, sample=20, landmarks=4)
    found = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [found[i].lang_pred for i, _, _ in rows] == [lang for _, lang, _ in rows]
    assert (found[99].lang_pred, found[99].score) == ("und", 0.0)


def test_grams_are_those_of_the_code_points():
    text = "Ab\u4e2d\u6587, \U00010330 1 b"
    symbols = [ord(c) + 1 if c.isalpha() else 1 for c in "ab\u4e2d\u6587 \U00010330 b"]
    expected = set()
    for n in (1, 2, 3):
        for at in range(len(symbols) - n + 1):
            value = 0
            for symbol in symbols[at:at + n]:
                value = value << 21 | symbol
            expected.add(value)
    assert language.present_grams(text, language.alphabet_table()).tolist() == sorted(expected)
    assert not len(language.present_grams("", language.alphabet_table()))


def test_classes_of_rows_without_id_and_of_an_id_with_three_texts(spark):
    def text(name, changed=0):
        return " ".join(f"{name}{i}" for i in range(60 - changed))

    rows = [(0, text("a")), (1, text("b")), (None, text("a", 2)), (None, text("b", 2)),
            (None, text("c")), (None, None), (5, text("x")), (5, text("y")), (5, text("z")),
            (5, text("x")), (6, text("x", 2)), (7, text("y", 2)), (8, text("z", 2)), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    expected = brute.classes(rows)
    assert {c for d, _, c in expected if d in (5, 6, 7, 8)} == {5}
    found = ngram_join.similarity_classes(docs).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_stages_act_on_rows_whatever_their_ids(spark, folder):
    def text(name, changed=0):
        return " ".join(f"{name}{i}" for i in range(60 - changed))

    schema = "doc_id bigint, text string, lang string, row_number string, File_Path string"
    spark.createDataFrame([(9, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        folder + "/labels.parquet")
    spark.createDataFrame([(1, text("item"))], "item_id bigint, text string").write.parquet(
        folder + "/benchmark.parquet")
    cases = [
        (corpus_pipeline.near_duplicates,
         [(None, text("a")), (None, text("a")), (1, text("a", 2)), (2, text("b")), (2, text("b")),
          (2, text("b")), (3, text("c")), (3, text("d")), (None, text("e")), (None, text("e")),
          (None, text("f")), (None, None)],
         [(1, text("a", 2)), (2, text("b")), (3, text("c")), (3, text("d")), (None, text("e")),
          (None, text("f")), (None, None)]),
        (corpus_pipeline.benchmark_leaks,
         [(None, text("item")), (4, text("g")), (4, text("item")), (None, text("h")), (5, None)],
         [(4, text("g")), (None, text("h")), (5, None)]),
        (corpus_pipeline.quality_rules,
         [(None, "short"), (6, "short"), (6, text("i")), (6, text("i")), (None, text("j"))],
         [(6, text("i")), (6, text("i")), (None, text("j"))])]
    for number, (stage, rows, expected) in enumerate(cases):
        frame = spark.createDataFrame([(*r, "en", "x", "y") for r in rows], schema).repartition(3)
        frame.write.parquet(f"{folder}/docs{number}")
        for docs in (frame, spark.read.parquet(f"{folder}/docs{number}"), frame.limit(0)):
            found = stage(spark, docs, folder)
            assert found.columns == docs.columns
            assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(
                expected if docs.count() else [], key=str)


def test_stages_start_no_further_kind_of_python_workers(spark, folder, monkeypatch):
    """A list of rows given to Spark starts workers that none of the other stages uses."""
    monkeypatch.setattr(type(spark.sparkContext), "parallelize",
                        lambda *_, **__: pytest.fail("rows of a list"))
    docs = spark.range(40).selectExpr("id as doc_id", "concat('a b c d e f ', id) as text")
    docs.write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    rows = numbered(docs, "row").collect()
    assert sorted(r.doc_id for r in rows) == list(range(40))
    assert len({r.row for r in rows}) == 40
    items = spark.sql("select 1L as item_id, 'a b c d e f 7' as text")
    assert decontamination.benchmark_matches(docs, items).count()


def test_tokens_are_kept_in_one_bounded_table(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 60)
    chunks = packing.ChunkIds(tokenizer_path("word_bpe_49k.json"))
    whole = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for i in range(200):
        text = (f"Word{i} word{i}, don't (won't) 'll ),' s'{i} <s> Éé{i}x ÉCOLE école. it's plain "
                f"{'xyzabc'[i % 6] * (1 + i % 9)} ½ 日本 {'qrst'[i % 4]}{chr(97 + i % 26)}\n\n!!")
        ids = array("I", chunks.ids(text)).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids
        held = len(chunks) + sum(len(x) for x in vars(chunks).values() if isinstance(x, dict))
        assert held <= 60
