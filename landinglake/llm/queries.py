"""One registered query per training-data operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.llm import (cover_join, decontamination, filter_audit, language, ngram_join, packing,
                             periodic, quality_risk, secret_scan, substrings, token_counts, toxicity, warc)
from landinglake.llm.oracles import ORACLES
from landinglake.llm.tables import documents, show_package

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed value: the pages carry no date of their own.
WARC_DATE = "2024-06-01T00:00:00Z"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function):
    @wraps(function)
    def run(spark, sf_dir):
        show_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


@query
def op4_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.similarity_classes(documents(spark, sf_dir))


@query
def op5_substring_dedup(spark, sf_dir):
    found = substrings.remove_repeats(documents(spark, sf_dir))
    length = F.aggregate("removed", F.lit(0).cast("bigint"),
                         lambda total, part: total + part["end"] - part["start"])
    return found.select("doc_id", "n_words", length.alias("n_removed"),
                        F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir),
                                     tokenizer_path("piece_bpe_32k.model"), limit=4096)


def _remainder(divisor: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


@query
def op6_secret_ownership(spark, sf_dir):
    found = secret_scan.document_spans(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2("base", 256).alias("base_sha256"), "spans", "live", "shared", "examples",
                        "copies")


@query
def op7_benchmark_edit_match(spark, sf_dir):
    return decontamination.benchmark_matches(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op8_quality_risk(spark, sf_dir):
    return quality_risk.judge(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query
def op10_language_kernel(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held_out = _remainder(5) == 0
    model = language.fit(docs, ~held_out)
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"),
                                                 "lang_pred", "score")


@query
def op3_toxicity_nearest(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held_out = _remainder(4) == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted",
                         F.col("evidence.doc_id").alias("evidence"), "blocks_read", "blocks")


@query
def op2_warc_derivatives(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.derive(warc.page_responses(pages, WARC_DATE))


@query
def op11_cover_tree_pairs(spark, sf_dir):
    return cover_join.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_filter_interaction(spark, sf_dir):
    return filter_audit.filter_interactions(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): fixed rule of the query: from a word on, some texts repeat one period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", filter_audit.SPACE), "")
    split = docs.select("doc_id", "text", F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10")
                        .alias("g"), F.when(h % 10 == 0, words).alias("words"))
    placed = split.withColumn("n", F.size("words")).withColumns(
        {"a": F.expr("cast(g % nullif(n, 0) as int)")}).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")),
                                     F.expr("cast((n - a) div p as int) + 1")))
    changed = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")),
                          F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    return placed.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text"))
                         .alias("text"))


@query
def op13_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(with_planted_repeats(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.select("doc_id", "runs", "collapsed_text", longest.alias("longest"),
                         F.array_join(lines, "").alias("lines"))
    start, length, period = (-F.col("longest.start"), F.col("longest.length"),
                             -F.col("longest.period"))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
