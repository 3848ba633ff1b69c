"""A corpus made ready for training: five operators in sequence over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the
shared folder and read again as the next stage's docs. All but the last return the columns of
``documents``; the last returns packed pieces. Stages drop rows by their place in the stage's input,
so rows without a doc_id, and rows that share one, are each judged by their own text. Empty tables
pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.llm import decontamination, ngram_join, packing, quality_risk, secret_scan
from landinglake.llm.queries import tokenizer_path
from landinglake.llm.tables import (documents, free_name, numbered, show_package, stored,
                                    without)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled quality rules keep."""
    show_package(spark)
    row = free_name(docs, "row_number")
    rows = numbered(docs, row)
    judged = quality_risk.judge(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=(row,))
    return without(rows, judged.filter("not kept").select(row), row).drop(row)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each similarity class, the first of those with the least doc_id."""
    show_package(spark)
    row = free_name(docs, "row_number")
    rows = numbered(docs, row)
    classes = stored(ngram_join.similarity_classes(rows.select(F.col(row).alias("doc_id"), "text"))
                     .select(F.col("doc_id").alias("number"), "component_id"), "classes")
    several = classes.filter("number != component_id").select("component_id").distinct()
    members = stored(classes.join(several, "component_id", "left_semi").join(
        rows.select(F.col(row).alias("number"), "doc_id"), "number"), "members")
    kept = members.groupBy("component_id").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "number")).alias("first")) \
        .select(F.col("first.number").alias("number"))
    dropped = members.join(kept, "number", "left_anti").select("number")
    return without(rows, dropped, row).drop(row)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    show_package(spark)
    row = free_name(docs, "row_number")
    rows = numbered(docs, row)
    found = decontamination.benchmark_matches(
        rows.select(F.col(row).alias("doc_id"), "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(rows, found.select("doc_id"), row).drop(row)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets other than widely copied examples replaced."""
    show_package(spark)
    return secret_scan.redact(docs).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, packed into sequences."""
    show_package(spark)
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark_leaks), ("secret scans", secrets),
          ("best-fit packing", packed)]

# The last stage needs a tokenizer, which SQL does not have; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
