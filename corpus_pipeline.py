"""The corpus pipeline: five stages, each written and read again as the next
one's documents.  Every stage but the last returns the columns of
``documents``; the last writes the token files and reports what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transitflow.llm import decontaminate, mixing, near_dedup, quality_rules, queries, token_files
from transitflow.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, queries.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.op7_token_files(docs, queries.tokenizer_file())


STAGES = [("quality_rules", quality), ("near_dedup", dedup), ("decontaminate", decontaminated),
          ("mix", mixed), ("token_files", tokens)]

#: The tokenizer has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
