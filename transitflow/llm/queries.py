"""Queries of this package: each reads the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, decontaminate, language_id, maglev, mixing, near_dedup, quality_fm, quality_rules, ranked_search,
               secret_scan, spelling, substring_dedup, token_files)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokenizer_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark, sf_dir):
    return quality_rules.op1_quality_rules(documents(spark, sf_dir))


def quality_ablation(spark, sf_dir):
    return quality_rules.quality_ablation(documents(spark, sf_dir))


def op2_near_dedup(spark, sf_dir):
    return near_dedup.op2_near_dedup(documents(spark, sf_dir))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.op3_secret_scan(documents(spark, sf_dir))


def op4_quality_fm(spark, sf_dir):
    return quality_fm.op4_quality_fm(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.op5_decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark, sf_dir):
    return language_id.op6_language_id(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_token_files(spark, sf_dir):
    return token_files.op7_token_files(documents(spark, sf_dir), tokenizer_file())


def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.op8_substring_dedup(documents(spark, sf_dir))


def op9_maglev(spark, sf_dir):
    return maglev.op9_maglev(documents(spark, sf_dir))


def op10_fair_queue(spark, sf_dir):
    return mixing.op10_fair_queue(documents(spark, sf_dir))


def op11_bpe(spark, sf_dir):
    return bpe.op11_bpe(documents(spark, sf_dir), tokenizer_file())


def op12_spelling_variants(spark, sf_dir):
    return spelling.op12_spelling_variants(documents(spark, sf_dir))


def op13_ranked_search(spark, sf_dir):
    return ranked_search.op13_ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    ops = {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
    return ops | {"quality_ablation": quality_ablation}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality_rules.ORACLE, "quality_ablation": quality_rules.ABLATION_ORACLE,
            "op2_near_dedup": near_dedup.ORACLE, "op3_secret_scan": secret_scan.oracle(), "op8_substring_dedup": substring_dedup.ORACLE,
            "op10_fair_queue": mixing.ORACLE, "op12_spelling_variants": spelling.ORACLE,
            "op13_ranked_search": ranked_search.ORACLE}
