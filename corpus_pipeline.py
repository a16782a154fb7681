"""The corpus pipeline: each stage is one operator, written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from colonnade.llm import bpe, mixing, ngram_join, pii, quality_rules
from colonnade.session import configure, stage


def _configured(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with the library's settings put on its session first, also where it is run on its own."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(configure(spark), docs, sf_dir)

    return run


#: (name, function of session, documents and input folder), in order.
STAGES = [
    ("quality rules", _configured(quality_rules.stage)),
    ("n-gram join", _configured(ngram_join.stage)),
    ("personal data", _configured(pii.stage)),
    ("mixing", _configured(mixing.stage)),
    ("bpe", _configured(bpe.stage)),
]

#: SQL cannot express the later stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
