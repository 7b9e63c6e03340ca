"""A training-corpus pipeline over ``documents``: five stages, each a written table the next one reads.

toxicity: toxic documents go. near_duplicates: one document of each group of near copies stays. decontamination:
documents with a passage of a benchmark item go. personal_data: personal data and the terms that disclose them are
replaced in the text. mixing: how many words the mix takes from each remaining document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, disclosure, minhash, mixing
from ledgerloom.llm import toxicity as ordinal
from ledgerloom.llm.shared import prepare, stored, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = ordinal.fit(docs, table(spark, sf_dir, "labels"))
    return ordinal.reject(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    clean = disclosure.sanitise(docs)
    if "n_chars" in clean.columns:
        kind = clean.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return clean.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("personal_data", personal_data),
    ("mixing", mixture),
]

#: The ordinal fit, banded signatures and alignment have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
