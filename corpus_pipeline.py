"""A training corpus made from ``documents``: rules, toxicity, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agrolith.llm import packing, pii, quality, simhash, toxicity
from agrolith.llm.common import materialise, table
from agrolith.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filtered(docs)


def toxic_terms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_terms),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Toxicity is learned, near-duplicates are a closure and packing needs a tokenizer: SQL cannot say these.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
