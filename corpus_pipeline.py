"""From raw documents to token counts of a mixed, de-duplicated corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starbazaar.llm import line_templates, mixing, sentencepiece_bpe, simhash_covering, toxicity_grammar
from starbazaar.session import app_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold stay; the lexicon is learned from the labels of these documents."""
    lexicon = toxicity_grammar.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_grammar.without_toxic(docs, lexicon)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs stay in one document only; all documents stay."""
    return line_templates.without_recurring(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash_covering.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    import public_tokenizers

    return sentencepiece_bpe.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing", source_mix),
    ("sentencepiece", tokens),
]

#: Scoring, fingerprints and tokens have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{app_dir(spark)}/pipeline/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
