"""From raw documents to packed training sequences: five stages, each written as
Parquet and read again as the next one's documents.

Every stage runs one operator of ``questlog.llm`` over all that its predecessor
kept; all but the last return the columns of ``documents``. Null texts are
rejected by the first stage; other nulls, empty tables, repeated rows and extra
columns are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.llm import language, packing, privacy, quality, simhash
from questlog.llm.common import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (operator 10): rejected documents go."""
    return quality.keep_clean(docs)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification (operator 5): documents in no recognised language go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (operator 1): one document of each group stays."""
    return simhash.keep_one(docs)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (operator 9): entities become surrogates; ``n_chars``, if there, follows the text."""
    out = privacy.rewrite(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (operator 6): pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("privacy", replace_private),
    ("packing", pack_sequences),
]

# Trained models and a tokenizer are beyond SQL: the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
