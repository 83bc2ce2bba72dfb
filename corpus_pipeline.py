"""A corpus pipeline: language, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all the stage before it kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notequarry.llm import exact_dedup, language_id, packing, pii, simhash
from notequarry.llm.queries import SURROGATE_KEY, WORDS
from notequarry.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go; ``lang`` is the predicted language of the others.

    No language is predicted for null and empty texts, texts without a letter, and where no
    document with a language could be learnt from. Repeated rows are judged alike.
    """
    return language_id.keep_identified(docs, language_id.fit(language_id.learnable(docs)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars follows the new text."""
    replaced = pii.replace_pii(docs, SURROGATE_KEY)
    counted = F.when(F.col("n_replaced") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", counted).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return packing.pack_documents(docs, WORDS)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("pii_surrogates", replace_personal_data),
    ("best_fit_packing", pack),
]

#: The language model, SimHash and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
