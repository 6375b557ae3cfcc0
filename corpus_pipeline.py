"""The corpus pipeline: language ID, near-dedup, mixing, tokenizing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.llm import langid, mixing, neardup, sentencepiece
from natspark.llm.common import bounded_batches, id_remainder, materialize, table
from natspark.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language is found for (or only for a small part of
    their letters) go; clean ones stay as they are."""
    bounded_batches(spark)
    model = langid.fit(docs.where(id_remainder(F.col("doc_id"), 5) != 0))
    seen = langid.identify(docs, model, with_spans=False)
    return seen.where(langid.accepted(F.col("lang_pred"), F.col("score"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8)
    the document with the smallest id stays."""
    bounded_batches(spark)
    return neardup.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at weights 5, 2, 1; a document taken twice
    comes twice."""
    return mixing.mixed_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row of the mix."""
    bounded_batches(spark)
    ids = sentencepiece.encode(docs.select("doc_id", "source", "lang", "text"),
                               sentencepiece.read_model(tokenizer_path()), outputs=("n_tokens", "ids"))
    return ids.drop("text")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("tokenize", tokenize),
]

# Language models, connected components and tokenizing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
