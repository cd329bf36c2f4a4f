"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns the columns of ``documents``, but for the last, which returns doc_id, source, lang, ids
and text. ``run``
writes each stage's rows as Parquet in the shared folder and reads them again.

1. quality: documents that the classifier rejects go.
2. near_duplicates: the smallest doc_id of each near-duplicate class stays.
3. repeats: passages that stand in a document with a smaller doc_id are cut from text.
4. mix: sources are mixed to their targets; a document taken twice becomes two rows.
5. pieces: texts become SentencePiece ids, and the ids are decoded to text again.

Defined results are those of the operators, by stage: null and empty texts have the score of
their zero counts, and go if that is too low; of rows that share a doc_id one stays; columns
beyond those of ``documents`` pass through the first four stages; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusweft.llm import mixing, near_dedup, pieces, quality_model, suffix_dedup
from corpusweft.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, keep=("source", "lang"), decoded="text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mix", mix),
    ("pieces", encode),
]

#: a trained classifier, SimHash classes and tokenizer ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
