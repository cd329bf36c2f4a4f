"""Exact deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import content_key


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of all but the smallest of each content. Only keys are shuffled, and combined first."""
    keyed = docs.select(F.col(doc_id), content_key(F.col(text)).alias("_key")).where("_key is not null")
    first = keyed.groupBy("_key").agg(F.min(doc_id).alias("_first"))
    return keyed.join(first, "_key").where(F.col(doc_id) > F.col("_first")).select(doc_id)


def two_stage(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", raw: str = "html") -> DataFrame:
    """(id, status) of each row: 'no-text', 'duplicate-text', 'duplicate-raw' or 'kept'.

    The first stage keeps the smallest id of each text; the second, among those alone, of
    each raw content. Rows without raw content skip the second.
    """
    d = docs.select(F.col(doc_id).alias("_id"), F.when(F.col(text) != "", content_key(F.col(text))).alias("_t"), F.when(F.col(raw) != "", content_key(F.col(raw))).alias("_r"))
    first = d.where("_t is not null").groupBy("_t").agg(F.min("_id").alias("_one"))
    one = d.join(first, "_t", "left")
    second = one.where("_id = _one and _r is not null").groupBy("_r").agg(F.min("_id").alias("_two"))
    two = one.join(second, "_r", "left")
    status = F.when(F.col("_t").isNull(), F.lit("no-text")).when(F.col("_id") > F.col("_one"), F.lit("duplicate-text")).when(F.col("_r").isNotNull() & (F.col("_id") > F.col("_two")), F.lit("duplicate-raw")).otherwise(F.lit("kept"))
    return two.select(F.col("_id").alias(doc_id), status.alias("status"))


def without(docs: DataFrame, duplicates: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.join(duplicates.select(doc_id), doc_id, "left_anti")


def unseen(new: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """New keys, each once, that a table of seen keys doesn't hold."""
    return new.dropDuplicates(keys).join(seen.select(*keys), keys, "left_anti")
