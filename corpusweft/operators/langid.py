"""Language models of character n-grams, and the nearest language of a text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vectorised import typed
from . import gramcodes


def characters(text: Column, n: int = 3) -> Column:
    """Characters of a text whose white space is collapsed, with two blanks before and one after (unigrams: one after)."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.split(F.when(flat == "", F.lit("")).otherwise(F.concat(F.lit("  " if n > 1 else ""), flat, F.lit(" "))), "")


def gram_array(chars: str, n: int = 3) -> Column:
    """All n-grams of a column of characters; each is put together from n of them, so work is linear in the text."""
    at = [f"get({chars}, i + {j})" if j else f"get({chars}, i)" for j in range(n)]
    return F.expr(f"if(size({chars}) < {n} or {chars}[0] = '', cast(array() as array<string>), transform(sequence(0, size({chars}) - {n}), i -> concat({', '.join(at)})))")


def grams(texts: DataFrame, keys: list[str], text: str = "text", n: int = 3) -> DataFrame:
    """(keys, gram), one row for each occurrence."""
    c = texts.select(*keys, characters(F.col(text), n).alias("_c")).select(*keys, gram_array("_c", n).alias("_g"))
    return c.select(*keys, F.explode_outer("_g").alias("gram")).where("gram is not null")


def model(texts: DataFrame, lang: str = "lang", text: str = "text", n: int = 3) -> DataFrame:
    """(lang, gram, n): counts, added up where texts are read, so only distinct grams are shuffled."""
    counts = gramcodes.partial_counts(texts, lang, text, n).withColumnRenamed("lang", lang) if n <= 3 else grams(texts, [lang], text, n).withColumn("n", F.lit(1))
    return counts.groupBy(lang, "gram").agg(F.sum("n").alias("n"))


def norms(models: DataFrame, lang: str = "lang") -> DataFrame:
    return models.groupBy(lang).agg(F.sqrt(F.sum(F.col("n") * F.col("n")).cast("double")).alias("norm"))


def cosine_matrix(models: DataFrame, lang: str = "lang") -> DataFrame:
    """(lang_a, lang_b, difference) for all pairs: 1 - cosine, to 6 digits."""
    a, b = models.select(F.col(lang).alias("lang_a"), "gram", F.col("n").alias("na")), models.select(F.col(lang).alias("lang_b"), "gram", F.col("n").alias("nb"))
    dot = a.join(b, "gram").groupBy("lang_a", "lang_b").agg(F.sum(F.col("na") * F.col("nb")).alias("dot"))
    n = norms(models, lang)
    j = dot.join(n.select(F.col(lang).alias("lang_a"), F.col("norm").alias("norm_a")), "lang_a").join(n.select(F.col(lang).alias("lang_b"), F.col("norm").alias("norm_b")), "lang_b")
    return j.select("lang_a", "lang_b", (F.round(1 - F.col("dot") / (F.col("norm_a") * F.col("norm_b")), 6) + 0.0).alias("difference"))


def squared_norm(sorted_grams: Column) -> Column:
    """Sum of squared counts of a sorted array, from its run lengths: a run of k adds 1 + 3 + ... + (2k - 1)."""
    return F.aggregate(
        sorted_grams,
        F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("total")),
        lambda a, g: F.struct(
            g.alias("last"),
            F.when(g == a["last"], a["run"] + 1).otherwise(F.lit(1).cast("long")).alias("run"),
            (a["total"] + F.when(g == a["last"], 2 * a["run"] + 1).otherwise(F.lit(1).cast("long"))).alias("total"),
        ),
        lambda a: a["total"],
    )


def differences(docs: DataFrame, models: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", n: int = 3) -> DataFrame:
    """(doc_id, model_lang, difference) of each document and each language that shares a gram with it.

    The dot product is a sum over occurrences, so grams are never grouped by document:
    one row for each document and language is shuffled, combined where it was read.
    """
    g = docs.select(doc_id, characters(F.col(text), n).alias("_c")).select(doc_id, F.sort_array(gram_array("_c", n)).alias("_g"))
    normed = g.select(doc_id, squared_norm(F.col("_g")).alias("_sq"), "_g")  # a step of its own: beside the explode it would be done for each gram
    occurrences = normed.select(doc_id, "_sq", F.explode_outer("_g").alias("gram")).where("gram is not null")
    m = models.select(F.col(lang).alias("model_lang"), "gram", F.col("n").alias("_m")).join(norms(models, lang).select(F.col(lang).alias("model_lang"), "norm"), "model_lang")
    m = m.groupBy("gram").agg(F.collect_list(F.struct("model_lang", "_m", "norm")).alias("_models"))  # one entry a language
    hits = occurrences.join(m, "gram").select(doc_id, "_sq", F.explode("_models").alias("h"))
    dot = hits.groupBy(doc_id, F.col("h.model_lang").alias("model_lang")).agg(F.sum("h._m").alias("dot"), F.first("_sq").alias("_sq"), F.first("h.norm").alias("norm"))
    return dot.select(doc_id, "model_lang", F.round(1 - F.col("dot") / (F.sqrt(F.col("_sq").cast("double")) * F.col("norm")), 6).alias("difference"))


def nearest_language(text: Column, known: gramcodes.GramModel) -> Column:
    """Struct (detected, difference) of a text, without a join: the models go along as arrays."""
    def run(texts: pa.Array) -> pa.Array:
        found = []
        for a, b in gramcodes.slices(gramcodes._lengths(texts)):
            codes, off = gramcodes.coded(texts.slice(a, b - a).to_pylist(), known.n)
            found += [known.nearest(codes[i:j]) for i, j in zip(off[:-1], off[1:])]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([d for _, d in found], pa.float64())], ["detected", "difference"])

    return F.arrow_udf(typed(run, pa.Array), "detected string, difference double")(text)


def detect(docs: DataFrame, models: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", n: int = 3, most: int = gramcodes.MODEL_ROWS) -> DataFrame:
    """(doc_id, detected, difference): the nearest language below difference 1, ties by name; null if none.

    Models of at most ``most`` grams are looked up where texts are read; larger ones are joined.
    """
    known = gramcodes.small_model(models, lang, n, most)
    if known is not None:
        return docs.select(doc_id, nearest_language(F.col(text), known).alias("_b")).select(doc_id, "_b.detected", "_b.difference")
    best = differences(docs, models, doc_id, text, lang, n).where("difference < 1").groupBy(doc_id).agg(F.min(F.struct("difference", "model_lang")).alias("b"))
    return docs.select(doc_id).join(best, doc_id, "left").select(doc_id, F.col("b.model_lang").alias("detected"), F.col("b.difference").alias("difference"))


def stop_words(texts: DataFrame, most: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, word, n, rank): the most frequent words of each language, lower case."""
    from pyspark.sql import Window as W

    from ..functions.text import tokens

    counts = texts.select(lang, F.explode(tokens(F.lower(F.col(text)))).alias("word")).groupBy(lang, "word").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(W.partitionBy(lang).orderBy(F.desc("n"), "word"))).where(F.col("rank") <= most)


def stop_word_density(docs: DataFrame, stops: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_stops, density); the list is small, and hits are combined where documents are read."""
    from ..functions.text import tokens

    words = docs.select(doc_id, F.col(lang).alias("_lang"), tokens(F.lower(F.coalesce(F.col(text), F.lit("")))).alias("_w"))
    n = words.select(doc_id, F.size("_w").cast("long").alias("n_words"), "_lang", "_w").select(doc_id, "n_words", "_lang", F.explode_outer("_w").alias("word"))
    hit = n.join(stops.select(F.col(lang).alias("_lang"), "word", F.lit(1).alias("_hit")), ["_lang", "word"], "left")
    out = hit.groupBy(doc_id).agg(F.first("n_words").alias("n_words"), F.coalesce(F.sum("_hit"), F.lit(0)).alias("n_stops"))
    return out.withColumn("density", F.round(F.when(F.col("n_words") > 0, F.col("n_stops") / F.col("n_words")).otherwise(0.0), 6))
