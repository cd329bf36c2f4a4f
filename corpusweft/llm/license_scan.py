"""License scans by diagonal voting, in DataFrame operations only.

Every rolling hash of ``K`` words of every text is joined to the hashes' places in the
templates, by default the paragraphs of ``license_texts``, or any table (label, text);
equal hashes count only if their words are equal. A hit votes for the diagonal (place in
text - place in template) of its text and template; diagonals at most ``GAP`` words apart
are merged, so that inserted or missing words don't split a template. A merged span is
verified by its words: those of the template that stand in the text on its diagonals must
be at least ``COVER`` of the template's, and ``WHOLE`` or all of them, spread over at most
``SPREAD`` times its length. A span that lies inside one of another label with more words
verified, or as many of a shorter template, gives way to it.
Only hits are shuffled, by doc_id and a hash of the text; texts are not.

Templates are broadcast if they have at most ``BROADCAST_PLACES`` places, else joined by
a shuffle of the rolling hashes, combined with the same result.

Base phrases are found exactly, word by word, beside the method: ``BASE``.

Defined results: a null text counts as empty: no words, no labels (empty strings), score
0; rows with equal doc_id and different texts have their own results, nulls included;
repeated rows give repeated results; templates with fewer than ``K`` words are never found;
an empty table gives an empty result; other columns are ignored.
``score`` is 1 where a base phrase stands, else the best verified share of a template
whose label is given, else 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .license_texts import TEMPLATES

K, GAP, COVER, WHOLE, SPREAD = 3, 3, 0.6, 8, 1.5
BROADCAST_PLACES = 200_000
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def word_array(text: Column) -> Column:
    """Words of a text: runs of digits, letters and all beyond ASCII, A-Z in lower case."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK), "")


def grams(words: str, k: int = K) -> Column:
    """All runs of k words of an array column, in order."""
    w = ", ".join([f"get({words}, i + {j})" if j else f"get({words}, i)" for j in range(k)])
    return F.expr(f"if(size({words}) < {k}, cast(array() as array<string>), transform(sequence(0, size({words}) - {k}), i -> concat_ws(' ', {w})))")


def template_table(spark: SparkSession, templates: list[tuple[str, str]] | DataFrame = TEMPLATES, k: int = K) -> DataFrame:
    """hash, words, template, label, place and length of each place of each template."""
    rows = templates if isinstance(templates, DataFrame) else spark.createDataFrame(templates, "label string, text string")
    t = rows.select("label", F.xxhash64("label", "text").alias("template"), word_array(F.col("text")).alias("w")).distinct()
    t = t.select("template", "label", F.size("w").alias("length"), F.posexplode(grams("w", k)).alias("place", "words"))
    return t.select("template", "label", "length", "place", "words", F.xxhash64("words").alias("hash"))


def notices(documents: DataFrame, templates: list[tuple[str, str]] | DataFrame = TEMPLATES, k: int = K, gap: int = GAP, cover: float = COVER, spread: float = SPREAD) -> DataFrame:
    """Verified spans: doc_id, text_hash, template, label, first_word, last_word, coverage."""
    key = ["doc_id", "text_hash"]
    d = documents.select("doc_id", text_hash().alias("text_hash"), word_array(F.col("text")).alias("w")).select(*key, grams("w", k).alias("g"))
    places = d.select(*key, F.posexplode_outer("g").alias("pos", "gram"))  # a plain one is planned with a filter that repeats all its work
    t = template_table(documents.sparkSession, templates, k)
    # a table of templates may be of any size; the default one is known
    if not isinstance(templates, DataFrame) or templates.select(F.coalesce(F.sum(F.size(word_array(F.col("text")))), F.lit(0))).first()[0] <= BROADCAST_PLACES:
        t = F.broadcast(t)
    hits = places.withColumn("hash", F.xxhash64("gram")).join(t, "hash").where("gram = words")
    votes = hits.groupBy(*key, "template", "label", "length", (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )  # places: at most a template's
    by = W.partitionBy(*key, "template").orderBy("diagonal")
    fresh = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > gap).cast("int"), F.lit(1))
    merged = votes.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(by))
    # each place stands for k words of the template
    covered = F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten(F.collect_set("places"))), lambda x: F.sequence(x, x + k - 1))))
    spans = merged.groupBy(*key, "template", "label", "length", "island").agg(F.size(covered).alias("covered"), F.min("low").alias("first_word"), (F.max("high") + k - 1).alias("last_word"))
    good = (F.col("covered") >= F.greatest(F.col("length") * cover, F.least("length", F.lit(WHOLE)))) & (F.col("last_word") - F.col("first_word") + 1 <= F.col("length") * spread + gap)
    good = spans.where(good).select(*key, "template", "label", "first_word", "last_word", "covered", "length", (F.col("covered") / F.col("length")).alias("coverage"))
    a, b = good.alias("a"), good.alias("b")
    wider = (F.col("b.first_word") <= F.col("a.first_word")) & (F.col("b.last_word") >= F.col("a.last_word")) & (F.col("b.label") != F.col("a.label"))
    wider = wider & ((F.col("b.covered") > F.col("a.covered")) | ((F.col("b.covered") == F.col("a.covered")) & (F.col("b.length") < F.col("a.length"))))
    return a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash")) & wider, "left_anti").drop("covered", "length")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def base_places(words: str) -> dict[str, Column]:
    """n_base, first_word, last_word and the base labels, from an array of words.

    With two blanks after each word and none shared, the words before a place are half
    the blanks before it; documents without a phrase do no such work.
    """
    s = F.concat(F.lit(" "), F.array_join(F.col(words), "  "), F.lit(" "))
    n, first, last, labels = [], [], [], []
    for phrase, label in BASE.items():
        p = " " + phrase.replace(" ", "  ") + " "
        here = F.instr(s, p) > 0
        n.append(F.when(here, (F.length(s) - F.length(F.replace(s, F.lit(p), F.lit("")))) / len(p)).otherwise(0).cast("long"))
        blanks = lambda x: (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))) / 2
        first.append(F.when(here, blanks(F.substring_index(s, p, 1))).cast("long"))
        after = F.substring_index(s, p, -1)
        last.append(F.when(here, F.size(words) - blanks(after) - len(phrase.split())).cast("long"))
        labels.append(F.when(here, F.lit(label)))
    return {"n_base": sum(n[1:], n[0]), "first_word": F.least(*first), "last_word": F.greatest(*last), "base": F.array_sort(F.array_compact(F.array(*labels)))}


def license_scan(documents: DataFrame, templates: list[tuple[str, str]] | DataFrame = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document."""
    base = documents.select("doc_id", text_hash().alias("text_hash"), word_array(F.col("text")).alias("w"))
    base = base.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), *[c.alias(a) for a, c in base_places("w").items()])
    found = notices(documents, templates).groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(F.collect_set("label").alias("found"), F.max("coverage").alias("best"))
    j = base.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return j.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"))


def license_sql(templates: list[tuple[str, str]] = TEMPLATES) -> str:
    """DuckDB SQL over the view ``documents`` that gives ``license_scan``'s rows."""
    lists = lambda t: f"list_filter(regexp_split_to_array(translate(coalesce({t}, ''), '{_UPPER}', '{_LOWER}'), '{_BREAK}'), lambda x: x <> '')"
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(K))
    values = ", ".join(f"('{label}', '{text}')" for label, text in sorted(set(templates)))
    phrases = []
    for phrase, label in BASE.items():
        test = " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(phrase.split()))
        phrases.append(f"SELECT rid, i - 1 AS start, '{label}' AS label FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE {test}")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {lists('text')} AS w FROM documents),
b AS ({' UNION ALL '.join(phrases)}),
base AS (SELECT rid, count(*)::BIGINT AS n, min(start) AS first_word, max(start) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM b GROUP BY rid),
g AS (SELECT rid, i - 1 AS pos, {gram} AS gram FROM (SELECT rid, w, unnest(range(1, len(w) - {K} + 2)) AS i FROM d)),
t AS (SELECT label, row_number() OVER () AS template, {lists('text')} AS w FROM (VALUES {values}) v(label, text)),
p AS (SELECT label, template, len(w) AS length, i - 1 AS place, {gram} AS gram FROM (SELECT *, unnest(range(1, len(w) - {K} + 2)) AS i FROM t)),
hits AS (SELECT rid, template, label, length, pos, place, pos - place AS diagonal FROM g JOIN p USING (gram)),
lines AS (SELECT rid, template, diagonal, coalesce((diagonal - lag(diagonal) OVER w > {GAP})::INT, 1) AS fresh FROM (SELECT DISTINCT rid, template, diagonal FROM hits) WINDOW w AS (PARTITION BY rid, template ORDER BY diagonal)),
islands AS (SELECT rid, template, diagonal, sum(fresh) OVER (PARTITION BY rid, template ORDER BY diagonal) AS island FROM lines),
spans AS (SELECT rid, template, any_value(label) AS label, any_value(length) AS length, island, count(DISTINCT place + j) AS covered, min(pos) AS low, max(pos) + {K - 1} AS high
  FROM hits JOIN islands USING (rid, template, diagonal), range(0, {K}) x(j) GROUP BY rid, template, island),
good AS (SELECT * FROM spans WHERE covered >= greatest(length * {COVER}::DOUBLE, least(length, {WHOLE})) AND high - low + 1 <= length * {SPREAD}::DOUBLE + {GAP}),
found AS (SELECT rid, list(DISTINCT label) AS labels, max(covered::DOUBLE / length) AS best FROM good a
  WHERE NOT EXISTS (SELECT 1 FROM good b WHERE b.rid = a.rid AND b.low <= a.low AND b.high >= a.high AND (b.covered > a.covered OR b.covered = a.covered AND b.length < a.length) AND b.label <> a.label) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.first_word::BIGINT AS first_word, base.last_word::BIGINT AS last_word, coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []::VARCHAR[]), coalesce(found.labels, []::VARCHAR[])))), ',') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(found.best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN found USING (rid)"""
