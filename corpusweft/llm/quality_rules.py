"""Quality rules: robust multivariate outliers among document statistics.

Base rules count words, symbols, repeated lines and repeated 8-word windows. Above
them, each (lang, source) group gets a minimum-covariance-determinant (MCD) estimate
of the centre and spread of a transformed statistic vector, and a document whose
Mahalanobis distance from its group's centre is too large is rejected.

The vector (``DIMS``) is made of statistics that vary among all texts whatever their
length: log word length, distinct words in blocks of 20, share of upper case, and
marks by word. Each is taken as its difference from the group's median, times
sqrt(n / (n + ``STEADY``)) for n words, since a short text's statistics scatter more.

The estimate is FAST-MCD in its deterministic form: from ``STARTS`` starts (median absolute
deviations alone, and with the correlations of tanh scores or of spatial signs) come
``STEPS`` concentration steps, each taking the ``KEPT_SHARE`` of the group's rows that lie
nearest; the start that ends with the smallest determinant wins, its covariance gets
the consistency factor of the normal distribution, and one reweighting step follows
with the rows within the ``REWEIGHTED`` quantile. A step never holds a group's rows:
distances are histogrammed (``BINS`` bins by group), every bin carries its moments, and
the nearest bins are added up, so one hot group costs no more than the others. All rows
that pass the base rules take part; the subset ends at a bin's edge.

Small groups lean on larger ones, without a threshold: a group's median, centre and
covariance are averaged with its language's as if that had ``LEAN`` rows, the language's
with those of all rows, and these with ``USUAL`` spreads. ``SINGULAR`` of the usual spread is
added to each variance, only so that constant statistics can be inverted.

A document is rejected beyond the chi-square quantile that a normal one passes with
probability ``CHANCE``; it is that small because real statistics have heavy tails.

Defined results: a null or empty text has zero counts and fails the base rules (they
ask for 20 words); null languages and sources are groups of their own; repeated rows
give repeated results; a table of one row has nothing to differ from and is judged by the
base rules; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .docstats import doc_stats
from .shared import written
from .textops import slices

#: share of a group's rows in the concentrated subset
KEPT_SHARE, REWEIGHTED = 0.75, 0.975
STARTS, STEPS, BINS = 3, 4, 256
CHANCE = 1e-15
STEADY, LEAN = 1000.0, 50.0
#: usual standard deviations of the vector, of texts of all lengths
USUAL = {"x_length": 0.02, "x_variety": 0.02, "x_upper": 0.015, "x_marks": 0.1}
SINGULAR = 0.1
DIMS = list(USUAL)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
KEY = ["level", "lang", "source"]


def beyond(x: float, freedom: int) -> float:
    """Share of a chi-square distribution of an even number of degrees of freedom above x."""
    return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))


def quantile(share_above: float, freedom: int = len(DIMS)) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if beyond(mid, freedom) > share_above else (low, mid)
    return high


def consistency(share: float) -> float:
    """What a covariance of the nearest ``share`` of normal rows lacks to theirs all."""
    return 1.0 if share >= 1 else share / (1 - beyond(quantile(1 - share), len(DIMS) + 2))


CUT = quantile(CHANCE)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def stat_table(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts and the transformed vector of each document, with its weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                s = doc_stats(part.column("text"))
                n = np.maximum(s["n_words"], 1).astype(float)
                vector = {
                    "x_length": np.log(np.maximum(s["word_chars"], 1) / n),
                    "x_variety": s["variety"] / (20.0 * np.maximum(s["n_blocks"], 1)),
                    "x_upper": np.arcsin(np.sqrt((s["n_upper"] + 0.375) / (s["n_upper"] + s["n_lower"] + 0.75))),
                    "x_marks": np.log((s["n_punct"] + s["n_symbols"] + 0.5) / (n + 1)),
                }
                columns = [part.column(c) for c in ("doc_id", "lang", "source")]
                columns += [pa.array(s[c].astype(np.int64)) for c in COUNTS] + [pa.array(np.asarray(vector[c], float)) for c in DIMS] + [pa.array(np.sqrt(n / (n + STEADY)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "source", *COUNTS, *DIMS, "weight"])

    schema = "doc_id long, lang string, source string, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in DIMS]) + ", weight double"
    return documents.select("doc_id", "text", "lang", "source").mapInArrow(run, schema)


def base_counts(documents: DataFrame) -> DataFrame:
    """doc_id, the counts and base_failed of every document."""
    return stat_table(documents).select("doc_id", *COUNTS, base_failed().alias("base_failed"))


def _levels(rows: DataFrame) -> DataFrame:
    """Each row once for its group, its language and all rows; hot keys combine before the shuffle."""
    none = F.lit(None).cast("string")
    level = [F.struct(F.lit(k).alias("level"), a.alias("lang"), b.alias("source")) for k, a, b in ((2, F.col("lang"), F.col("source")), (1, F.col("lang"), none), (0, none, none))]
    return rows.select(*[c for c in rows.columns if c not in KEY], F.explode(F.array(*level)).alias("g")).select("g.*", *[c for c in rows.columns if c not in KEY])


def _on(left: str, right: str) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in KEY]


def _for_each(rows: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the columns of their group's, their language's and the whole table's entry, as structs p2, p1, p0."""
    for k, keys in ((2, ["lang", "source"]), (1, ["lang"]), (0, [])):
        t = table.where(F.col("level") == k).select(*[F.col(c).alias(f"_{c}") for c in keys], F.struct(*columns).alias(f"p{k}"))
        test = F.lit(True)
        for c in keys:
            test = test & F.col(c).eqNullSafe(F.col(f"_{c}"))
        rows = rows.join(F.broadcast(t) if not keys else t, test, "left").drop(*[f"_{c}" for c in keys])  # the last has one row
    return rows


def _leaning(field: str, usual: Column) -> Column:
    """A number of structs p2, p1, p0 that have ``n``, each averaged with the next as if that had LEAN rows."""
    for k in (0, 1, 2):
        usual = F.coalesce((F.expr(f"p{k}.{field}") * F.col(f"p{k}.n") + usual * LEAN) / (F.col(f"p{k}.n") + LEAN), usual)
    return usual


def centred(stats: DataFrame) -> DataFrame:
    """Rows with the vector as weighted differences from their group's leaning median."""
    fair = _levels(stats.where(~base_failed()).select("lang", "source", *DIMS))
    medians = fair.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(c, 0.5, 1000).alias(c) for c in DIMS])
    j = _for_each(stats, medians, ["n", *DIMS])
    whole = {c: F.coalesce(F.col(f"p0.{c}"), F.col(c)) for c in DIMS}
    return j.withColumns({c: (F.col(c) - _leaning(c, whole[c])) * F.col("weight") for c in DIMS}).drop("p0", "p1", "p2", "weight")


def _starts(levels: DataFrame) -> DataFrame:
    """(level, lang, source, start, centre, inverse): diagonal, tanh scores and spatial signs."""
    scale = levels.groupBy(*KEY).agg(*[F.greatest(F.percentile_approx(F.abs(c), 0.5, 1000) * 1.4826, F.lit(SINGULAR * USUAL[c])).alias(f"s_{c}") for c in DIMS])
    j = levels.alias("l").join(scale.alias("s"), _on("l", "s")).select(*[F.col(f"l.{c}").alias(c) for c in KEY], *[F.col(f"s_{c}") for c in DIMS], *[(F.col(f"l.{c}") / F.col(f"s_{c}")).alias(c) for c in DIMS])
    length = F.sqrt(sum((F.col(c) * F.col(c) for c in DIMS), F.lit(1e-12)))
    product = lambda f: F.array(*[F.sum(f(a) * f(c)) for a in DIMS for c in DIMS])
    sums = j.withColumn("_length", length).groupBy(*KEY).agg(F.array(*[F.first(f"s_{c}") for c in DIMS]).alias("scale"), product(lambda c: F.tanh(c)).alias("tanh"), product(lambda c: F.col(c) / F.col("_length")).alias("sign"))

    def run(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(DIMS)
        for g in groups:
            rows = []
            for r in g.itertuples():
                s = np.asarray(r.scale)
                for start, sums_of in enumerate((None, r.tanh, r.sign)):
                    m = np.eye(p) if sums_of is None else np.asarray(sums_of).reshape(p, p)
                    d = np.sqrt(np.maximum(np.diag(m), 1e-12))
                    corr = 0.99 * m / np.outer(d, d) + 0.01 * np.eye(p)
                    rows.append((r.level, r.lang, r.source, start, [0.0] * p, np.linalg.inv(corr * np.outer(s, s)).ravel().tolist()))
            yield pd.DataFrame(rows, columns=[*KEY, "start", "centre", "inverse"])

    return sums.mapInPandas(run, "level int, lang string, source string, start int, centre array<double>, inverse array<double>")


def _distance(centre: Column, inverse: Column) -> Column:
    d = [F.col(c) - centre[i] for i, c in enumerate(DIMS)]
    n = len(DIMS)
    terms = [d[i] * d[j] * inverse[i * n + j] * (1.0 if i == j else 2.0) for i in range(n) for j in range(i, n)]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _bin(d2: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.floor(F.log1p(d2) * 32)).cast("int")


def covariance(n: float, n_all: float, first, second, share: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Mean and consistent covariance of a subset from its sums; share: the subset's, or else n of n_all."""
    p = len(DIMS)
    m = np.asarray(first) / n
    cov = np.asarray(second).reshape(p, p) / n - np.outer(m, m)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    cov = (vectors * np.maximum(values, 0)) @ vectors.T * consistency(share or n / n_all)
    return m, cov + np.diag([(SINGULAR * USUAL[c]) ** 2 for c in DIMS])


def _step(levels: DataFrame, fit: DataFrame, within: float | None = None) -> DataFrame:
    """One concentration step of each start: mean, covariance and determinant of the nearest rows, or of those ``within`` a distance."""
    key = [*KEY, "start"]
    d = levels.alias("l").join(fit.alias("f"), _on("l", "f")).select(*[F.col(f"l.{c}").alias(c) for c in KEY], "start", *[F.col(f"l.{c}").alias(c) for c in DIMS], _distance(F.col("centre"), F.col("inverse")).alias("d2"))
    sums = [F.sum(c).alias(f"s_{c}") for c in DIMS] + [F.sum(F.col(a) * F.col(c)).alias(f"q_{a}_{c}") for i, a in enumerate(DIMS) for c in DIMS[i:]]
    bins = d.groupBy(*key, _bin(F.col("d2")).alias("bin")).agg(F.count(F.lit(1)).alias("n"), *sums)
    total = bins.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("h"))  # at most BINS entries
    running = F.expr("aggregate(h, named_struct('seen', 0L, 'edge', -1), (a, x) -> named_struct('seen', a.seen + x.n, 'edge', if(a.seen < share, x.bin, a.edge)), a -> a.edge)")
    edge = total.withColumn("n_all", F.expr("aggregate(h, 0L, (a, x) -> a + x.n)")).withColumn("share", F.col("n_all") * F.lit(KEPT_SHARE)).select(*key, "n_all", running.alias("edge"))
    if within is not None:
        edge = edge.withColumn("edge", F.greatest(F.lit(int(math.log1p(within) * 32)), "edge"))
    near = bins.alias("l").join(edge.alias("e"), [*_on("l", "e"), F.col("l.start") == F.col("e.start")]).where("l.bin <= e.edge")
    names = {(a, c): f"q_{a}_{c}" if f"q_{a}_{c}" in bins.columns else f"q_{c}_{a}" for a in DIMS for c in DIMS}
    moments = near.groupBy(*[F.col(f"l.{c}").alias(c) for c in key]).agg(
        F.first("n_all").alias("n_all"),
        F.sum("n").alias("n"),
        F.array(*[F.sum(f"s_{c}") for c in DIMS]).alias("first"),
        F.array(*[F.sum(names[a, c]) for a in DIMS for c in DIMS]).alias("second"),
    )

    def solve(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups:
            got = [covariance(n, n_all, a, b, REWEIGHTED if within is not None else None) for n, n_all, a, b in zip(g["n"], g["n_all"], g["first"], g["second"])]
            yield pd.DataFrame({**{c: g[c] for c in key}, "n": g["n_all"], "det": [float(np.linalg.det(c)) for _, c in got], "centre": [m.tolist() for m, _ in got], "cov": [c.ravel().tolist() for _, c in got], "inverse": [np.linalg.inv(c).ravel().tolist() for _, c in got]})

    return moments.mapInPandas(solve, "level int, lang string, source string, start int, n long, det double, centre array<double>, cov array<double>, inverse array<double>")


def mcd(vectors: DataFrame) -> DataFrame:
    """n, centre and covariance by level, lang and source of rows with lang, source and DIMS, in the shared folder."""
    levels = _levels(vectors.select("lang", "source", *DIMS))
    fit = written(_starts(levels), "mcd")
    for _ in range(STEPS):
        fit = written(_step(levels, fit), "mcd")
    best = fit.groupBy(*KEY).agg(F.min_by(F.struct("start", "centre", "inverse"), F.struct("det", "start")).alias("b")).select(*KEY, "b.*")
    return written(_step(levels, best, quantile(1 - REWEIGHTED)).select(*KEY, "n", "centre", "cov"), "mcd")


def quality_rules(documents: DataFrame, cut: float = CUT) -> DataFrame:
    """The counts, ``base_failed``, ``distance`` (squared Mahalanobis) and ``kept`` by document."""
    stats = written(centred(written(stat_table(documents), "stats")), "stats")
    fit = mcd(stats.where(~base_failed()))
    p = len(DIMS)
    centre = F.array(*[_leaning(f"centre[{i}]", F.lit(0.0)) for i in range(p)])
    cov = F.array(*[_leaning(f"cov[{i * p + j}]", F.lit(USUAL[DIMS[i]] ** 2 if i == j else 0.0)) for i in range(p) for j in range(p)])
    # one row for each group that occurs; rows are joined to its inverse
    groups = _for_each(stats.select("lang", "source").distinct(), fit, ["n", "centre", "cov"]).select("lang", "source", centre.alias("centre"), cov.alias("cov"))

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in batches:
            yield g[["lang", "source", "centre"]].assign(inverse=[np.linalg.inv(np.asarray(c).reshape(p, p)).ravel().tolist() for c in g["cov"]])

    fits = written(groups.mapInPandas(invert, "lang string, source string, centre array<double>, inverse array<double>"), "mcd")
    s, f = stats.alias("s"), fits.alias("f")
    j = s.join(f, F.col("s.lang").eqNullSafe(F.col("f.lang")) & F.col("s.source").eqNullSafe(F.col("f.source")))
    distance = _distance(F.col("centre"), F.col("inverse"))
    return j.select("doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & (distance <= cut)).alias("kept"), distance.alias("distance"))


#: DuckDB SQL over the view ``documents`` that gives ``base_counts``' rows
BASE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g),
again AS (SELECT rid, count(DISTINCT i + j)::BIGINT AS n FROM twice, range(0, 8) x(j) WHERE twice.n > 1 GROUP BY rid),
l AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words, len(w) < 20 OR 100 * coalesce(again.n, 0) > 30 * len(w) AS base_failed
FROM d LEFT JOIN again USING (rid) LEFT JOIN l USING (rid)"""
