"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features come from the text alone (``FEATURES``); labels, lang, source and doc_id are
never inputs. Trees are grown level by level on quantile bins (``BINS``) by Newton
gain, as in published histogram boosting, and kept as flat arrays of complete binary
trees, so that scoring is ``DEPTH`` vectorised array look-ups for each tree.

Training uses at most ``MOST_ROWS`` labelled rows, those with the smallest hash of
their doc_id, out of the rows whose crc32(doc_id as text) mod 5 is not 0; that bound
keeps the driver's memory fixed. Every document is scored.

Defined results: a null or empty text is scored from its zero counts like any other;
a null doc_id has no label, is not held out and is scored; repeated labels of one
document count by their smallest quality, and of a document's rows the one with the
smallest features is learnt from; with no usable labels, or labels of one
class, every score is the Laplace-smoothed share of label 1; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .docstats import doc_stats
from .shared import written
from .textops import slices

MOST_ROWS = 40_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_HESSIAN = 0.2, 1.0, 2.0
THRESHOLD = 0.3
FEATURES = [
    "log_words", "word_length", "length_sd", "symbols", "upper", "digits", "punct", "bang", "bar",
    "stops", "wide", "dup_lines", "line_words", "repeats", "distinct", "echo", "longest",
]


def features(texts: pa.Array) -> np.ndarray:
    """One float32 row of FEATURES for each text."""
    s = {k: v.astype(float) for k, v in doc_stats(texts).items()}
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_chars"], 1), np.maximum(s["n_lines"], 1)
    mean = s["word_chars"] / words
    out = [
        np.log1p(s["n_words"]), mean, np.sqrt(np.maximum(s["sq_len"] / words - mean**2, 0)), s["n_symbols"] / words,
        s["n_upper"] / np.maximum(s["n_upper"] + s["n_lower"], 1), s["n_digits"] / chars, s["n_punct"] / words, s["n_bang"] / words, s["n_bar"] / words,
        s["n_stop"] / words, s["n_wide"] / chars, s["n_dup_lines"] / lines, np.log1p(s["n_words"] / lines), s["n_repeat_words"] / words,
        s["n_distinct"] / words, s["n_echo"] / words, np.log1p(s["max_len"]),
    ]
    return np.stack(out, axis=1).astype(np.float32)


@dataclass
class Forest:
    """Complete binary trees: inner node i has children 2i+1 and 2i+2."""

    feature: np.ndarray  # (trees, 2**depth - 1) int
    cut: np.ndarray  # (trees, 2**depth - 1) float32; go right if the value is above
    leaf: np.ndarray  # (trees, 2**depth) float
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = int(np.log2(inner + 1))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    n, inner = x.shape[0], 2**depth - 1
    base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    feature, cut, leaf = [], [], []
    if not n or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    f = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        feat, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            node = at - first
            best_gain, best_f, best_b = np.full(width, 1e-6), np.zeros(width, int), np.full(width, -1)
            for j in range(x.shape[1]):
                key = node * bins + binned[:, j]
                gs = np.bincount(key, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(key, h, width * bins).reshape(width, bins).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hs < LEAST_HESSIAN) | (ht - hs < LEAST_HESSIAN)] = -1
                gain[:, len(edges[j]) :] = -1
                b = gain.argmax(1)
                v = gain[np.arange(width), b]
                better = v > best_gain
                best_gain[better], best_f[better], best_b[better] = v[better], j, b[better]
            for k in np.flatnonzero(best_b >= 0):
                feat[first + k], cuts[first + k] = best_f[k], edges[best_f[k]][best_b[k]]
            at = 2 * at + 1 + (x[np.arange(n), feat[at]] > cuts[at])
        gl = np.bincount(at - inner, g, inner + 1)
        hl = np.bincount(at - inner, h, inner + 1)
        value = RATE * gl / (hl + RIDGE)
        f += value[at - inner]
        feature.append(feat), cut.append(cuts), leaf.append(value)
    return Forest(np.array(feature), np.array(cut), np.array(leaf), base)


def feature_table(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = features(part.column("text"))
                rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), rows], ["doc_id", "x"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<float>")


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def chosen(labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(doc_id, y) of the labels to learn from, ``most`` at most."""
    known = labels.where("doc_id is not null and quality is not null").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("y"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit(table: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Forest:
    """Train on the labelled rows that are not held out; only ``most`` rows reach the driver."""
    got = table.join(chosen(labels, most), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.min("y").alias("y")).orderBy("doc_id").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)) if got.num_rows else np.zeros((0, len(FEATURES)), np.float32)
    return train(x, got["y"].to_numpy().astype(float))


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    table = written(feature_table(documents), "features")
    forest = fit(table, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(forest.scores(x))], ["doc_id", "score"])

    scored = table.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = MOST_ROWS) -> DataFrame:
    """The rows of documents that the classifier keeps, with all their columns.

    The decision is made from each row's own text, so no join and no second key is needed.
    Features for training are made of the chosen rows only, whose doc_ids go to where the texts are.
    """
    labels = written(chosen(labels, most).withColumnRenamed("y", "quality"), "chosen")
    forest = fit(feature_table(documents.join(F.broadcast(labels.select("doc_id")), "doc_id", "left_semi")), labels, most)
    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(forest.scores(features(part.column("text"))) >= threshold))

    return documents.mapInArrow(run, schema)
