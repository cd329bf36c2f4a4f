"""LM scoring by cross-entropy difference.

Two bigram models, of a target text and of the background corpus, are matched: one
vocabulary (that of a public byte-level tokenizer), one inventory of bigrams and one
smoothing. A document's score is its mean loss under the background model minus its
mean loss under the target model, in nats for each token: higher is more like the
target.

Counting covers every token of every document: each task sums its bigrams and sends
one row for each distinct one, so what is gathered grows with the corpus. No count is
dropped. The most frequent bigrams, ``SLOTS`` at most, and all unigrams and contexts are
files in the shared folder that a worker loads once and applies where documents are read.
What a document holds of other bigrams, one row for each distinct one, is joined with the
rest of the counts, whatever their number; if all bigrams fit, there is no such join.

Defined results: a null or empty text has no tokens, null losses and score 0; an empty
target or background gives uniform models; repeated rows count and are scored each
time; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .shared import new_path, written
from .textops import slices
from .token_counts import TOKENIZER_DIR, VERSION, tokenizer

VOCABULARY = 50_257
START = VOCABULARY - 1  # the free id: what stands before a text's first token
SLOTS = 1 << 22
PRIOR, SPREAD = 0.5, 200.0  # additive smoothing of unigrams; weight of unigrams in bigrams
HELD_PAIRS = 4 << 20


def pair_keys(encode, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(previous token * 2^20 + token) for all tokens, and n + 1 offsets."""
    lists = [encode(t) for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    tokens = np.fromiter((i for x in lists for i in x), np.int64, off[-1])
    before = np.empty_like(tokens)
    if len(tokens):
        before[1:] = tokens[:-1]
        before[off[:-1][np.diff(off) > 0]] = START
    return (before << 20) | tokens, off


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def bigram_counts(texts: DataFrame, folder: str = TOKENIZER_DIR, version: str = VERSION) -> DataFrame:
    """(key, n): counts of bigrams over all texts."""
    path = f"{folder}/{version}.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_ordinary
        keys, counts, held = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            k, c = _added(np.concatenate(keys), np.concatenate(counts))
            for a in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[a : a + 100_000]), pa.array(c[a : a + 100_000])], ["key", "n"])

        for batch in batches:
            for part in slices(batch):
                k, _ = pair_keys(encode, pc.fill_null(part.column("text"), "").to_pylist())
                k, c = np.unique(k, return_counts=True)
                keys.append(k), counts.append(c.astype(np.int64))
                held += len(k)
                if held > HELD_PAIRS:
                    k, c = _added(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, held = [k], [c], len(k)
                    if held > HELD_PAIRS // 2:
                        yield from out()
                        keys, counts, held = [], [], 0
        if keys:
            yield from out()

    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def fit(target: DataFrame, background: DataFrame, folder: str = TOKENIZER_DIR, version: str = VERSION, slots: int = SLOTS) -> str:
    """Write the matched models and return their path: ``pairs`` for workers to load, ``rest`` to join."""
    spark = background.sparkSession
    path = new_path(spark, "lm")
    t = bigram_counts(target, folder, version).select("key", F.col("n").alias("t"), F.lit(0).cast("long").alias("b"))
    b = bigram_counts(background, folder, version).select("key", F.lit(0).cast("long").alias("t"), F.col("n").alias("b"))
    t.unionByName(b).groupBy("key").agg(F.sum("t").alias("t"), F.sum("b").alias("b")).write.parquet(f"{path}/all")
    every = spark.read.parquet(f"{path}/all")
    for name, token in (("contexts", F.shiftright("key", 20)), ("unigrams", F.col("key") % (1 << 20))):
        every.groupBy(token.alias("token")).agg(F.sum("t").alias("t"), F.sum("b").alias("b")).coalesce(1).write.parquet(f"{path}/{name}")
    # bins of frequencies, the most frequent first, as long as they fit
    frequency = F.floor(16 * F.log2(F.col("b") + F.col("t")))
    least, held = None, 0
    for r in every.groupBy(frequency.alias("bin")).count().orderBy(F.desc("bin")).collect():
        held += r["count"]
        if held > slots:
            break
        least = r["bin"]
    hot = F.lit(False) if least is None else frequency >= least
    every.where(hot).write.parquet(f"{path}/pairs")
    # what a bigram's own count takes from the loss that its unigram alone would give
    u = spark.read.parquet(f"{path}/unigrams")
    total = u.agg(F.sum("t").alias("total_t"), F.sum("b").alias("total_b"))
    gain = {m: F.log1p(F.col(m) / (SPREAD * (F.col(f"u{m}") + PRIOR) / (F.coalesce(f"total_{m}", F.lit(0)) + PRIOR * VOCABULARY))).alias(f"gain_{m}") for m in ("t", "b")}
    rest = every.where(~hot).withColumn("token", F.col("key") % (1 << 20)).join(F.broadcast(u.select("token", F.col("t").alias("ut"), F.col("b").alias("ub"))), "token").crossJoin(F.broadcast(total))
    rest.select("key", gain["t"], gain["b"]).write.parquet(f"{path}/rest")
    return path


class Models:
    """Both models as arrays; ``losses`` looks bigrams up by binary search in their sorted keys."""

    def __init__(self, pairs: pa.Table, contexts: pa.Table, unigrams: pa.Table) -> None:
        keys = pairs["key"].to_numpy()
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.side = {}
        for m in ("t", "b"):
            c, u = np.zeros(VOCABULARY), np.zeros(VOCABULARY)
            c[contexts["token"].to_numpy()] = contexts[m].to_numpy()
            u[unigrams["token"].to_numpy()] = unigrams[m].to_numpy()
            self.side[m] = (np.append(pairs[m].to_numpy()[order], 0).astype(np.float64), c, (u + PRIOR) / (u.sum() + PRIOR * VOCABULARY))

    def losses(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Loss of each token under the target and under the background model; whether its bigram is held here."""
        distinct, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = self.keys[at] == distinct
        before, token = distinct >> 20, distinct & ((1 << 20) - 1)
        out = []
        for m in ("t", "b"):
            pairs, contexts, unigrams = self.side[m]
            out.append(-np.log((np.where(known, pairs[at], 0) + SPREAD * unigrams[token]) / (contexts[before] + SPREAD))[back])
        return out[0], out[1], known[back]


@functools.lru_cache(maxsize=1)
def load(path: str) -> Models:
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return Models(*[ds.dataset(f"{folder}/{x}", filesystem=system, format="parquet").to_table() for x in ("pairs", "contexts", "unigrams")])


def lm_scores(documents: DataFrame, path: str, folder: str = TOKENIZER_DIR, version: str = VERSION) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (means by token) and score."""
    vocabulary = f"{folder}/{version}.tiktoken"
    rest = documents.sparkSession.read.parquet(f"{path}/rest")
    partial = not rest.isEmpty()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, models = tokenizer(vocabulary).encode_ordinary, load(path)
        for batch in batches:
            for part in slices(batch):
                keys, off = pair_keys(encode, pc.fill_null(part.column("text"), "").to_pylist())
                t, b, known = models.losses(keys)
                n = np.diff(off)
                sums = [pa.array(np.diff(np.concatenate([[0.0], np.cumsum(x)])[off])) for x in (t, b)]
                cols = [part.column("doc_id"), pa.array(n), *sums]
                if partial:
                    row, key = np.repeat(np.arange(len(n)), n)[~known], keys[~known]
                    order = np.lexsort((key, row))
                    row, key = row[order], key[order]
                    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])]) if len(key) else np.zeros(0, np.int64)
                    at = pa.array(np.searchsorted(row[first], np.arange(len(n) + 1)).astype(np.int32))
                    times = np.diff(np.r_[first, len(key)])
                    cols += [pa.ListArray.from_arrays(at, pa.array(key[first])), pa.ListArray.from_arrays(at, pa.array(times))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "t", "b", "keys", "times"][: len(cols)])

    schema = "doc_id long, n_tokens long, t double, b double" + ", keys array<long>, times array<long>" * partial
    sums = documents.select("doc_id", "text").mapInArrow(run, schema)
    if partial:
        rows = written(sums.withColumn("row", F.monotonically_increasing_id()), "sums")
        other = rows.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("row", F.col("x.keys").alias("key"), F.col("x.times").alias("times"))
        gains = other.join(rest, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("gain_t")).alias("gt"), F.sum(F.col("times") * F.col("gain_b")).alias("gb"))
        sums = rows.select("row", "doc_id", "n_tokens", "t", "b").join(gains, "row", "left")
        sums = sums.select("doc_id", "n_tokens", *[(F.col(m) - F.coalesce(f"g{m}", F.lit(0.0))).alias(m) for m in ("t", "b")])
    mean = {m: F.when(F.col("n_tokens") > 0, F.col(m) / F.col("n_tokens")) for m in ("t", "b")}
    return sums.select("doc_id", "n_tokens", mean["t"].alias("target_loss"), mean["b"].alias("background_loss"), F.coalesce(mean["b"] - mean["t"], F.lit(0.0)).alias("score"))


def cross_entropy_difference(documents: DataFrame, target: DataFrame) -> DataFrame:
    """Scores of all documents against models of ``target`` and of the documents themselves."""
    return lm_scores(documents, fit(target, documents))
