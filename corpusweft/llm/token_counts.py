"""Token counts kept as rollups that signed changes update.

A ``TokenRollup`` is a folder. ``apply(batch_id, changes)`` turns a batch of inserts,
deletes and revisions into a ledger of what each document now counts for, and into
signed deltas of additive totals by source, language and tokenizer version. Totals are
the sum of the deltas of all committed batches; nothing is recounted.

Commits are idempotent: an attempt writes its files under a name of its own, then
creates ``commits/<number>``, a file that only one attempt can create, with the batch's id
and the attempt's name. Readers follow commit files alone, so a batch that is sent again,
or whose driver died half-way, neither counts twice nor leaves traces. Of two writers at
once, one finds its number taken and works its deltas out again on top of the other's.

``changes`` has ``op`` ('I' insert, 'D' delete, 'R' revise), doc_id, source, lang and
text, and may have ``seq`` (long), the order of changes. Within a batch only a doc_id's last
changes count: those of greatest seq (null: lowest), and at equal seq a delete comes after
a revision and that after inserts. In the ledger a doc_id stands for the rows of the last
batch that touched it: 'R' and 'I' replace them, 'D' takes them away.

Only ledger rows of a batch's doc_ids are looked up; the ledger isn't regrouped.

The tokenizer version ``WORDS`` counts runs of anything but ASCII blanks; the others are
vocabulary files.

Defined results: a null text counts as an empty document with no tokens; null sources
and languages are groups of their own; rows with a null doc_id are counted but can't be
taken back; inserts of one doc_id with equal seq count one by one, of such revisions the
one with the smallest source, lang and counts; an empty batch commits and changes nothing;
other columns, ``text`` of deletes and rows with another op are ignored.
"""

from __future__ import annotations

import base64
import functools
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .shared import create_once, exists, listing
from .textops import slices, words

TOKENIZER_DIR = "/opt/tokenizers"
VERSION, WORDS = "byte_bpe_50k", "words"
#: split rule of the byte-level vocabularies, from their published description
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "tokenizer_version"]
SUMS = ["n_docs", "n_tokens", "n_bytes"]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(changes: DataFrame, version: str = VERSION, folder: str = TOKENIZER_DIR) -> DataFrame:
    """op, doc_id, seq, source, lang, n_tokens, n_bytes: the text goes no further than this scan."""
    path, names = f"{folder}/{version}.tiktoken", ["op", "doc_id", "seq", "source", "lang"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None if version == WORDS else tokenizer(path).encode_ordinary
        for batch in batches:
            for part in slices(batch):
                text = pc.fill_null(part.column("text"), "")
                tokens = np.diff(words(text)[1]) if encode is None else np.fromiter((len(encode(t)) for t in text.to_pylist()), np.int64, len(text))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(tokens, pa.int64()), pc.binary_length(text).cast(pa.int64())], [*names, "n_tokens", "n_bytes"])

    return changes.select(*names, "text").mapInArrow(run, "op string, doc_id long, seq long, source string, lang string, n_tokens long, n_bytes long")


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str, version: str = VERSION, folder: str = TOKENIZER_DIR) -> None:
        self.spark, self.path, self.version, self.folder = spark, path.rstrip("/"), version, folder

    def commits(self) -> list[dict]:
        """The commits in order, with ``number``, ``batch`` and ``attempt``; one job reads them all."""
        if not exists(self.spark, f"{self.path}/commits"):
            return []
        lines = self.spark.read.schema("value string").text(f"{self.path}/commits").select("value").collect()
        return sorted((json.loads(r["value"]) for r in lines), key=lambda c: c["number"])

    def _read(self, kind: str, commits: list[dict]) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.path}/attempts/{c['attempt']}/{kind}" for c in commits]) if commits else None

    def _standing(self, ids: DataFrame, commits: list[dict]) -> DataFrame | None:
        """The ledger's rows that count now, of the given doc_ids."""
        ledger = self._read("ledger", commits)
        if ledger is None:
            return None
        mine = ledger.join(ids, "doc_id", "left_semi")
        last = mine.groupBy("doc_id").agg(F.max("number").alias("number"))
        return mine.join(last, ["doc_id", "number"], "left_semi").where("op <> 'D'")

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Count and commit one batch; False, with nothing done, if it is committed already."""
        while True:
            done = self.commits()
            if any(c["batch"] == batch_id for c in done):
                return False
            number = len(listing(self.spark, f"{self.path}/commits"))
            attempt = uuid.uuid4().hex
            self._write(f"{self.path}/attempts/{attempt}", number, changes, done)
            if create_once(self.spark, f"{self.path}/commits/{number:012d}", json.dumps({"number": number, "batch": batch_id, "attempt": attempt})):
                return True

    def _write(self, at: str, number: int, changes: DataFrame, done: list[dict]) -> None:
        seq = F.col("seq").cast("long") if "seq" in changes.columns else F.lit(None).cast("long")
        c = changes.select("op", F.col("doc_id").cast("long").alias("doc_id"), seq.alias("seq"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.when(F.col("op") != "D", F.col("text")).alias("text")).where("op in ('I', 'R', 'D')")
        counted(c, self.version, self.folder).write.parquet(f"{at}/counted")
        every = self.spark.read.parquet(f"{at}/counted")
        order = F.struct(F.coalesce("seq", F.lit(-(1 << 63))).alias("seq"), F.when(F.col("op") == "D", 2).when(F.col("op") == "R", 1).otherwise(0).alias("kind"))
        keyed = every.where("doc_id is not null").withColumn("place", order)
        kept = keyed.join(keyed.groupBy("doc_id").agg(F.max("place").alias("place")), ["doc_id", "place"], "left_semi")
        row = ["source", "lang", "n_tokens", "n_bytes"]
        one = kept.where("op <> 'I'").groupBy("doc_id", "op").agg(F.min(F.struct(*row)).alias("r")).select("op", "doc_id", "r.*")
        new = kept.where("op = 'I'").select("op", "doc_id", *row).unionByName(one).unionByName(every.where("doc_id is null and op <> 'D'").select("op", "doc_id", *row))
        new.withColumns({"number": F.lit(number), "tokenizer_version": F.lit(self.version)}).write.parquet(f"{at}/ledger")
        new = self.spark.read.parquet(f"{at}/ledger")
        signed = new.where("op <> 'D'").select(*KEYS, F.lit(1).alias("sign"), "n_tokens", "n_bytes")
        old = self._standing(new.where("doc_id is not null").select("doc_id").distinct(), done)
        if old is not None:
            signed = signed.unionByName(old.select(*KEYS, F.lit(-1).alias("sign"), "n_tokens", "n_bytes"))
        delta = signed.groupBy(*KEYS).agg(F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"), F.sum(F.col("sign") * F.col("n_bytes")).alias("n_bytes"))
        delta.write.parquet(f"{at}/delta")

    def totals(self) -> DataFrame:
        """n_docs, n_tokens and n_bytes by source, lang and tokenizer_version, without empty groups."""
        delta = self._read("delta", self.commits())
        if delta is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer_version string, n_docs long, n_tokens long, n_bytes long")
        sums = delta.groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
        return sums.where("n_docs <> 0 or n_tokens <> 0 or n_bytes <> 0")


def inserts(documents: DataFrame) -> DataFrame:
    return documents.select(F.lit("I").alias("op"), "doc_id", "source", "lang", "text")


def changed(documents: DataFrame, op: str, **columns) -> DataFrame:
    """Changes of one op for all documents, with columns replaced."""
    own = {"source": F.col("source"), "lang": F.col("lang"), "text": F.col("text")} | columns
    return documents.select(F.lit(op).alias("op"), "doc_id", *[c.alias(n) for n, c in own.items()])


def rebuilt(rollup: TokenRollup, documents: DataFrame) -> DataFrame:
    """Totals of the documents, reached by every kind of change: all inserted under another source, revised to
    another language, taken away and inserted as they are, each batch sent twice."""
    gone = {"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string"), "text": F.lit(None).cast("string")}
    known = documents.where("doc_id is not null")  # what can be taken back
    for name, changes in (("draft", changed(known, "I", source=F.lit("draft"))), ("moved", changed(known, "R", lang=F.lit("moved"))), ("gone", changed(known, "D", **gone)), ("final", inserts(documents))):
        rollup.apply(name, changes)
        rollup.apply(name, changes)  # sent again: nothing is done
    return rollup.totals()


#: DuckDB SQL over the view ``documents`` that gives the totals of words
WORDS_SQL = r"""SELECT source, lang, 'words' AS tokenizer_version, count(*)::BIGINT AS n_docs,
  sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS n_tokens, sum(octet_length(encode(coalesce(text, ''))))::BIGINT AS n_bytes FROM documents GROUP BY source, lang"""
