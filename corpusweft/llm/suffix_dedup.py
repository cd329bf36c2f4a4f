"""Suffix-array deduplication of long repeats between documents.

A byte is removed if a ``LENGTH``-byte string that covers it also starts in a document
with a smaller doc_id. Suffixes are sorted by blocks, one suffix bucket at a time:

1. Locally consistent anchors. Among the ``K``-byte strings inside any ``LENGTH`` bytes, those
   of smallest hash are anchors (about one byte in 18), so equal strings hold equal
   anchors at equal places, and two suffixes can only agree over ``LENGTH`` bytes in the
   bucket of a shared anchor. Nothing that is repeated is lost, and suffixes of unique
   text are never sorted. A residue-class cover of the same reach would sample one
   byte in five and overrun the disk budget.
2. Buckets. An anchor goes to its bucket with the bytes around it that its suffixes can
   need. ``PASSES`` passes over the texts each take a share of the buckets, so only
   that share is ever on disk. Anchors whose whole surroundings agree are settled by
   the smallest doc_id, already before the shuffle, so a passage copied into a third of
   all documents sends one row for each flush of a task, not one for each document.
3. Buckets come to a task one after the other, sorted by Spark. In a bucket, surroundings
   that agree with no other document's in ``HALF`` bytes beside the anchor, on either side,
   go: the larger the table, the more anchors recur by themselves. The suffixes
   of the remaining surroundings are sorted: the first bytes up to the next place of the
   difference cover {0, 1, 3} mod 7, then the precomputed rank of the cover sample there.
   Neighbours with a common prefix of ``LENGTH`` bytes form runs; a run's smallest doc_id
   decides. Common prefixes are compared byte by byte, so hash collisions can't remove
   anything.
4. A bucket that outgrows ``HELD_BYTES`` hands on the records of its most frequent anchors,
   which have very many different surroundings. Each of their ``LENGTH``-byte strings is
   then grouped by a 128-bit hash in Spark, with partial aggregation.

Defined results: a null text counts as empty; texts under ``LENGTH`` bytes keep all bytes;
repeated rows and rows that share a doc_id never remove each other, and each text of a
doc_id has its own spans; rows with a null doc_id are kept whole and remove nothing; an
empty table gives an empty result; in ``deduplicated``, bytes that a cut leaves as broken
UTF-8 are dropped from the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import free_name, free_shuffles, new_path
from .textops import mix, raw, slices, tidy

LENGTH, K = 50, 16
PASSES = 4
FLUSH_BYTES = 8 << 20
BUCKET_BYTES, MOST_PARTITIONS = 12 << 20, 50_000  # beyond, a partition holds several buckets, one at a time
HELD_BYTES = 64 << 20
BLOCK_BYTES = 1 << 17  # of text at a time: its arrays stay in a core's cache
COVER, STEP = (0, 1, 3), 7
SIDE = LENGTH - K  # bytes on either side of an anchor that its strings reach
AROUND = 2 * SIDE + K
HALF = SIDE // 2
#: row: a hash of the whole text, which tells the texts of a doc_id apart
WIRE = np.dtype([("doc", "<i8"), ("row", "<i8"), ("pos", "<u4"), ("left", "u1"), ("right", "u1"), ("text", "u1", AROUND)])
RECORD = np.dtype([("h", "<u8"), *WIRE.descr])
SPAN = np.dtype([("doc", "<i8"), ("row", "<i8"), ("start", "<u4"), ("end", "<u4")])


def _slide(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over x[i : i + width] for each i that has them all."""
    size = 1
    while 2 * size <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    return x if size == width else op(x[: len(x) - (width - size)], x[width - size :])


def _gram_hash(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return mix(low * np.uint64(0x9E3779B97F4A7C15) ^ (high + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def _pick(r: np.ndarray, at: np.ndarray) -> np.ndarray:
    """r[at], whole records at a time instead of field by field."""
    return r.view(np.dtype((np.void, r.itemsize))).take(at).view(r.dtype)


def _gram_order(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """What anchors are chosen by: 32 bits, as the smallest of those are found faster."""
    x = low * np.uint64(0x9E3779B97F4A7C15) ^ high * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def to_wire(r: np.ndarray) -> np.ndarray:
    """Records without their anchors' hashes, which their bytes give again."""
    whole = np.ascontiguousarray(r).view(np.uint8).reshape(len(r), RECORD.itemsize)
    return np.ascontiguousarray(whole[:, RECORD.itemsize - WIRE.itemsize :]).view(WIRE).reshape(len(r))


def from_wire(w: np.ndarray) -> np.ndarray:
    out = np.empty(len(w), RECORD)
    out.view(np.uint8).reshape(len(w), RECORD.itemsize)[:, RECORD.itemsize - WIRE.itemsize :] = w.view(np.uint8).reshape(len(w), WIRE.itemsize)
    gram = np.ascontiguousarray(w["text"][:, SIDE : SIDE + K]).view("<u8")
    out["h"] = _gram_hash(gram[:, 0], gram[:, 1]) if len(w) else 0
    return out


def anchors(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all anchors of texts laid end to end."""
    n = len(b)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    padded = np.concatenate([b, np.zeros(16, np.uint8)])
    low = np.ndarray((n,), "<u8", padded.data, 0, (1,))
    high = np.ndarray((n,), "<u8", padded.data, 8, (1,))
    rank = _gram_order(low, high)[: n - K + 1]
    least = _slide(rank, SIDE + 1, np.minimum)  # of each string of LENGTH bytes
    for end in off[1:-1]:  # none crosses the end of a text
        least[max(0, end - LENGTH + 1) : end] = 0
    edge = np.zeros(SIDE, np.uint32)
    top = _slide(np.concatenate([edge, least, edge]), SIDE + 1, np.maximum)  # of the strings around each place
    at = np.flatnonzero(rank == top)
    return at, _gram_hash(low[at], high[at])


def records(docs: np.ndarray, keys: np.ndarray, b: np.ndarray, off: np.ndarray, step: int, passes: int) -> np.ndarray:
    at, h = anchors(b, off)
    mine = (h >> np.uint64(8)) % np.uint64(passes) == np.uint64(step)
    at, h = at[mine], h[mine]
    owner = np.searchsorted(off, at, side="right") - 1
    out = np.zeros(len(at), RECORD)
    if not len(at):
        return out
    start, end = off[owner], off[owner + 1]
    out["h"], out["doc"], out["row"], out["pos"] = h, docs[owner], keys[owner], at - start
    out["left"], out["right"] = np.minimum(SIDE, at - start), np.minimum(SIDE, end - at - K)
    padded = np.concatenate([np.zeros(SIDE, np.uint8), b, np.zeros(SIDE, np.uint8)])
    text = np.lib.stride_tricks.sliding_window_view(padded, AROUND)[at]
    place = np.arange(AROUND)
    short = np.flatnonzero((out["left"] < SIDE) | (out["right"] < SIDE))
    inside = (place >= SIDE - out["left"][short, None].astype(int)) & (place < SIDE + K + out["right"][short, None].astype(int))
    text[short] = np.where(inside, text[short], 0)
    out["text"] = text
    return out


def _pieces(docs: np.ndarray, keys: np.ndarray, b: np.ndarray, off: np.ndarray, step: int, passes: int, most: int = BLOCK_BYTES * 4) -> Iterator[np.ndarray]:
    """Records of one slice; a single very long text goes in pieces that overlap by LENGTH - 1 bytes."""
    if len(docs) > 1 or len(b) <= most:
        yield records(docs, keys, b, off, step, passes)
        return
    margin = 2 * LENGTH
    for a in range(0, len(b), most):
        low, high = max(0, a - margin), min(len(b), a + most + margin)
        r = records(docs, keys, b[low:high], np.array([0, high - low]), step, passes)
        place = r["pos"].astype(np.int64) + low
        r = r[(place >= a) & (place < a + most)]
        r["pos"] += np.uint32(low)
        yield r


def _spans(doc: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.zeros(len(doc), SPAN)
    out["doc"], out["row"], out["start"], out["end"] = doc, row, start, end
    return out


def _merge(s: np.ndarray) -> np.ndarray:
    """Union of overlapping or touching spans of each text."""
    if not len(s):
        return s
    s = s[np.lexsort((s["start"], s["row"], s["doc"]))]
    # running end within a text: texts are told apart by an offset in the key
    base = np.cumsum(np.r_[False, (s["doc"][1:] != s["doc"][:-1]) | (s["row"][1:] != s["row"][:-1])]).astype(np.int64) << 33
    reach = np.maximum.accumulate(base + s["end"])
    fresh = np.r_[True, base[1:] + s["start"][1:] > reach[:-1]]
    at = np.flatnonzero(fresh)
    return _spans(s["doc"][at], s["row"][at], s["start"][at], np.maximum.reduceat(base + s["end"], at) - base[at])


def settle(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records that may matter to others, and the spans of those with a smaller doc_id in wholly equal surroundings."""
    if not len(r):
        return r, np.zeros(0, SPAN)
    key = r["h"] ^ (r["left"].astype(np.uint64) << np.uint64(8)) ^ r["right"]
    words = np.ndarray((len(r), AROUND // 8), "<u8", np.ascontiguousarray(r).view(np.uint8).data, RECORD.fields["text"][1], (RECORD.itemsize, 8))
    for j in range(words.shape[1]):
        key = (key ^ words[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    key = mix(key ^ (r["text"][:, -4:].astype(np.uint64) @ (np.uint64(1) << np.arange(0, 32, 8, dtype=np.uint64))))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    touched = np.zeros(len(r), bool)
    touched[1:] |= same
    touched[:-1] |= same
    rows = order[touched]  # those that share their surroundings' hash
    if not len(rows):
        return r, np.zeros(0, SPAN)
    t, key = _pick(r, rows), key[rows]
    same = (key[1:] == key[:-1]) & (t["h"][1:] == t["h"][:-1]) & (t["left"][1:] == t["left"][:-1]) & (t["right"][1:] == t["right"][:-1]) & (t["text"][1:] == t["text"][:-1]).all(axis=1)
    first = np.flatnonzero(np.r_[True, ~same])
    least = np.repeat(np.minimum.reduceat(t["doc"], first), np.diff(np.r_[first, len(t)]))
    later = t["doc"] > least
    stays = np.ones(len(r), bool)
    stays[rows[later]] = False
    gone = t[later]
    pos = gone["pos"].astype(np.int64)
    return _pick(r, np.flatnonzero(stays)), _spans(gone["doc"], gone["row"], pos - gone["left"], pos + K + gone["right"])


def _several(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places whose key occurs in two documents or more, by key."""
    if not len(key):
        return np.zeros(0, np.int64)
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    return order[np.repeat(several, np.diff(np.r_[first, len(key)]))]


def _shared(r: np.ndarray) -> np.ndarray:
    """The records whose anchor occurs in two documents or more, by anchor."""
    return _pick(r, _several(r["h"], r["doc"]))


def reaching(r: np.ndarray) -> np.ndarray:
    """The records that share their anchor with ``HALF`` bytes before or after it with another document.

    Each ``LENGTH``-byte string that covers an anchor holds that many on one side, so
    others share no such string; of anchors that are common words, that is most.
    """
    stays = np.zeros(len(r), bool)
    for side, at in (("left", SIDE - HALF), ("right", SIDE)):
        here = np.flatnonzero(r[side] >= HALF)
        x = np.zeros((len(here), -(-(K + HALF) // 8) * 8), np.uint8)
        x[:, : K + HALF] = r["text"][here, at : at + K + HALF]
        key = np.zeros(len(here), np.uint64)
        for word in x.view("<u8").T:
            key = mix((key ^ word) * np.uint64(0x9E3779B97F4A7C15))
        stays[here[_several(key, r["doc"][here])]] = True
    return _pick(r, np.flatnonzero(stays))


def cover_ranks(text: np.ndarray) -> dict[int, np.ndarray]:
    """Ranks of the suffixes at the cover's places among equal places of all rows."""
    n = len(text)
    padded = np.concatenate([text, np.zeros((n, STEP), np.uint8)], axis=1)
    ranks: dict[int, np.ndarray] = {}
    for q in range(AROUND - 1, -1, -1):
        if q % STEP not in COVER:
            continue
        head = _number(padded, q, STEP)
        tail = ranks.get(q + STEP, np.zeros(n, np.int64))
        order = np.lexsort((tail, head))
        fresh = np.r_[True, (head[order][1:] != head[order][:-1]) | (tail[order][1:] != tail[order][:-1])] if n else np.zeros(0, bool)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        ranks[q] = rank
    return ranks


def _number(text: np.ndarray, at: int, size: int) -> np.ndarray:
    """``size`` < 8 bytes as a big-endian number."""
    out = np.zeros(len(text), np.uint64)
    for j in range(size):
        out = (out << np.uint64(8)) | text[:, at + j].astype(np.uint64)
    return out


def sorted_bucket(r: np.ndarray) -> np.ndarray:
    """Spans found by sorting a bucket's suffixes: r has one row for each distinct surroundings and place in its smallest document."""
    found = np.zeros(0, SPAN)
    _, group = np.unique(r["h"], return_inverse=True)
    ranks = cover_ranks(r["text"])
    low, high = np.full(len(r), AROUND), np.full(len(r), -1)
    for o in range(SIDE + 1):  # the suffix that starts o bytes after the earliest
        delta = next(d for d in range(STEP) if (o + d) % STEP in COVER)
        here = np.flatnonzero((r["left"] >= SIDE - o) & (r["right"] >= o))
        if len(here) < 2:
            continue
        head = _number(r["text"][here], o, delta)
        sort = here[np.lexsort((ranks[o + delta][here], head, group[here]))]
        window = r["text"][sort, o : o + LENGTH]
        same = (group[sort][1:] == group[sort][:-1]) & (window[1:] == window[:-1]).all(axis=1)
        first = np.flatnonzero(np.r_[True, ~same])
        least = np.repeat(np.minimum.reduceat(r["doc"][sort], first), np.diff(np.r_[first, len(sort)]))
        hit = sort[r["doc"][sort] > least]
        low[hit], high[hit] = np.minimum(low[hit], o), o
    hit = np.flatnonzero(high >= 0)
    if len(hit):
        pos = r["pos"][hit].astype(np.int64)
        found = _spans(r["doc"][hit], r["row"][hit], pos - SIDE + low[hit], pos - SIDE + high[hit] + LENGTH)
    return found


def bucket_spans(r: np.ndarray) -> np.ndarray:
    """Spans to remove among the records of some buckets."""
    if not len(r):
        return np.zeros(0, SPAN)
    rest, spans = settle(_shared(r))
    if len(rest):
        rest = reaching(_shared(rest))
        if len(rest):
            spans = np.concatenate([spans, sorted_bucket(rest)])
    return _merge(spans)


def _size(df: DataFrame) -> int:
    """Bytes of text, roughly: from the files of a scan if Spark knows them, else counted in a pass."""
    known = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if known < 1 << 50:
        return int(1.7 * known)
    return int(df.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def _partition_keys(spark: SparkSession, parts: int) -> np.ndarray:
    """A key for each of ``parts`` partitions (MOST_PARTITIONS, or a core's each) that repartition sends there."""
    to = spark.range(parts * 24).groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("p")).agg(F.min("id").alias("key")).toPandas()
    keys = np.arange(parts, dtype=np.int64)
    keys[to["p"].to_numpy()] = to["key"].to_numpy()
    return keys


def strings_of(r: np.ndarray) -> Iterator[np.ndarray]:
    """(hash, hash, doc, row, start) of all LENGTH-byte strings that cover the records' anchors."""
    for o in range(SIDE + 1):
        here = r[(r["left"] >= SIDE - o) & (r["right"] >= o)]
        x = np.zeros((len(here), 56), np.uint8)
        x[:, :LENGTH] = here["text"][:, o : o + LENGTH]
        words, one, two = x.view("<u8"), np.full(len(here), 11, np.uint64), np.full(len(here), 13, np.uint64)
        for j in range(words.shape[1]):
            one, two = mix(one ^ words[:, j]), mix((two + words[:, j]) * np.uint64(0xD6E8FEB86659FD93))
        yield np.stack([one.view(np.int64), two.view(np.int64), here["doc"], here["row"], here["pos"].astype(np.int64) - SIDE + o], axis=1)


def parted(held: np.ndarray, hot: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at most ``most`` records to keep, those of the most frequent anchors, the hot anchors from now on) of an outgrown bucket."""
    values, counts = np.unique(held["h"], return_counts=True)
    order = np.argsort(-counts, kind="stable")
    left = len(held) - np.cumsum(counts[order])
    hot = np.union1d(hot, values[order[: int(np.count_nonzero(left > most)) + 1]])
    goes = np.isin(held["h"], hot)
    return held[~goes], held[goes], hot


def spans_of(documents: DataFrame, passes: int = PASSES, held_bytes: int = HELD_BYTES, bucket_bytes: int = BUCKET_BYTES, most_partitions: int = MOST_PARTITIONS) -> DataFrame:
    """(doc_id, row, start, end): spans to remove, which may overlap, in the shared folder."""
    spark = documents.sparkSession
    d = documents.where("doc_id is not null").select("doc_id", "text", text_row().alias("row"))
    buckets = max(spark.sparkContext.defaultParallelism, int(_size(documents) * WIRE.itemsize / 18 / passes / bucket_bytes) + 1)
    parts = min(buckets, most_partitions)
    path = new_path(spark, "spans")
    to = _partition_keys(spark, parts)
    for step in range(passes):

        def send(batches: Iterator[pa.RecordBatch], step: int = step) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = []
            text = 0

            def flush() -> Iterator[pa.RecordBatch]:
                r, spans = settle(np.concatenate(held))
                spans = _merge(spans)
                bucket = (r["h"] >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                r, bucket = to_wire(_pick(r, order)), bucket[order].astype(np.int64)
                first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(r) else np.zeros(0, np.int64)
                data = [r[a:b].tobytes() for a, b in zip(first, [*first[1:], len(r)])]
                ids, kinds = bucket[first].tolist(), [0] * len(data)
                if len(spans):
                    ids.append(int(spans["doc"][0] % buckets)), data.append(spans.tobytes()), kinds.append(1)
                for a in range(0, len(data), 64):
                    mine = ids[a : a + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([int(to[i % parts]) for i in mine], pa.int64()), pa.array(mine, pa.int64()), pa.array(kinds[a : a + 64], pa.int32()), pa.array(data[a : a + 64], pa.binary())], ["part", "bucket", "kind", "data"])

            for batch in batches:
                for part in slices(batch, most=BLOCK_BYTES):
                    b, off = raw(part.column("text"))
                    for r in _pieces(part.column("doc_id").to_numpy(), part.column("row").to_numpy(), b, off, step, passes):
                        held.append(r)
                    text += len(b)
                    if text >= FLUSH_BYTES:
                        yield from flush()
                        held, text = [], 0
            if held:
                yield from flush()

        names = ["kind", "one", "two", "doc_id", "row", "start", "end"]

        def out(kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(columns[0]), 100_000):
                c = [pa.array(np.ascontiguousarray(x[a : a + 100_000]).astype(np.int64)) for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c[0]), kind, np.int32)), *c], names)

        def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Buckets in turn; what belongs to one comes together."""
            now, held, size, hot, spans = None, [], 0, np.zeros(0, np.uint64), []

            def done() -> Iterator[pa.RecordBatch]:
                if held:
                    spans.append(bucket_spans(np.concatenate(held)))
                s = _merge(np.concatenate(spans)) if spans else np.zeros(0, SPAN)
                zero = np.zeros(len(s), np.int64)
                yield from out(1, [zero, zero, s["doc"], s["row"], s["start"], s["end"]])

            for batch in batches:
                for bucket, kind, data in zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), batch.column("data")):
                    if bucket != now:
                        yield from done()
                        now, held, size, hot, spans = bucket, [], 0, hot[:0], []
                    if kind:
                        spans.append(np.frombuffer(data.as_buffer(), SPAN))
                        continue
                    r, goes = from_wire(np.frombuffer(data.as_buffer(), WIRE)), []
                    if len(hot):
                        apart = np.isin(r["h"], hot)
                        r, goes = r[~apart], [r[apart]]
                    held.append(r)
                    size += r.nbytes
                    if size > held_bytes:
                        rest, gone = settle(np.concatenate(held))
                        spans.append(gone)
                        if rest.nbytes > held_bytes // 2:
                            rest, more, hot = parted(rest, hot, held_bytes // 2 // RECORD.itemsize)
                            goes.append(more)
                        held, size = [rest], rest.nbytes
                    for g in goes:
                        for strings in strings_of(g):
                            yield from out(0, [*strings.T, strings[:, 4] + LENGTH])
            yield from done()
            held, spans = [], []
            tidy()

        sent = d.mapInArrow(send, "part long, bucket long, kind int, data binary").repartition(parts, "part").sortWithinPartitions("part", "bucket")
        sent.mapInArrow(sort, "kind int, one long, two long, doc_id long, row long, start long, end long").write.mode("append").partitionBy("kind").parquet(path)
        del sent
        free_shuffles(spark)
    every = spark.read.schema("one long, two long, doc_id long, row long, start long, end long, kind int").parquet(path)
    spans, strings = every.where("kind = 1"), every.where("kind = 0")
    if not strings.isEmpty():
        least = strings.groupBy("one", "two").agg(F.min("doc_id").alias("least"))
        spans = spans.unionByName(strings.join(least, ["one", "two"]).where("doc_id > least").select(*spans.columns))
    return spans.select("doc_id", "row", "start", "end")


def text_row() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _keep(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int, int]:
    """(kept bytes, bytes removed, runs removed) for spans in any order."""
    zero = np.zeros(len(starts), np.int64)
    s = _merge(_spans(zero, zero, starts, np.minimum(ends, len(text))))
    s = s[s["start"] < s["end"]]
    kept, at = [], 0
    for a, b in zip(s["start"].tolist(), s["end"].tolist()):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept), int((s["end"].astype(np.int64) - s["start"]).sum()), len(s)


def _joined(documents: DataFrame, **options) -> tuple[DataFrame, str]:
    """The documents with a column of spans, and its name: one that no column of theirs has."""
    row, spans = free_name(documents.columns, "_row"), free_name(documents.columns, "_spans")
    found = spans_of(documents, **options).groupBy(F.col("doc_id").alias("_id"), "row").agg(F.collect_list(F.struct("start", "end")).alias("_found"))  # no more than the text's anchors
    d, s = documents.withColumn(row, text_row()).alias("d"), found.alias("s")
    j = d.join(s, (F.col("d.doc_id") == F.col("s._id")) & (F.col(f"d.{row}") == F.col("s.row")), "left")
    return j.select(*[F.col(f"d.`{c}`") for c in documents.columns], F.col("s._found").alias(spans)), spans


def _each(batch: pa.RecordBatch, spans: str) -> Iterator[tuple[bytes, int, int]]:
    for text, found in zip(batch.column("text").to_pylist(), batch.column(spans)):
        data = (text or "").encode()
        if found.is_valid:
            f = found.values
            yield _keep(data, f.field("start").to_numpy(), f.field("end").to_numpy())
        else:
            yield data, 0, 0


def suffix_dedup(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document; options: those of ``spans_of``."""
    joined, spans = _joined(documents.select("doc_id", "text"), **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [(len(k) + n, n, s, hashlib.sha256(k).hexdigest()) for k, n, s in _each(part, spans)]
                n, gone, runs, sha = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(documents: DataFrame, **options) -> DataFrame:
    """The documents with their repeats cut from text, and n_chars counted again if there is such a column."""
    schema = documents.schema
    joined, spans = _joined(documents, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [k.decode("utf-8", "ignore") if n else t for (k, n, _), t in zip(_each(part, spans), part.column("text").to_pylist())]
                columns = []
                for f in schema:
                    c = part.column(f.name)
                    if f.name == "text":
                        c = pa.array(texts, c.type)
                    elif f.name == "n_chars":
                        c = pa.array([len(t or "") for t in texts]).cast(c.type)
                    columns.append(c)
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)


def brute_force(rows: list[tuple[int, bytes]], length: int = LENGTH) -> list[tuple[int, int, int, int, str]]:
    """The definition, string by string, for tests: (doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    first: dict[bytes, int] = {}
    for doc, b in sorted(rows):
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], doc)
    out = []
    for doc, b in rows:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < doc:
                gone[i : i + length] = True
        runs = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(int)]) == 1))
        out.append((doc, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


#: DuckDB SQL over the view ``documents`` that gives ``suffix_dedup``'s rows (doc_ids not null), byte by byte in hexadecimal
REPEATS_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT rid, doc_id, i, substring(h, 2 * i + 1, 100) AS s FROM (SELECT rid, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s),
hit AS (SELECT rid, i FROM g JOIN f USING (s) WHERE doc_id > least),
marked AS (SELECT rid, i, coalesce((i - lag(i) OVER (PARTITION BY rid ORDER BY i) > 50)::INT, 1) AS fresh FROM hit),
spans AS (SELECT rid, min(i) AS a, max(i) + 50 AS b FROM (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS island FROM marked) GROUP BY rid, island),
cut AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT rid, count(*) AS n, sum(b - a) AS gone, max(b) AS last, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS k FROM cut JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE k || substring(h, 2 * last + 1) END)) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""
