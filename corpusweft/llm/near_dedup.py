"""SimHash near-duplicates by random bit sampling.

Two texts are near-duplicates if their sets of 5-word shingles have a Jaccard
similarity of ``SIMILAR`` or more; classes are the connected components.

1. One pass gives each text its 128-bit hash, a ``BITS``-bit SimHash of its shingles, and
   the ``SAMPLE`` smallest shingle hashes. Equal texts, then equal SimHashes, are
   represented by their smallest doc_id, whatever their number.
2. Each of ``TABLES`` hash tables groups the representatives by ``SAMPLED`` random
   coordinates of the SimHash. Texts at similarity 0.8 differ in each coordinate with
   probability 0.15, so they share a bucket of some table in more than 99 of 100 cases.
   Where a bucket would take more than ``CAP`` squared comparisons it is cut by ``EXTRA``
   further coordinates, in ``WAYS`` independent ways, so that a pair at 0.8 stays together
   in one of them with probability 0.99; a bucket above ``SPLIT`` is cut that way before
   the shuffle. What is left after ``LEVELS`` cuts is compared as a whole.
3. Pairs of a bucket within Hamming distance ``LOOSE`` become links; a bucket emits a
   spanning forest of them, and members that are connected already aren't compared again,
   so a mass of near-equal texts costs one comparison each. Their components are loose
   families, which hold every pair at ``SIMILAR`` found but also less similar texts.
4. All pairs of a family within ``LOOSE`` that would join two parts are verified by the
   shingle samples: exact for texts of up to ``SAMPLE`` distinct shingles. Beyond, the
   estimate's standard error is about 0.012; within ``CLEAR`` of ``SIMILAR`` it decides
   nothing, and the whole sets are compared. Families are dealt into blocks of ``BLOCK``,
   a task for each two blocks, so that no task holds more than two.
5. SimHash is coarse for short texts: those of at most ``SHORT`` distinct shingles are also
   grouped by the smallest of their shingles, as many as one of two sets at ``SIMILAR``
   can't do without, and verified there within ``LOOSE_SHORT``.

Defined results: a null text counts as empty, and all texts without a word are equal to
each other only if their characters are; a text of one to four words has its word
sequence as its one shingle; a null doc_id stands alone, in a null class; repeated rows
and rows sharing a doc_id fall into one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import written
from .textops import M1, grams, mix, raw, slices, tidy, words

SHINGLE, SIMILAR = 5, 0.8
BITS, SAMPLE = 256, 1024
TABLES, SAMPLED = 40, 12
CAP, EXTRA, WAYS, LEVELS, SPLIT = 1024, 8, 20, 4, 500_000
LOOSE, BLOCK, SHORT, LOOSE_SHORT = 58, 8192, 30, 96
CLEAR, TASK_PAIRS, PART = 0.06, 128, 2048
LONG_WORD, FEW, CELLS = 128, 96, 1 << 15  # CELLS: pairs at a time, whose arrays stay in a core's cache

_RNG = np.random.default_rng(20240229)
#: coordinates of each table, and of each way to cut a bucket further
SAMPLES = np.stack([_RNG.permutation(BITS)[:SAMPLED] for _ in range(TABLES)])
CUTS = np.stack([[_RNG.permutation(BITS)[:EXTRA] for _ in range(WAYS)] for _ in range(LEVELS)])
_SEEDS = [np.uint64(x) for x in _RNG.integers(1, 2**63, BITS // 64)]
_LANES = np.array([sum(((b >> (7 - i)) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def _short_hashes(values: pa.Array) -> np.ndarray:
    """64-bit hash of each word, eight bytes of all words at a time; a long word has the library's."""
    b, off = raw(values)
    start, size = off[:-1], np.diff(off)
    chunks = np.ndarray((len(b) + 1,), "<u8", np.concatenate([b, np.zeros(8, np.uint8)]).data, 0, (1,))
    h = mix(size.astype(np.uint64) * M1)
    at = np.flatnonzero(size <= LONG_WORD)
    for done in range(0, LONG_WORD, 8):
        at = at[size[at] > done]
        if not len(at):
            break
        unused = np.maximum(0, 8 - (size[at] - done)).astype(np.uint64) << np.uint64(3)
        h[at] = mix((h[at] ^ (chunks[start[at] + done] << unused)) * M1)
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        h[k] = xxhash.xxh64_intdigest(b[off[k] : off[k + 1]].tobytes())
    return h


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and n + 1 offsets."""
    values, off = words(texts)
    h = _short_hashes(values)
    g, row, _ = grams(h, off, SHINGLE)
    size = np.diff(off)
    few = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(few):
        place = np.searchsorted(row, few)
        g = np.insert(g, place, np.array([np.uint64(xxhash.xxh64_intdigest(h[off[i] : off[i + 1]].tobytes())) for i in few], np.uint64))
        row = np.insert(row, place, few)
    cuts = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        g[a:b].sort()
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[fresh], row[fresh]
    return g, np.searchsorted(row, np.arange(len(texts) + 1))


def simhash(g: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, BITS / 64) words: the majority of each bit over a row's shingles.

    Bits are counted eight to a 64-bit word, in runs of at most 255 shingles.
    """
    n = len(off) - 1
    counts = np.zeros((n, BITS), np.int32)
    size = np.diff(off)
    if len(g):
        bits = np.stack([mix(g ^ s) for s in _SEEDS], axis=1).view(np.uint8)
        runs = np.concatenate([np.arange(a, b, 255) for a, b in zip(off[:-1], off[1:]) if b > a])
        lanes = np.empty((len(runs), BITS // 8), np.uint64)
        ends, first = np.r_[runs[1:], len(g)], 0
        while first < len(runs):  # some runs at a time, whose lanes stay in a core's cache
            stop = max(first + 1, int(np.searchsorted(ends, runs[first] + 2048, side="right")))
            a, b = runs[first], ends[stop - 1]
            lanes[first:stop] = np.add.reduceat(_LANES[bits[a:b]], runs[first:stop] - a, axis=0)
            first = stop
        lanes = lanes.view(np.uint8)
        owner = np.searchsorted(off, runs, side="right") - 1
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        counts[owner[first]] = np.add.reduceat(lanes, first, axis=0, dtype=np.int32)
    return np.packbits(2 * counts > size[:, None], axis=1).view(np.uint64)


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, sketch (BITS / 8 bytes) and sample (little-endian uint32, ascending; the last is the set's size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = pc.fill_null(part.column("text"), "")
                g, off = shingle_sets(texts)
                s = simhash(g, off)
                short = (g >> np.uint64(32)).astype("<u4")
                keys = [xxhash.xxh128_digest(t) for t in texts.to_pylist()]
                sample = [short[a : min(b, a + SAMPLE)].tobytes() + np.uint32(b - a).tobytes() for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(keys, pa.binary()), pa.array([x.tobytes() for x in s], pa.binary()), pa.array(sample, pa.binary())], ["doc_id", "text_key", "sketch", "sample"])

    return documents.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id long, text_key binary, sketch binary, sample binary")


def codes(bits: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
    """Some coordinates of unpacked sketches as integers."""
    return bits[:, coordinates].astype(np.int64) @ (1 << np.arange(len(coordinates), dtype=np.int64))


def _unpack(batch: pa.RecordBatch) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, BITS // 8), axis=1)


def bucketed(reps: DataFrame, most: int = SPLIT) -> DataFrame:
    """(bucket, id, sketch) in all tables; buckets above ``most`` are cut before anything gathers them."""
    names = ["bucket", "id", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _unpack(batch)
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([pa.array(codes(bits, SAMPLES[t]) + (t << 40)), batch.column("id"), batch.column("sketch")], names)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, old = _unpack(batch), batch.column("bucket").to_numpy()
            for w in range(WAYS):
                new = codes(bits, CUTS[0, w]) + (w << EXTRA) + 1
                yield pa.RecordBatch.from_arrays([pa.array(old + (new << SAMPLED)), batch.column("id"), batch.column("sketch")], names)

    schema = "bucket long, id long, sketch binary"
    all_rows = reps.mapInArrow(run, schema)
    large = all_rows.groupBy("bucket").count().where(F.col("count") > most).select("bucket")
    if large.isEmpty():
        return all_rows
    large = written(large, "large")
    return all_rows.join(large, "bucket", "left_anti").unionByName(all_rows.join(large, "bucket", "left_semi").mapInArrow(split, schema))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        change = np.flatnonzero(k[1:] != k[:-1])
        new = held and held[-1].column(key)[-1].as_py() != k[0]
        if new:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
    del held
    tidy()


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b

    def roots(self, rows: np.ndarray) -> np.ndarray:
        r = self.up[rows]
        while True:
            further = self.up[r]
            if (further == r).all():
                self.up[rows] = r
                return r
            r = further


def _hamming(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of the sketches in the rows of x and y."""
    d = np.bitwise_count(x ^ y)
    return d[:, 0].astype(np.uint16) + d[:, 1] + d[:, 2] + d[:, 3]


class Linker:
    """Joins positions whose sketches lie within ``limit`` and that pass ``check``, if there is one.

    ``split`` cuts runs that would take too many comparisons by further coordinates.
    """

    def __init__(self, sketch: np.ndarray, limit: int, check: Callable[[int, int], bool] | None = None, split: bool = True) -> None:
        self.sketch, self.limit, self.check, self.split = sketch, limit, check, split
        self.forest, self.a, self.b = Forest(len(sketch)), [], []
        self.columns = np.ascontiguousarray(sketch.T)

    def _distances(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return _hamming(self.sketch.take(x, axis=0), self.sketch.take(y, axis=0))

    def _try(self, x: np.ndarray, y: np.ndarray, d: np.ndarray) -> None:
        """Join pairs by rising distance; after some, those that are connected meanwhile fall out."""
        order, some = np.argsort(d, kind="stable"), 256
        x, y = x[order], y[order]
        while len(x):
            apart = self.forest.roots(x) != self.forest.roots(y)
            x, y = x[apart], y[apart]
            for i, j in zip(x[:some].tolist(), y[:some].tolist()):
                if self.forest.root(i) != self.forest.root(j) and (self.check is None or self.check(i, j)):
                    self.forest.join(i, j)
                    self.a.append(i), self.b.append(j)
            x, y, some = x[some:], y[some:], 2 * some

    def small(self, rows: np.ndarray, key: np.ndarray) -> None:
        """All pairs in runs of an ascending key, by their lag."""
        ends, at, lag = np.searchsorted(key, key, side="right"), np.arange(len(key)), 1
        while len(at):
            at = at[at + lag < ends[at]]
            for part in np.array_split(at, len(at) // CELLS + 1):
                x, y = rows[part], rows[part + lag]
                d = self._distances(x, y)
                near = d <= self.limit
                if near.any():
                    self._try(x[near], y[near], d[near])
            lag += 1

    def _against(self, some: np.ndarray, others: np.ndarray, above: bool = False) -> None:
        """Pairs of some and others; ``above``: others begin with some, each pair once."""
        step = max(1, CELLS // max(1, len(others)))
        across, down = self.columns[:, others], self.columns[:, some]
        for s in range(0, len(some), step):
            x, y, from_ = some[s : s + step], others, 0
            if above:
                y, from_ = others[s + 1 :], s + 1
            d = np.bitwise_count(down[0, s : s + step, None] ^ across[0, from_:])
            for w in range(1, BITS // 64):
                d += np.bitwise_count(down[w, s : s + step, None] ^ across[w, from_:])
            near = np.flatnonzero(d <= self.limit)  # BITS differences count as none here
            if not len(near):
                continue
            i, j = np.divmod(near, len(y))
            if above:
                i, j = i[j >= i], j[j >= i]
            i, j = x[i], y[j]
            apart = self.forest.roots(i) != self.forest.roots(j)
            i, j = i[apart], j[apart]
            d = self._distances(i, j)
            self._try(i[d <= self.limit], j[d <= self.limit], d[d <= self.limit])

    def _loose(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows outside the largest part of a run, and that part's."""
        roots = self.forest.roots(rows)
        values, counts = np.unique(roots, return_counts=True)
        main = roots == values[counts.argmax()]
        return rows[~main], rows[main]

    def run(self, rows: np.ndarray, level: int = 1) -> None:
        """All pairs of one run, or of the smaller ones that it is cut into."""
        self._against(rows[:: max(1, len(rows) // 8)][:8], rows)  # joins a mass of near-equal members at once
        loose, main = self._loose(rows)
        if not len(loose):
            return
        if not self.split or level >= LEVELS or len(loose) * len(rows) <= CAP * CAP:
            self._against(loose, np.concatenate([loose, main]), above=True)
            return
        bits = np.unpackbits(self.sketch[rows].view(np.uint8), axis=1)
        for w in range(WAYS):
            code = np.packbits(bits[:, CUTS[level, w]], axis=1)[:, 0]
            order = np.argsort(code, kind="stable")
            self._parts(rows[order], code[order], level + 1)

    def _parts(self, rows: np.ndarray, key: np.ndarray, level: int, few: int = FEW) -> None:
        """All runs of an ascending key: the short ones at once, by their lag, each other one by itself."""
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[starts, len(key)])
        small = np.flatnonzero(np.repeat(size <= few, size))
        self.small(rows[small], key[small])
        for s, n in zip(starts[size > few].tolist(), size[size > few].tolist()):
            self.run(rows[s : s + n], level)

    def runs(self, key: np.ndarray, few: int = FEW) -> None:
        """All runs of an ascending key."""
        self._parts(np.arange(len(key)), key, 1, few)


def _sketches(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(-1, BITS // 64)


def loose_links(buckets: DataFrame) -> DataFrame:
    """A spanning forest of the pairs within LOOSE of each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, "bucket"):
            ids, link = t["id"].to_numpy(), Linker(_sketches(t), LOOSE)
            link.runs(t["bucket"].to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(ids[np.array(x, np.int64)]) for x in (link.a, link.b)], ["a", "b"])

    return buckets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")


def similarity(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> float:
    """Jaccard similarity from the smallest hashes of two sets: exact if they are whole."""
    both = np.intersect1d(a, b, assume_unique=True)
    if na <= len(a) and nb <= len(b):
        return len(both) / max(1, len(a) + len(b) - len(both))
    union = np.union1d(a, b)[:SAMPLE]
    return np.count_nonzero(both <= union[-1]) / len(union)


def dealt(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Members (family, id, ...) with ``task``: each two blocks of a family meet in one."""
    n = members.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    m = members.join(n, "family").withColumn("mine", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pair = F.xxhash64("family", F.least("mine", "other"), F.greatest("mine", "other"))
    return m.select("*", other).select(*members.columns, F.when(F.col("blocks") > 1, pair).otherwise(F.xxhash64("family")).alias("task"))


def verified_links(members: DataFrame, limit: int = LOOSE, block: int = BLOCK) -> DataFrame:
    """(family, a, b, sure) of rows (family, id, sketch, sample): a spanning forest of each task's links at
    SIMILAR or more that are sure, and the pairs between its trees that the samples leave open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, "task"):
            key, family, ids = t["task"].to_numpy(), t["family"].to_numpy(), t["id"].to_numpy()
            raw, open_pairs = [np.frombuffer(x, "<u4") for x in t["sample"].to_pylist()], []

            def check(i: int, j: int) -> bool:
                ni, nj = int(raw[i][-1]), int(raw[j][-1])
                if family[i] != family[j] or not ni or min(ni, nj) < SIMILAR * max(ni, nj):
                    return False
                near = similarity(raw[i][:-1], raw[j][:-1], ni, nj)
                if max(ni, nj) > SAMPLE and abs(near - SIMILAR) <= CLEAR:
                    open_pairs.append((i, j))
                    return False
                return near >= SIMILAR

            link = Linker(_sketches(t), limit, check, split=False)
            link.runs(key)
            n, rest = len(link.a), [x for x in open_pairs if link.forest.root(x[0]) != link.forest.root(x[1])]
            a, b = (np.array([*own, *(x[k] for x in rest)], np.int64) for k, own in enumerate((link.a, link.b)))
            yield pa.RecordBatch.from_arrays([pa.array(family[a]), pa.array(ids[a]), pa.array(ids[b]), pa.array(np.arange(len(a)) < n)], ["family", "a", "b", "sure"])

    rows = dealt(members.select("family", "id", "sketch", "sample"), block)
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "family long, a long, b long, sure boolean")


def short_groups(owners: DataFrame) -> DataFrame:
    """(family, id, sketch, sample) of short texts, by each shingle of their prefixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for k, x in enumerate(batch.column("sample").to_pylist()):
                s = np.frombuffer(x, "<u4")
                if 0 < s[-1] <= SHORT:
                    first = s[: int(s[-1]) - int(np.ceil(SIMILAR * int(s[-1]) - 1e-9)) + 1]
                    at += [k] * len(first)
                    keys.append(first.astype(np.int64))
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)), *[rows.column(c) for c in ("id", "sketch", "sample")]], ["family", "id", "sketch", "sample"])

    return owners.select("id", "sketch", "sample").mapInArrow(run, "family long, id long, sketch binary, sample binary")


def exact_links(pairs: DataFrame, documents: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) of those pairs (family, a, b) whose whole shingle sets are at SIMILAR or more.

    A family's pairs are dealt to tasks by a block of a and one of b, so that a set is sent
    once for all of a task's pairs.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                g, off = shingle_sets(part.column("text"))
                texts, keys, ids = part.column("text").to_pylist(), part.column("text_key").to_pylist(), part.column("id").to_pylist()
                own = [k for k, t in enumerate(texts) if xxhash.xxh128_digest(t) == keys[k]]
                cuts = [(ids[k], g[c : min(c + PART, off[k + 1])].tobytes()) for k in own for c in range(off[k], off[k + 1], PART)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in cuts], pa.int64()), pa.array([x for _, x in cuts], pa.binary())], ["id", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, "task"):
            parts, asked, found = {}, [], []
            for task, i, other, part in zip(*(t[c].to_pylist() for c in ("task", "id", "other", "part"))):
                if part is None:
                    asked.append((task, i, other))
                else:
                    parts.setdefault((task, i), []).append(np.frombuffer(part, np.uint64))
            sets = {k: np.unique(np.concatenate(v)) for k, v in parts.items()}
            for task, i, j in asked:
                x, y = sets[task, i], sets[task, j]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= SIMILAR * (len(x) + len(y) - both):
                    found.append((i, j))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    blocks = pairs.groupBy("family").agg(F.ceil(F.sqrt(F.count("*") / TASK_PAIRS)).alias("blocks"))
    task = F.xxhash64("family", F.pmod(F.xxhash64("a"), "blocks"), F.pmod(F.xxhash64("b"), "blocks"))
    asked = written(pairs.join(blocks, "family").select(task.alias("task"), "a", "b").distinct(), "asked")
    ends = asked.select("task", F.col("a").alias("id")).unionByName(asked.select("task", F.col("b").alias("id"))).distinct()
    keys = members.join(ends.select("id").distinct(), "id", "left_semi").select("id", "text_key")
    # a set of that size has more bytes of text
    texts = documents.where(F.octet_length("text") > SAMPLE).select(F.col("doc_id").alias("id"), "text")
    sets = written(texts.join(keys, "id").select("id", "text", "text_key").mapInArrow(whole, "id long, part binary"), "sets")
    rows = sets.join(ends, "id").select("task", "id", F.lit(None).cast("long").alias("other"), "part")
    rows = rows.unionByName(asked.select("task", F.col("a").alias("id"), F.col("b").alias("other"), F.lit(None).cast("binary").alias("part")))
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def classes(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, class_id): class_id is the smallest doc_id of the class."""
    docs = written(sketches(documents), "sketches")
    by_text = written(docs.groupBy("text_key").agg(F.min("doc_id").alias("id"), F.min(F.struct("sketch")).alias("s")).select("text_key", "id", "s.sketch"), "texts")
    by_sketch = by_text.groupBy("sketch").agg(F.min("id").alias("lead"))
    same = by_text.join(by_sketch, "sketch").select("id", "lead")
    reps = written(by_sketch.select(F.col("lead").alias("id"), "sketch"), "reps")
    family = components(loose_links(bucketed(reps)).unionByName(same.where("id <> lead").select(F.col("id").alias("a"), F.col("lead").alias("b"))))
    # one row of each text: by both keys, as one text may have a third of all rows
    one = by_text.select("text_key", F.col("id").alias("doc_id"))
    own = lambda rows: rows.join(one, ["text_key", "doc_id"]).dropDuplicates(["text_key", "doc_id"]).withColumnRenamed("doc_id", "id")
    named = docs.join(family.select(F.col("node").alias("doc_id"), F.col("component").alias("family")), "doc_id")
    members = written(own(named).select("family", "id", "text_key", "sketch", "sample"), "members")
    short = short_groups(own(docs.where(F.octet_length("sample") <= 4 * (SHORT + 1))))
    checked = written(verified_links(members).unionByName(verified_links(short, LOOSE_SHORT)), "checked")
    sure, unsure = checked.where("sure").select("a", "b"), checked.where("not sure").select("family", "a", "b")
    if not unsure.isEmpty():
        sure = sure.unionByName(exact_links(unsure, documents, members))
    joined = components(sure)
    text_class = by_text.join(joined.withColumnRenamed("node", "id"), "id", "left").select("text_key", F.coalesce("component", "id").alias("class_id"))
    return docs.select("doc_id", "text_key").join(text_class, "text_key")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id and class_id of every row."""
    by_id = classes(documents).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    d = documents.select("doc_id")
    return d.join(by_id, "doc_id", "left")


def one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of each class's smallest doc_id, one row a doc_id; null doc_ids all stay."""
    keep = classes(documents).where("doc_id = class_id").select("doc_id").distinct()
    known = documents.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*documents.columns)
    return known.unionByName(documents.where("doc_id is null"))


#: DuckDB SQL over the view ``documents`` that gives ``near_duplicates``' rows (doc_ids unique), comparing all pairs that share a shingle
CLASSES_SQL = r"""
WITH RECURSIVE t AS (SELECT min(doc_id) AS id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents GROUP BY coalesce(text, '')),
s AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS shingle FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM t)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT x.id AS a, y.id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.id < y.id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 10 * common >= 8 * (x.n + y.n - common)),
r AS (SELECT id AS node, id AS root FROM t UNION SELECT e.b, r.root FROM r JOIN (SELECT a, b FROM l UNION ALL SELECT b, a FROM l) e ON e.a = r.node)
SELECT doc_id, class_id FROM documents JOIN t ON t.text = coalesce(documents.text, '') JOIN (SELECT node, min(root) AS class_id FROM r GROUP BY node) c ON c.node = t.id"""
