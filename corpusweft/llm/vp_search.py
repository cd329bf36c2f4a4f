"""Approximate nearest neighbours by inner product: vantage-point trees per shard.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2) with M the
largest norm (0 for queries): the nearest such vectors have the largest products. A
coarse vantage-point tree, fitted on a sample of at most ``SAMPLE_ROWS`` vectors and
``SAMPLE_BYTES``, sends every vector to one shard of about ``SHARD_BYTES``; a leaf that gets
more than twice that is dealt over several shards by a hash. Each shard builds its own
tree of all its vectors. A query visits its home leaf first and takes the distance of its
k-th nearest there to the coarse tree, which yields the other leaves that it must visit.

A subtree on the far side of a sphere of radius mu around a vantage point at distance d
is skipped if |d - mu| > tau / factor, tau being the k-th nearest distance so far. Factor
1 is the triangle inequality and exact; a larger one skips more. How much may be skipped
depends on the data, so where no factor is given, the largest of ``FACTORS`` is taken whose
recall on the sample, against brute force, is at least ``RECALL``.

Whatever lies within rounding of the k-th distance is scored exactly, in double precision
on the original vectors, summed in order of the coordinates, before ranks are given: ties
are exact and go to smaller ids. Equal vectors are one entry with the smallest k + 1 ids,
which are all that any answer can hold; that bounds hot groups of copies and loses
nothing. Equal query vectors are searched once.

Defined results: vectors that are null, empty, zero, of another length than most, or
hold null or non-finite components take no part; neither do null ids; repeated rows (one
id, one vector) count once; an id with several vectors counts with each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .near_dedup import groups
from .shared import written
from .textops import mix

NEIGHBOURS, QUERY_MODULUS = 20, 20
FACTORS, RECALL, TRIED = (1.0, 1.2, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0), 0.98, 200
SAMPLE_ROWS, SAMPLE_BYTES, SHARD_BYTES, LEAF = 20_000, 32 << 20, 20 << 20, 256
QUERY_BLOCK = 4096
ROUNDING = 1e-9  # of the largest squared distance


class Tree:
    """A vantage-point tree over the rows of x; ties of distance go inside."""

    def __init__(self, x: np.ndarray, leaf: int, seed: int = 7) -> None:
        self.x, self.nodes = x, []
        rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(x)), leaf, rng)

    def _build(self, rows: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        me = len(self.nodes)
        self.nodes.append(None)
        if len(rows) > leaf:
            # the candidate whose distances spread most makes the best vantage point
            some = self.x[rng.choice(rows, min(len(rows), 200), replace=False)]
            tried = rng.choice(rows, 8)
            vp = self.x[max(tried, key=lambda t: np.linalg.norm(some - self.x[t], axis=1).std())]
            d = np.linalg.norm(self.x[rows] - vp, axis=1)
            mu = float(np.median(d))
            inside = d <= mu
            if 0 < inside.sum() < len(rows):
                self.nodes[me] = (vp, mu, self._build(rows[inside], leaf, rng), self._build(rows[~inside], leaf, rng))
                return me
        self.nodes[me] = rows
        return me

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf (by node number) that each row of x falls into."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if isinstance(self.nodes[node], np.ndarray):
                out[rows] = node
                continue
            vp, mu, inside, outside = self.nodes[node]
            near = np.linalg.norm(x[rows] - vp, axis=1) <= mu
            todo += [(inside, rows[near]), (outside, rows[~near])]
        return out

    def leaves_within(self, x: np.ndarray, tau: np.ndarray, factor: float, slack: float) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of x that must visit it)."""
        todo, reach = [(self.root, np.arange(len(x)))], tau / factor + slack
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if isinstance(self.nodes[node], np.ndarray):
                yield node, rows
                continue
            vp, mu, inside, outside = self.nodes[node]
            d = np.linalg.norm(x[rows] - vp, axis=1) - mu
            todo += [(inside, rows[d <= reach[rows]]), (outside, rows[-d <= reach[rows]])]

    def search(self, q: np.ndarray, ids: np.ndarray, k: int, factor: float, norm: float, tau: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(products, ids) of the k nearest found for each row of q, best first; missing ones are -inf.

        q and the tree's rows are lifted; products are those of the vectors as they were.
        """
        score, best = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, np.int64)
        bound = np.full(len(q), np.inf) if tau is None else tau.astype(float).copy()
        sq, qs = (self.x**2).sum(axis=1), (q**2).sum(axis=1)
        slack2 = ROUNDING * (norm**2 + (qs.max() if len(q) else 0.0))
        slack = np.sqrt(slack2)

        def leaf(n: np.ndarray, who: np.ndarray) -> None:
            d2 = qs[who, None] + sq[n][None, :] - 2 * q[who] @ self.x[n].T
            far = bound[who] ** 2
            if len(n) > k:
                far = np.minimum(far, np.partition(d2, k - 1, axis=1)[:, k - 1])
            near = d2 <= (far + 2 * slack2)[:, None]
            some = near.any(axis=1)
            if not some.any():
                return
            who, near = who[some], near[some]
            i, j = np.nonzero(near)
            s = np.empty(len(i))
            for a in range(0, len(i), 16_384):  # in order of the coordinates, so that equal vectors score alike
                z = slice(a, a + 16_384)
                s[z] = np.cumsum(q[who[i[z]], :-1] * self.x[n[j[z]], :-1], axis=1)[:, -1]
            row = np.concatenate([np.repeat(np.arange(len(who)), k), i])
            value, name = np.concatenate([score[who].ravel(), s]), np.concatenate([best[who].ravel(), ids[n[j]]])
            order = np.lexsort((name, -value, row))
            row, value, name = row[order], value[order], name[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            top = place < k
            score[who], best[who] = value[top].reshape(-1, k), name[top].reshape(-1, k)
            bound[who] = np.minimum(bound[who], np.sqrt(np.maximum(qs[who] + norm**2 - 2 * score[who, k - 1], 0)))

        def visit(node: int, who: np.ndarray) -> None:
            if not len(who):
                return
            n = self.nodes[node]
            if isinstance(n, np.ndarray):
                leaf(n, who)
                return
            vp, mu, inside, outside = n
            d = np.linalg.norm(q[who] - vp, axis=1) - mu
            near = d <= 0
            visit(inside, who[near])
            visit(outside, who[~near])
            visit(outside, who[near & (-d <= bound[who] / factor + slack)])
            visit(inside, who[~near & (d <= bound[who] / factor + slack)])

        for a in range(0, len(q), QUERY_BLOCK):
            visit(self.root, np.arange(a, min(a + QUERY_BLOCK, len(q))))
        return score, best


def tuned_factor(x: np.ndarray, norm: float, k: int, leaf: int, least: float = RECALL) -> float:
    """The largest factor whose recall among the vectors x, of which some are queries, is at least ``least``."""
    if len(x) <= leaf:
        return 1.0
    tree, ids = Tree(_lift(x, norm), leaf), np.arange(len(x))
    q = np.concatenate([x[:: -(-len(x) // TRIED)], np.zeros((-(-len(x) // -(-len(x) // TRIED)), 1))], axis=1)
    exact = np.sort(q[:, :-1] @ x.T, axis=1)[:, -min(k, len(x))]
    for factor in sorted(FACTORS, reverse=True):
        found = (tree.search(q, ids, k, factor, norm)[0] >= exact[:, None] - ROUNDING * norm**2).sum(axis=1)
        if np.minimum(found, k).mean() >= least * min(k, len(x)):
            return factor
    return 1.0


def _lift(x: np.ndarray, largest: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(largest**2 - (x**2).sum(axis=1), 0))[:, None]], axis=1)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def usable(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    e = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    sound = "vec_id is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)"
    return e.where(sound)


def nearest(embeddings: DataFrame, k: int = NEIGHBOURS, modulus: int = QUERY_MODULUS, factor: float | None = None, shard_rows: int | None = None, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each vector whose id the modulus divides."""
    spark = embeddings.sparkSession
    e = usable(embeddings)
    # the copies of one vector are cut to k + 1 ids on the map side already
    smallest = W.partitionBy("embedding").orderBy("vec_id")
    few = e.dropDuplicates(["vec_id", "embedding"]).withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= k + 1)
    entries = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = written(entries.withColumn("entry", F.element_at("ids", 1)), "entries")
    stats = entries.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("sqrt(aggregate(embedding, 0D, (a, x) -> a + x * x))")).alias("norm")).orderBy(F.desc("n"), "dim").first()
    out_schema = "query_id long, rank int, vec_id long, score double"
    if stats is None:
        return spark.createDataFrame([], out_schema)
    dim, n, largest = stats["dim"], stats["n"], float(stats["norm"])
    entries = entries.where(F.size("embedding") == dim)
    queries = written(e.where((F.col("vec_id") % modulus == 0) & (F.size("embedding") == dim)).dropDuplicates(["vec_id", "embedding"]), "queries")
    asked = queries.groupBy("embedding").agg(F.min("vec_id").alias("q"))
    shard_rows = shard_rows or max(1, SHARD_BYTES // (8 * dim))
    shards = -(-n // shard_rows)
    sample = np.zeros((0, dim))
    if shards > 1 or factor is None:
        some = min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (8 * dim)))
        sample = _vectors(entries.orderBy(F.xxhash64("entry"), "entry").limit(some).select("embedding").toArrow()["embedding"].combine_chunks())
    factor = factor or tuned_factor(sample, largest, k + 1, leaf)
    coarse = Tree(_lift(sample, largest) if shards > 1 else np.zeros((0, dim + 1)), max(1, -(-len(sample) // shards)))
    slack = float(np.sqrt(ROUNDING) * 2 * largest)
    names = ["shard", "part", "tau", "kind", "id", "embedding"]
    schema = "shard long, part int, tau double, kind byte, id long, embedding array<double>"

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, times = np.unique(coarse.leaf_of(_lift(_vectors(b.column("embedding")), largest)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], ["shard", "n"])

    # leaves of the coarse tree, so no more rows than its sample
    sizes = entries.select("embedding").mapInArrow(leaves, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * shard_rows).collect() if shards > 1 else []
    parts = {r["shard"]: -(-r["n"] // shard_rows) for r in sizes}

    def asked_of(b: pa.RecordBatch, shard: int, tau: pa.Array) -> Iterator[pa.RecordBatch]:
        m = b.num_rows
        for p in range(parts.get(shard, 1)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, shard)), pa.array(np.full(m, p, np.int32)), tau, pa.array(np.ones(m, np.int8)), b.column("q"), b.column("embedding")], names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, ids = _lift(_vectors(b.column("embedding")), largest), b.column("entry").to_numpy()
            at = coarse.leaf_of(x)
            over = np.array([parts.get(i, 1) for i in at.tolist()], np.uint64)
            part = (mix(ids.astype(np.uint64)) % over).astype(np.int32) if len(ids) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(part), pa.array(np.zeros(len(x))), pa.array(np.zeros(len(x), np.int8)), b.column("entry"), b.column("embedding")], names)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column("embedding"))
            own = coarse.leaf_of(np.concatenate([x, np.zeros((len(x), 1))], axis=1))
            for shard in np.unique(own).tolist():
                mine = b.take(pa.array(np.flatnonzero(own == shard)))
                yield from asked_of(mine, shard, pa.array(np.full(mine.num_rows, np.inf)))

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column("embedding"))
            lifted = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
            own, tau = coarse.leaf_of(lifted), b.column("tau").to_numpy()
            for shard, who in coarse.leaves_within(lifted, tau, factor, slack):
                who = who[own[who] != shard]
                if len(who):
                    mine = b.take(pa.array(who))
                    yield from asked_of(mine, shard, mine.column("tau"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's entries come first and make its tree; its queries then stream past in blocks."""
        shard, held, tree, ids = None, [], None, np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            kinds, where = b.column("kind").to_numpy(), np.stack([b.column("shard").to_numpy(), b.column("part").to_numpy()], axis=1)
            edge = np.flatnonzero(np.r_[True, (kinds[1:] != kinds[:-1]) | (where[1:] != where[:-1]).any(axis=1)])
            for a, z in zip(edge, [*edge[1:], len(kinds)]):
                part = b.slice(a, z - a)
                if tuple(where[a]) != shard:
                    shard, held, tree = tuple(where[a]), [], None
                if kinds[a] == 0:
                    held.append(part)
                    continue
                if tree is None:
                    x = np.concatenate([_vectors(h.column("embedding")) for h in held]) if held else np.zeros((0, dim))
                    ids = np.concatenate([h.column("id").to_numpy() for h in held]) if held else ids[:0]
                    tree, held = Tree(_lift(x, largest), leaf), []
                q = _vectors(part.column("embedding"))
                score, found = tree.search(np.concatenate([q, np.zeros((len(q), 1))], axis=1), ids, k + 1, factor, largest, part.column("tau").to_numpy())
                who, at = np.nonzero(np.isfinite(score))
                d = np.sqrt(np.maximum((q[who] ** 2).sum(axis=1) + largest**2 - 2 * score[who, at], 0))
                yield pa.RecordBatch.from_arrays([pa.array(part.column("id").to_numpy()[who]), pa.array(found[who, at]), pa.array(score[who, at]), pa.array(d)], ["q", "entry", "score", "distance"])

    entry_rows = entries.select("entry", "embedding").mapInArrow(place, schema)
    run = lambda rows: entry_rows.unionByName(rows).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind").mapInArrow(search, "q long, entry long, score double, distance double")
    first = written(run(asked.mapInArrow(home, schema)), "home")
    if shards > 1:
        kth = first.withColumn("_n", F.row_number().over(W.partitionBy("q").orderBy("distance"))).where(F.col("_n") == k + 1).select("q", F.col("distance").alias("tau"))
        visit = asked.join(kth, "q", "left").select("q", "embedding", F.coalesce("tau", F.lit(float("inf"))).alias("tau"))
        first = first.unionByName(run(visit.mapInArrow(away, schema)))
    # best k + 1 entries of each query vector, then their ids, then each query's own id out
    top = W.partitionBy("q").orderBy(F.desc("score"), "entry")
    best = first.withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= k + 1).select("q", "entry", "score")
    answers = best.join(entries.select("entry", "ids"), "entry").select("q", F.explode("ids").alias("vec_id"), "score")
    final = queries.join(asked, "embedding").select("q", F.col("vec_id").alias("query_id")).join(answers, "q").where("vec_id <> query_id")
    rank = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return final.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
