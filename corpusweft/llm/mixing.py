"""Mixing sources to target weights by weighted fair queueing.

Sources, in code point order with null last, weigh 5, 2, 1, repeating, and share
``BUDGET`` times all words. A source's target stops at ``MOST_EPOCHS`` times its words,
and what is cut off is shared again by weight until no target is above its cap
(water-filling: sources are capped in order of cap / weight, so sorted running sums
give the fixed point).

Each source's documents are shuffled by a hash of doc_id and queued; a document's
virtual finish time is the source's words up to and including it, divided by the
source's target, and its second copy follows after one whole pass. All copies are
range-sorted by that time and taken until the next would pass the total budget.

No window holds a source or the corpus: running sums are made in two levels, over
``SHUFFLE_BUCKETS`` ranges of the shuffle hash by source, and ``TIME_BUCKETS`` ranges of
virtual time; only the small table of sources is ordered as a whole.

Defined results: a null text has no words, and documents without words are never
taken; repeated rows queue one by one; a null doc_id is shuffled like any other; an
empty table gives an empty result; other columns pass through only in ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .shared import free_name, written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_EPOCHS = 2
TIME_BUCKETS = 4096
SEED = "mix"


def size_of(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def shuffle_key():
    return F.md5(F.concat_ws("#", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def sizes_of(documents: DataFrame) -> DataFrame:
    """rid, doc_id, source, size and the shuffle key of each row; rid is fixed by being written."""
    rows = documents.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", size_of().alias("size"), shuffle_key().alias("shuffle"))
    return written(rows, "sizes")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, sid, source_size and target; one row a source, the only table ordered as a whole."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("sid", F.row_number().over(order))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", (F.col("source_size") * epochs).cast("double"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(budget)))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("capped", F.col("cap") / F.col("weight") <= F.col("level"))
    fill = (F.first("total").over(everything) - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)) / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    return s.select("source", "sid", "source_size", "total", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * fill).alias("target"))


def queue(sizes: DataFrame, target: DataFrame, epochs: int = MOST_EPOCHS) -> DataFrame:
    """A row for each copy of each document, with its virtual finish time."""
    rows = sizes.join(target.drop("total"), sizes["source"].eqNullSafe(target["source"])).drop(target["source"]).where("size > 0 and target > 0")
    rows = rows.withColumn("sb", F.substring("shuffle", 1, 3))  # 4,096 ranges of the hash
    part = rows.groupBy("sid", "sb").agg(F.sum("size").alias("in_range"))
    prior = part.withColumn("prior", F.coalesce(F.sum("in_range").over(W.partitionBy("sid").orderBy("sb").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("in_range")
    own = W.partitionBy("sid", "sb").orderBy("shuffle", "doc_id", "rid").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("so_far", F.sum("size").over(own)).join(prior, ["sid", "sb"])
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return rows.withColumn("finish", (F.col("prior") + F.col("so_far") + F.col("copy") * F.col("source_size")) / F.col("target"))


def take(queued: DataFrame, total: DataFrame) -> DataFrame:
    """Range-sort by virtual finish time and keep what fits the budget: rid, copies, taken."""
    rows = queued.select("rid", "doc_id", "sid", "copy", "size", "finish", F.least(F.floor(F.col("finish") * (TIME_BUCKETS // 2)), F.lit(TIME_BUCKETS)).alias("tb"))
    part = rows.groupBy("tb").agg(F.sum("size").alias("in_range"))
    prior = part.withColumn("prior", F.coalesce(F.sum("in_range").over(W.orderBy("tb").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).crossJoin(F.broadcast(total)).where("prior < total")
    own = W.partitionBy("tb").orderBy("finish", "sid", "doc_id", "rid", "copy").rowsBetween(W.unboundedPreceding, 0)
    run = rows.join(F.broadcast(prior), "tb").withColumn("run", F.sum("size").over(own) + F.col("prior"))  # TIME_BUCKETS rows at most
    return run.where("run <= total").groupBy("rid").agg(F.sum("size").alias("taken"), F.count(F.lit(1)).alias("copies"))


def mix_sizes(sizes: DataFrame, **options) -> DataFrame:
    """Each row of ``sizes`` with source_size, target, taken and copies."""
    target = written(targets(sizes, **options), "targets")
    total = target.agg(F.max("total").alias("total"))  # one row
    taken = take(queue(sizes, target), total)
    out = sizes.join(target.drop("total"), sizes["source"].eqNullSafe(target["source"])).drop(target["source"]).join(taken, "rid", "left")
    return out.withColumns({"taken": F.coalesce("taken", F.lit(0)), "copies": F.coalesce("copies", F.lit(0))})


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mix_sizes(sizes_of(documents)).select("doc_id", "size", "source_size", "target", "taken")


def mixed(documents: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, a document taken twice as two rows.

    Rows are written with a number of their own, so that each, equal ones too, has its own
    decision and no join is on a key that many share; their sizes are written beside them, so
    that texts are read once for both.
    """
    columns = documents.columns
    rid, copy, size, shuffle = (free_name(columns, c) for c in ("_rid", "_copy", "_size", "_shuffle"))
    marked = written(documents.withColumns({rid: F.monotonically_increasing_id(), size: size_of(), shuffle: shuffle_key()}), "marked")
    sizes = marked.select(F.col(rid).alias("rid"), "doc_id", "source", F.col(size).alias("size"), F.col(shuffle).alias("shuffle"))
    times = mix_sizes(sizes).where("copies > 0").select(F.col("rid").alias(rid), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy))
    return marked.join(times, rid).select(*[F.col(f"`{c}`") for c in columns])


#: DuckDB SQL over the view ``documents`` that gives ``mix``'s rows
MIX_SQL = r"""
WITH sizes AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix#' || coalesce(doc_id::VARCHAR, '')) AS shuffle FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s),
c AS (SELECT *, ([5.0, 2.0, 1.0])[((sid - 1) % 3 + 1)::INT]::DOUBLE AS weight, (2 * source_size)::DOUBLE AS cap, (SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE AS total FROM w),
l AS (SELECT *, cap / weight <= (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped FROM c),
t AS (SELECT source, sid, source_size, total, CASE WHEN capped THEN cap ELSE weight * ((total - sum(CASE WHEN capped THEN cap ELSE 0.0::DOUBLE END) OVER ())
         / sum(CASE WHEN NOT capped THEN weight END) OVER ()) END AS target FROM l),
q AS (SELECT rid, doc_id, sid, size, source_size, target, total,
         sum(size) OVER (PARTITION BY sid ORDER BY shuffle, doc_id, rid ROWS UNBOUNDED PRECEDING) AS so_far
      FROM sizes JOIN t ON sizes.source IS NOT DISTINCT FROM t.source WHERE size > 0 AND target > 0),
f AS (SELECT *, (so_far + n * source_size)::DOUBLE / target AS finish FROM q, (VALUES (0), (1)) AS copies(n)),
r AS (SELECT rid, size, total, sum(size) OVER (ORDER BY finish, sid, doc_id, rid, n ROWS UNBOUNDED PRECEDING) AS run FROM f),
k AS (SELECT rid, sum(size)::BIGINT AS taken FROM r WHERE run <= total GROUP BY rid)
SELECT sizes.doc_id, sizes.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM sizes JOIN t ON sizes.source IS NOT DISTINCT FROM t.source LEFT JOIN k ON sizes.rid = k.rid
"""
