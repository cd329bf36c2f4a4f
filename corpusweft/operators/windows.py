"""Keep-first, caps, batches and file rolling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..lineage import cut


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; partial aggregation on the map side, no window over hot keys."""
    rank = F.struct(*order, *[c for c in df.columns if c not in order])
    return df.groupBy(*keys).agg(F.min(rank).alias("_r")).select(*[F.col(f"_r.{c}") for c in df.columns])


def ranked(df: DataFrame, keys: list[str], order: list[Column | str], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def at_most(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> tuple[DataFrame, DataFrame]:
    """(first n rows by key, the rest); nothing is dropped. The first part's plan cuts groups before the shuffle."""
    r = ranked(df, keys, order, "_n")
    return r.where(F.col("_n") <= n).drop("_n"), r.where(F.col("_n") > n).drop("_n")


def numbered(df: DataFrame, order: list[str], name: str = "seq", weight: Column | None = None) -> DataFrame:
    """A running count, or sum of ``weight`` before each row, in a global order, without one global window.

    Rows are range-partitioned and sums are made in two levels; the table of range
    sums has one row a partition. The ranges are kept as a column, so retries agree.
    """
    w = F.lit(1) if weight is None else weight
    spread = df.withColumn("_w", w).repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    kept = cut(spread)
    before = kept.groupBy("_part").agg(F.sum("_w").alias("_all")).withColumn("_before", F.coalesce(F.sum("_all").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("_w").over(W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return kept.join(F.broadcast(before.select("_part", "_before")), "_part").withColumn(name, (F.col("_before") + inside).cast("long")).drop("_part", "_before", "_w")


def round_robin(df: DataFrame, order: list[str], batch: int, processors: int) -> DataFrame:
    """batch_id and processor of each row: batches of consecutive rows, dealt in turn."""
    n = numbered(df, order, "_seq")
    return n.withColumns({"batch_id": F.floor(F.col("_seq") / batch).cast("long")}).withColumn("processor", (F.col("batch_id") % processors).cast("long")).drop("_seq")


def rolled(df: DataFrame, order: list[str], size: Column, most: int) -> DataFrame:
    """file_no of each row: a new file after ``most`` cumulative bytes."""
    return numbered(df, order, "_bytes", size).withColumn("file_no", F.floor((F.col("_bytes") + size) / most).cast("long")).drop("_bytes")
