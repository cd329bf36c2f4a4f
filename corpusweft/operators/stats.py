"""Counters of corpora and of domains, and what is decided from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import SMALL, Config

DOMAIN = ["scheme", "host"]


def totals(docmeta: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Documents, raw bytes, kept documents, clean bytes and tokens; the last three of kept ones only.

    docmeta: html_len, txt_len, token_count, status. Partial sums are made where rows are read.
    """
    one = F.col("status") == "kept"
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return docmeta.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("html_count"), count("html_len").alias("raw_size"), count(F.when(one, 1)).alias("txt_count"),
        count(F.when(one, F.col("txt_len"))).alias("clean_size"), count(F.when(one, F.col("token_count"))).alias("token_count"),
    )


def domain_counters(docmeta: DataFrame, keys: list[str] | None = None, count_all: bool = False) -> DataFrame:
    """Downloaded and cleaned counts and bytes by domain, duplicates included.

    Pages without HTML length aren't downloads unless count_all is set.
    """
    got = F.lit(True) if count_all else F.col("html_len") > 0
    clean = F.col("txt_len") > 0
    total = lambda test, c: F.coalesce(F.sum(F.when(test, c)), F.lit(0)).cast("long")
    primary = F.col("is_primary") if "is_primary" in docmeta.columns else F.lit(True)
    return docmeta.groupBy(*(keys or DOMAIN)).agg(
        total(got, F.lit(1)).alias("count_downloaded"), total(got, F.col("html_len")).alias("bytes_downloaded"),
        total(clean, F.lit(1)).alias("count_cleaned"), total(clean, F.col("txt_len")).alias("bytes_cleaned"),
        total(clean & primary, F.col("txt_len")).alias("bytes_primary"),
    )


def add_counters(domains: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Domains with new counters added; counters of unknown domains are ignored."""
    names = [c for c in new.columns if c not in (keys or DOMAIN)]
    j = domains.join(new.select(*(keys or DOMAIN), *[F.col(c).alias(f"_{c}") for c in names]), keys or DOMAIN, "left")
    return j.withColumns({c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in names}).select(*domains.columns)


def is_efficient(config: Config = SMALL, multilingual: bool = False) -> Column:
    """A domain yields enough text, or hasn't been seen enough to tell."""
    n = F.col("count_downloaded")
    scale = F.log10(n.cast("double")) - 1
    early = (F.col("bytes_downloaded") < config.min_bytes_downloaded) | (n < config.min_docs_downloaded)
    enough = F.col("bytes_cleaned") / F.col("bytes_downloaded") >= config.yield_factor * scale
    if multilingual:
        enough = enough & (F.coalesce(F.try_divide(F.col("bytes_primary"), F.col("bytes_cleaned")), F.lit(0.0)) >= config.primary_factor * scale)
    return early | enough


def domain_status(config: Config = SMALL, multilingual: bool = False) -> Column:
    """Next state of a domain row: bad, new-ip, new-robots, sleeping or ready.

    Columns: ip, robots (null, FILE, EMPTY, FAIL), waited and idle (seconds), n_paths, and counters.
    """
    ignore = F.lit(config.ignore_failed_robots)
    late = F.col("robots").isNull() & (F.col("waited") >= config.robots_wait_seconds)
    failed = (F.col("robots") == "FAIL") | late
    full = F.lit(False) if config.max_docs_cleaned is None else F.col("count_cleaned") >= config.max_docs_cleaned
    return (
        F.when(F.col("ip") == "NO_HOST", F.lit("bad"))
        .when(F.col("ip").isNull(), F.lit("new-ip"))
        .when(F.coalesce(failed, F.lit(False)) & ~ignore, F.lit("bad"))
        .when(F.col("robots").isNull() & ~late, F.lit("new-robots"))
        .when(~is_efficient(config, multilingual) | full, F.lit("bad"))
        .when((F.col("n_paths") < 1) & (F.col("idle") >= config.max_idle_seconds), F.lit("sleeping"))
        .otherwise(F.lit("ready"))
    )


def recent_decay(counts: DataFrame, value: str = "n") -> DataFrame:
    """Counters less their mean, those above it only; the mean is one row."""
    mean = counts.agg(F.avg(value).alias("_mean"))
    return counts.crossJoin(F.broadcast(mean)).where(F.col(value) > F.col("_mean")).withColumn(value, F.col(value) - F.col("_mean")).drop("_mean")


def gap_violations(connections: DataFrame, keys: list[str], time: str, seconds: float) -> DataFrame:
    """Rows that follow the previous one of their key too soon."""
    from pyspark.sql import Window as W

    gap = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time).over(W.partitionBy(*keys).orderBy(time)).cast("timestamp"))
    return connections.withColumn("gap_seconds", gap / 1_000_000).where(F.col("gap_seconds") < seconds)
