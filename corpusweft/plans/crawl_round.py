"""One round of a crawl as a function of tables: edges in, domains and a URL batch out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import SMALL, Config
from ..operators import frontier, stats


@dataclass
class State:
    domains: DataFrame  # scheme, host, distance, status, and counters
    paths: DataFrame  # queue: scheme, host, path, seq
    overflow: DataFrame  # the same columns, beyond a domain's queue
    seen: DataFrame  # scheme, host, path_key


def admit_edges(state: State, edges: DataFrame, batch: int, config: Config = SMALL) -> tuple[State, DataFrame]:
    """(state after a batch of edges, paths of removed domains)."""
    near, _ = frontier.within(frontier.target_distance(edges, state.domains), config)
    domains = frontier.upsert(state.domains, near)
    fresh = frontier.new_paths(edges.join(near.select("scheme", "host"), ["scheme", "host"], "left_semi"), state.seen)
    live = domains.where("change <> 'removed'").select("scheme", "host")
    # arrival order: batch first, then a stable order inside it
    arrived = fresh.join(live, ["scheme", "host"], "left_semi").select("scheme", "host", "path", (F.lit(batch).cast("long") * (1 << 40) + F.abs(F.xxhash64("path")) % (1 << 40)).alias("seq"))
    queue, over = frontier.trim_paths(state.paths.unionByName(arrived), "seq", config)
    dumped = fresh.join(domains.where("change = 'removed'").select("scheme", "host"), ["scheme", "host"], "left_semi")
    return State(domains.drop("change"), queue, state.overflow.unionByName(over), state.seen.unionByName(fresh.select("scheme", "host", "path_key"))), dumped


def evaluate(state: State, counters: DataFrame, config: Config = SMALL) -> State:
    """State after new page counters: counters are added and states of domains decided anew."""
    domains = stats.add_counters(state.domains, counters)
    n = state.paths.groupBy("scheme", "host").agg(F.count(F.lit(1)).alias("n_paths"))
    j = domains.drop("n_paths").join(n, ["scheme", "host"], "left").withColumn("n_paths", F.coalesce("n_paths", F.lit(0)))
    return State(j.withColumn("status", stats.domain_status(config)), state.paths, state.overflow, state.seen)


def select_batch(state: State, config: Config = SMALL) -> tuple[DataFrame, State]:
    """(URL batch, state without it): tiered selection of ready domains, robots files first for new ones."""
    ready = state.domains.where("status = 'ready'")
    chosen = frontier.tiered_selection(state.paths, ready, "seq", config)
    batch, _ = frontier.batch_and_rest(chosen, ["length_tier", "distance_tier", "host", "scheme", "rank"], config.max_selected)
    robots = state.domains.where("status = 'new-robots'").select("scheme", "host", F.lit("/robots.txt").alias("path"), "ip", F.lit(True).alias("is_robots"))
    pages = batch.join(state.domains.select("scheme", "host", "ip"), ["scheme", "host"]).select("scheme", "host", "path", "ip", F.lit(False).alias("is_robots"))
    left = state.paths.join(batch.select("scheme", "host", "path"), ["scheme", "host", "path"], "left_anti")
    queue, over = frontier.refill_paths(left, state.overflow, "seq", config)
    return robots.unionByName(pages), State(state.domains, queue, over, state.seen)
