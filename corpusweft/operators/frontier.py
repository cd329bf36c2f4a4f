"""The link graph and the crawl frontier: distances, upserts, path queues and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..config import SMALL, Config
from ..functions.url import session_stripped
from ..lineage import ensure_checkpoints
from .windows import keep_first

DOMAIN = ["scheme", "host"]


def distances(edges: DataFrame, seeds: DataFrame, most: int = 50) -> DataFrame:
    """(node, distance): hops from the seeds, at most ``most``, by breadth-first waves.

    edges: (src, dst); seeds: (node). Each wave is a join of the last wave alone, less
    all nodes met before; lineage is cut by checkpoint() in the shared folder.
    """
    ensure_checkpoints(edges.sparkSession)
    e = edges.select("src", "dst").where("src is not null and dst is not null and src <> dst").distinct().checkpoint()
    wave = met = seeds.select("node").distinct().withColumn("distance", F.lit(0)).checkpoint()
    for hop in range(1, most + 1):
        reached = wave.join(e, wave["node"] == e["src"]).select(F.col("dst").alias("node")).distinct()
        wave = reached.join(met.select("node"), "node", "left_anti").withColumn("distance", F.lit(hop)).checkpoint()
        if wave.isEmpty():
            break
        met = met.unionByName(wave)  # waves stay as they were written; none is written again
    return met


def target_distance(edges: DataFrame, domains: DataFrame) -> DataFrame:
    """(scheme, host, distance) offered by a batch of edges: the source's distance and one, 0 for seeds or unknown sources + 1."""
    d = domains.select(F.col("scheme").alias("src_scheme"), F.col("host").alias("src_host"), F.col("distance").alias("_d"))
    j = edges.join(d, ["src_scheme", "src_host"], "left")
    offered = F.when(F.col("src_host").isNull(), F.lit(0)).otherwise(F.coalesce("_d", F.lit(0)) + 1)
    return j.groupBy(*DOMAIN).agg(F.min(offered).alias("distance"))


def within(targets: DataFrame, config: Config = SMALL) -> tuple[DataFrame, DataFrame]:
    """(near enough to crawl, too far)."""
    return targets.where(F.col("distance") <= config.max_distance), targets.where(F.col("distance") > config.max_distance)


def upsert(domains: DataFrame, targets: DataFrame) -> DataFrame:
    """Domains after a batch, with ``change``: new, update, wake, removed or null.

    domains: scheme, host, distance, status. New ones start as 'new-ip'.
    """
    t = targets.select(*DOMAIN, F.col("distance").alias("_new"))
    j = domains.join(t, DOMAIN, "full")
    change = (
        F.when(F.col("status").isNull(), F.lit("new"))
        .when(F.col("_new").isNull(), F.lit(None))
        .when(F.col("status") == "sleeping", F.lit("wake"))
        .when(F.col("status") == "bad", F.lit("removed"))
        .otherwise(F.lit("update"))
    )
    status = F.when(F.col("status").isNull(), F.lit("new-ip")).when((F.col("status") == "sleeping") & F.col("_new").isNotNull(), F.lit("ready")).otherwise(F.col("status"))
    return j.withColumn("change", change).withColumns({"distance": F.least("distance", "_new"), "status": status}).drop("_new")


def new_paths(edges: DataFrame, seen: DataFrame) -> DataFrame:
    """(scheme, host, path, path_key): paths not met before, once each session-free key, smallest path first."""
    p = edges.select(*DOMAIN, "path", F.xxhash64(session_stripped(F.col("path"))).alias("path_key"))
    first = keep_first(p, [*DOMAIN, "path_key"], ["path"])
    return first.join(seen, [*DOMAIN, "path_key"], "left_anti")


def trim_paths(paths: DataFrame, order: str = "seq", config: Config = SMALL, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(queue, overflow): a domain with more than max_paths keeps its kept_paths shortest."""
    keys = keys or DOMAIN
    n = F.count(F.lit(1)).over(W.partitionBy(*keys))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.length("path"), order))
    r = paths.withColumns({"_n": n, "_r": rank})
    stays = (F.col("_n") <= config.max_paths) | (F.col("_r") <= config.kept_paths)
    return r.where(stays).drop("_n", "_r"), r.where(~stays).drop("_n", "_r")


def refill_paths(queue: DataFrame, overflow: DataFrame, order: str = "seq", config: Config = SMALL, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(queue, overflow) after domains with fewer than min_paths took from their overflow, oldest first."""
    keys = keys or DOMAIN
    have = queue.groupBy(*keys).agg(F.count(F.lit(1)).alias("_have"))
    o = overflow.join(have, keys, "left").withColumn("_have", F.coalesce("_have", F.lit(0)))
    o = o.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(order)))
    takes = (F.col("_have") < config.min_paths) & (F.col("_r") <= config.kept_paths - F.col("_have"))
    return queue.unionByName(o.where(takes).select(*queue.columns)), o.where(~takes).select(*overflow.columns)


def selection_quota(host: Column, distance: Column, config: Config = SMALL) -> Column:
    """How many paths a domain may give: its share for each tier pair that holds it."""
    lengths = sum([(F.length(host) <= t).cast("int") for t in config.host_length_tiers], F.lit(0))
    near = sum([(distance <= t).cast("int") for t in config.distance_tiers], F.lit(0))
    return lengths * near * config.paths_per_selection


def tiered_selection(paths: DataFrame, domains: DataFrame, order: str = "seq", config: Config = SMALL) -> DataFrame:
    """Selected paths in the order they are sent: tier by tier, each domain's shortest first.

    Columns added: length_tier, distance_tier (the pass that draws the path) and rank.
    """
    j = paths.join(domains.select(*DOMAIN, "distance"), DOMAIN)
    j = j.withColumn("rank", F.row_number().over(W.partitionBy(*DOMAIN).orderBy(F.length("path"), order)))
    j = j.withColumn("_quota", selection_quota(F.col("host"), F.col("distance"), config)).where(F.col("rank") <= F.col("_quota"))
    # a domain skips the tiers below it; its k-th draw falls into the k-th pass that holds it
    first_l = F.size(F.filter(F.array(*[F.lit(t) for t in config.host_length_tiers]), lambda t: t < F.length("host")))
    first_d = F.size(F.filter(F.array(*[F.lit(t) for t in config.distance_tiers]), lambda t: t < F.col("distance")))
    draw = F.floor((F.col("rank") - 1) / config.paths_per_selection)
    each = len(config.distance_tiers) - first_d
    return j.withColumns({"length_tier": (first_l + F.floor(draw / each)).cast("int"), "distance_tier": (first_d + draw % each).cast("int")}).drop("_quota")


def batch_and_rest(selected: DataFrame, order: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """(batch, remainder carried over) of a selection."""
    from .windows import numbered

    n = numbered(selected, order, "_seq")
    return n.where(F.col("_seq") < most).drop("_seq"), n.where(F.col("_seq") >= most).drop("_seq")


def queue_order(queue: DataFrame, seq: str = "seq") -> DataFrame:
    """Robots files first, then pages by arrival."""
    return queue.orderBy(F.desc((F.col("path") == "/robots.txt").cast("int")), seq)


def cap_queue(queue: DataFrame, keys: list[str], order: str = "seq", config: Config = SMALL) -> tuple[DataFrame, DataFrame]:
    """(queue, waiting): a host is admitted while no more than its cap wait, so cap + 1 fit."""
    from .windows import at_most

    return at_most(queue, keys, [order], config.host_queue_cap + 1)


def alive(queue: DataFrame, dead: DataFrame) -> DataFrame:
    return queue.join(dead.select(*DOMAIN).distinct(), DOMAIN, "left_anti")


def rotate_waiting(queue: DataFrame, waiting: DataFrame, dead: DataFrame, order: str = "seq", room: int | None = None, config: Config = SMALL) -> tuple[DataFrame, DataFrame]:
    """(queue, waiting) after a turn: URLs of dead hosts go, and waiting ones move up where their host's share has
    room, oldest first and no more than ``room`` in all; the rest waits on."""
    q, w = alive(queue, dead).withColumn("_late", F.lit(0)), alive(waiting, dead).withColumn("_late", F.lit(1))
    n = F.row_number().over(W.partitionBy(*DOMAIN).orderBy("_late", order))
    r = q.unionByName(w).withColumn("_n", n)
    up = r.where((F.col("_late") == 1) & (F.col("_n") <= config.host_queue_cap + 1)).drop("_late", "_n")
    full = r.where((F.col("_late") == 1) & (F.col("_n") > config.host_queue_cap + 1)).drop("_late", "_n")
    if room is not None:
        up, over = batch_and_rest(up, [order], room)
        full = full.unionByName(over)
    return q.drop("_late").unionByName(up), full


def paths_by_host(paths: DataFrame, order: str = "seq", most: int = 10_000) -> DataFrame:
    """(scheme, host, part, paths): a host's paths in order, in lists of at most ``most`` so that no row grows with a host."""
    r = paths.withColumn("_r", F.row_number().over(W.partitionBy(*DOMAIN).orderBy(order)))
    part = F.floor((F.col("_r") - 1) / most).cast("int").alias("part")
    listed = r.groupBy(*DOMAIN, part).agg(F.sort_array(F.collect_list(F.struct("_r", "path"))).alias("_p"))
    return listed.select(*DOMAIN, "part", F.transform("_p", lambda x: x["path"]).alias("paths"))


def resolve_hosts(domains: DataFrame, table: DataFrame, resolver=None) -> DataFrame:
    """Domains with ip from a table (scheme, host, ip), then from an optional resolver of hosts, else NO_HOST."""
    t = keep_first(table.select(*DOMAIN, "ip"), DOMAIN, ["ip"]).withColumnRenamed("ip", "_ip")
    j = domains.drop("ip").join(t, DOMAIN, "left")
    other = resolver(F.col("host")) if resolver is not None else F.lit(None).cast("string")
    return j.withColumn("ip", F.coalesce("_ip", other, F.lit("NO_HOST"))).drop("_ip")


def twin_distance(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """Hosts with the distance of their twin under the other scheme, 0 without one."""
    twin = domains.select(F.when(F.col("scheme") == "http", "https").otherwise("http").alias("scheme"), "host", F.col("distance").alias("_d"))
    return hosts.join(twin, DOMAIN, "left").withColumn("distance", F.coalesce("_d", F.lit(0))).drop("_d")


def status_counts(domains: DataFrame) -> DataFrame:
    return domains.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
