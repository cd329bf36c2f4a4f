"""Streaming twins: exact dedup, domain states and politeness with keyed state.

All are keyed by what they count, so state is partitioned and lives in the state store;
timers evict idle keys. Batch twins are in ``operators``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import SMALL, Config
from ..functions.text import content_key
from .politeness import accept_in_order  # noqa: F401 - the batch twin of ``polite``

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def first_by_content(docs: DataFrame, text: str = "text", event_time: str | None = None, horizon: str | None = None) -> DataFrame:
    """Each content once. With an event time and a horizon, older keys are forgotten."""
    keyed = docs.withColumn("content_key", content_key(F.col(text)))
    if event_time and horizon:
        return keyed.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["content_key"])
    return keyed.dropDuplicates(["content_key"])


class Politeness(StatefulProcessor):
    """Accepts a request if the last accepted one of its key lies long enough back."""

    def __init__(self, seconds: float) -> None:
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at double", int(max(self.seconds, 1) * 100_000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        all_rows = pd.concat(list(rows)).sort_values(["at", "id"])
        last = self.last.get()[0] if self.last.exists() else None
        ok = []
        for at in all_rows["at"]:
            take = last is None or at - last >= self.seconds
            ok.append(take)
            if take:
                last = at
        self.last.update((float(last),))
        yield pd.DataFrame({"key": str(key[0]), "id": all_rows["id"], "at": all_rows["at"], "accepted": ok})

    def close(self) -> None:
        pass


def polite(requests: DataFrame, key: str, seconds: float) -> DataFrame:
    """(key, id, at, accepted) of requests with columns id (long) and at (seconds, double)."""
    r = requests.select(F.col(key).cast("string").alias("key"), F.col("id").cast("long").alias("id"), F.col("at").cast("double").alias("at"))
    return r.groupBy("key").transformWithStateInPandas(Politeness(seconds), "key string, id long, at double, accepted boolean", "Append", "ProcessingTime")


class DomainState(StatefulProcessor):
    """new-ip, new-robots, ready, sleeping, bad: the state of one domain from its events.

    Events: kind ('ip', 'robots', 'paths', 'page'), value (string) and size (long, for
    pages: cleaned bytes with size2 downloaded bytes). Emits a row on each change. Events of
    a batch come in any order: addresses count before robots files, these before the rest,
    and a robots verdict that comes batches before its address is kept until then.
    """

    def __init__(self, config: Config) -> None:
        self.c = config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("domain", "status string, paths long, downloaded long, cleaned long, docs long, robots string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        status, paths, got, clean, docs, robots = self.state.get() if self.state.exists() else ("new-ip", 0, 0, 0, 0, None)
        before = status if self.state.exists() else None
        for part in ("ip", "robots", None):  # one batch is held: Spark bounds it
            rows = list(rows)
            for kind, value, size, size2 in (e for batch in rows for e in zip(batch["kind"], batch["value"], batch["size"], batch["size2"])):
                if (kind if kind in ("ip", "robots") else None) != part:
                    continue
                if kind == "ip" and status == "new-ip":
                    status = "bad" if value in (None, "NO_HOST") else "new-robots"
                elif kind == "robots" and robots is None:
                    robots = value or "FAIL"
                elif kind == "paths":
                    paths += int(size)
                    status = "ready" if status == "sleeping" else status
                elif kind == "page":
                    paths, docs = max(0, paths - 1), docs + 1
                    clean, got = clean + int(size), got + int(size2)
                    enough = got >= self.c.min_bytes_downloaded and docs >= self.c.min_docs_downloaded
                    if enough and clean / got < self.c.yield_threshold(docs):
                        status = "bad"
            if part == "robots" and status == "new-robots" and robots is not None:
                status = "ready" if robots in ("FILE", "EMPTY") or self.c.ignore_failed_robots else "bad"
        self.state.update((status, paths, got, clean, docs, robots))
        now = timer_values.getCurrentProcessingTimeInMs()
        wait = self.c.robots_wait_seconds if status == "new-robots" else self.c.max_idle_seconds
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if status != "bad":
            self.handle.registerTimer(now + wait * 1000)
        if status != before:
            yield self._row(key, status, paths)

    def handleExpiredTimer(self, key, timer_values, expired_timer_info) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        status, paths, got, clean, docs, robots = self.state.get()
        new = "bad" if status == "new-robots" and not self.c.ignore_failed_robots else "sleeping" if status == "ready" and paths < 1 else status
        if new != status:
            self.state.update((new, paths, got, clean, docs, robots))
            yield self._row(key, new, paths)

    @staticmethod
    def _row(key, status: str, paths: int) -> pd.DataFrame:
        return pd.DataFrame({"scheme": [key[0]], "host": [key[1]], "status": [status], "paths": [paths]})

    def close(self) -> None:
        pass


def domain_states(events: DataFrame, config: Config = SMALL) -> DataFrame:
    """State changes (scheme, host, status, paths) of events (scheme, host, kind, value, size, size2)."""
    return events.groupBy("scheme", "host").transformWithStateInPandas(DomainState(config), "scheme string, host string, status string, paths long", "Append", "ProcessingTime")


def postponed(pages: DataFrame, queued: int, order: str = "page_id", host: str = "host", config: Config = SMALL) -> tuple[DataFrame, DataFrame]:
    """(pages to process now, pages for later): a host's share falls as the queue grows; nothing is lost."""
    from ..operators.windows import at_most

    return at_most(pages, [host], [order], config.load_cap(queued))


def rounds(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 60, available_now: bool = False):
    """Run ``step`` on each micro-batch, exactly once by batch id if it writes by that id."""
    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{seconds} seconds")).start()


def drain(query) -> None:
    """Graceful end of a streaming query: what has arrived is processed, then it stops."""
    query.processAllAvailable()
    query.stop()
