"""Politeness by host and by address, in one pass over requests in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..config import SMALL, Config


def accept_in_order(requests: DataFrame, key: str, order: list[str], at: str, seconds: float) -> DataFrame:
    """Requests with ``accepted``, greedy by key: one passes if the last that passed lies at least ``seconds`` back.

    ``at`` is a number in the unit of ``seconds``. Rows stream past in order and only the key's last
    time is held, so a hot key needs no more memory than others.
    """
    at_, key_ = len(requests.columns), len(requests.columns) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = object(), None
        for batch in batches:
            ok = []
            for k, t in zip(batch.column(key_).to_pylist(), batch.column(at_).to_pylist()):
                if k != now:
                    now, last = k, None
                take = last is None or t - last >= seconds
                ok.append(take)
                last = t if take else last
            yield pa.RecordBatch.from_arrays([*batch.columns[:at_], pa.array(ok, pa.bool_())], [*batch.schema.names[:at_], "accepted"])

    rows = requests.select("*", F.col(at).alias("_at"), F.col(key).alias("_key")).repartition(key).sortWithinPartitions(key, *order)
    return rows.mapInArrow(run, requests.withColumn("accepted", F.lit(True)).schema)


def polite_connections(requests: DataFrame, order: list[str], at: str = "at", host: str = "host", ip: str = "ip", batch: str | None = None, config: Config = SMALL) -> tuple[DataFrame, DataFrame]:
    """(requests to open now, requests that wait again): host and address both keep their intervals.

    An address opens at most once in each ``batch``, if there is such a column. Hosts are
    counted at their address; robots files keep their place before pages if ``order`` says so.
    """
    n = len(requests.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, hosts, used = object(), None, {}, object()
        for b in batches:
            ok = []
            for address, name, t, turn in zip(*[b.column(n + i).to_pylist() for i in range(4)]):
                if address != now:
                    now, last, hosts, used = address, None, {}, object()
                take = (name not in hosts or t - hosts[name] >= config.host_interval) and (last is None or t - last >= config.ip_interval) and (turn is None or turn != used)
                ok.append(take)
                if take:
                    last = hosts[name] = t
                    used = turn
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(ok, pa.bool_())], [*b.schema.names[:n], "_open"])

    turn = F.col(batch) if batch else F.lit(None).cast("long")
    rows = requests.select("*", F.col(ip).alias("_ip"), F.col(host).alias("_host"), F.col(at).cast("double").alias("_at"), turn.alias("_turn")).repartition(ip).sortWithinPartitions(ip, *order)
    seen = rows.mapInArrow(run, requests.withColumn("_open", F.lit(True)).schema)
    return seen.where("_open").drop("_open"), seen.where("not _open").drop("_open")


def open_slots(open_now: int, pages_waiting: int, config: Config = SMALL) -> int:
    """Connections that may be opened: none while pages pile up, else as many as fit, a turn's at most."""
    if pages_waiting > config.page_queue or open_now + config.open_at_once > config.max_open:
        return 0
    return config.open_at_once


def cold_start(start: int, end: int, steps: int = 10, repeat: int = 10) -> list[int]:
    """Batch sizes of a crawl's first rounds: the first one repeated, then rising evenly to the last."""
    step = max(1, end // steps)
    return [start] * repeat + [int(x) for x in np.arange(start, end, step)] + [end]


def seconds_left(started: float, duration: float, now: float) -> float:
    return max(0.0, duration - (now - started))
