"""Pandas and Arrow UDFs that are made when first used, so that modules import without a session."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

SLICE_BYTES = 1 << 20


def vectorised(ddl: str) -> Callable[[Callable], Callable[..., Column]]:
    def wrap(f: Callable) -> Callable[..., Column]:
        made: list = []

        @functools.wraps(f)
        def call(*columns: Column) -> Column:
            if not made:
                made.append(F.pandas_udf(f, ddl))
            return made[0](*columns)

        return call

    return wrap


def typed(f: Callable, kind: type) -> Callable:
    """f with real annotations of one kind, which Arrow UDFs are told apart by."""
    names = f.__code__.co_varnames[: f.__code__.co_argcount]
    f.__annotations__ = dict.fromkeys([*names, "return"], kind)
    return f


def row_bytes(a: pa.Array) -> np.ndarray:
    """Bytes of each row, about: strings by their length, lists and structs by what they hold."""
    if pa.types.is_list(a.type) or pa.types.is_large_list(a.type):
        total = np.concatenate([[0], np.cumsum(row_bytes(a.values) + 8)])
        off = a.offsets.to_numpy()
        return total[off[1:]] - total[off[:-1]]
    if pa.types.is_struct(a.type):
        return sum(map(row_bytes, a.flatten()), np.zeros(len(a), np.int64))
    if pa.types.is_string(a.type) or pa.types.is_binary(a.type) or pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type):
        return pc.fill_null(pc.binary_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.full(len(a), 8)


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` bytes; a larger row comes alone."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def by_slices(f: Callable[..., list], ddl: str) -> Callable[..., Column]:
    """Arrow UDF of f, which takes a list for each column and returns a list of rows.

    f is called with, and its rows are sent back by, runs of at most ``SLICE_BYTES``, so a worker holds Python
    objects of one run only, however many rows a batch has.
    """
    kind = to_arrow_type(DataType.fromDDL(ddl))

    def run(batches: Iterator) -> Iterator[pa.Array]:
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            for a, b in runs(sum(map(row_bytes, columns)), SLICE_BYTES):
                yield pa.array(f(*[c.slice(a, b - a).to_pylist() for c in columns]), kind)
            del batch, columns
            pa.default_memory_pool().release_unused()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}  # what Arrow UDFs are told apart by
    return F.arrow_udf(run, ddl)


def sliced(ddl: str) -> Callable[[Callable[..., list]], Callable[..., Column]]:
    """``by_slices`` as a decorator."""
    def wrap(f: Callable[..., list]) -> Callable[..., Column]:
        made: list = []

        @functools.wraps(f)
        def call(*columns: Column) -> Column:
            if not made:
                made.append(by_slices(f, ddl))
            return made[0](*columns)

        return call

    return wrap
