"""Character n-grams as integers: one Arrow pass over texts, for n up to 3.

A character is 21 bits, so an n-gram is one 64-bit integer. Work goes by slices of texts of
bounded size; a text longer than that comes alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SLICE_CHARS = 1 << 20
#: a model of more grams stays a table that texts' grams are joined with
MODEL_ROWS = 2_000_000
_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")
_MICRO = Decimal("0.000001")


def padded(text: str | None, n: int) -> str:
    """White space collapsed, two blanks before and one after (unigrams: one after); empty texts stay empty."""
    flat = _BLANKS.sub(" ", text or "").strip(" ")
    return ("  " if n > 1 else "") + flat + " " if flat else ""


def coded(texts: list[str | None], n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all texts as integers, and the offsets of each text's."""
    full = [padded(t, n) for t in texts]
    size = np.array([len(t) for t in full], np.int64)
    chars = np.frombuffer("".join(full).encode("utf-32-le"), "<u4").astype(np.int64)
    off = np.concatenate([[0], np.cumsum(np.maximum(size - n + 1, 0))])
    if not len(chars):
        return chars, off
    code, starts = np.zeros(len(chars), np.int64), np.ones(len(chars), bool)
    for j in range(n):
        code = (code << 21) | np.concatenate([chars[j:], np.zeros(j, np.int64)])
    ends = np.cumsum(size)[size > 0]
    for j in range(1, n):
        starts[np.maximum(ends - j, 0)] = False  # a text that isn't empty has at least n characters
    return code[starts], off


def named(codes: np.ndarray, n: int = 3) -> list[str]:
    parts = np.stack([(codes >> (21 * (n - 1 - j))) & 0x1FFFFF for j in range(n)], axis=1).astype("<u4")
    s = parts.tobytes().decode("utf-32-le")
    return [s[i : i + n] for i in range(0, len(s), n)]


def slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    ends, a = np.cumsum(lengths), 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_CHARS, side="right")))
        yield a, b
        a = b


def _lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def partial_counts(texts: DataFrame, lang: str, text: str, n: int) -> DataFrame:
    """(lang, gram, n) of each slice, to be added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(_lengths(batch.column(1))):
                langs, values = batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist()
                for name in dict.fromkeys(langs):
                    codes, counts = np.unique(coded([t for k, t in zip(langs, values) if k == name], n)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(named(codes, n), pa.string()), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])

    return texts.select(F.col(lang).cast("string"), F.col(text).cast("string")).mapInArrow(run, "lang string, gram string, n long")


class GramModel:
    """Models of some languages as one sorted array of grams with a row of counts each."""

    def __init__(self, langs: list[str], grams: list[str], counts: list[int], n: int = 3) -> None:
        self.n, self.names = n, sorted(set(langs))
        place = {x: i for i, x in enumerate(self.names)}
        width = [len(g) == n for g in grams]
        s = "".join(g for g, ok in zip(grams, width) if ok)
        code = np.zeros(sum(width), np.int64)
        for column in np.frombuffer(s.encode("utf-32-le"), "<u4").reshape(-1, n).T.astype(np.int64):
            code = (code << 21) | column
        self.codes, row = np.unique(code, return_inverse=True)
        self.counts = np.zeros((len(self.codes), len(self.names)), np.int64)
        at = np.array([place[x] for x in langs], np.int64)
        np.add.at(self.counts, (row, at[np.array(width, bool)]), np.array(counts, np.int64)[np.array(width, bool)])
        squares = np.zeros(len(self.names), np.int64)
        np.add.at(squares, at, np.array(counts, np.int64) ** 2)
        self.norms = np.sqrt(squares.astype(float))

    def differences(self, codes: np.ndarray) -> np.ndarray:
        """1 - cosine of one text's grams with each language; 1 if they share none."""
        own, times = np.unique(codes, return_counts=True)
        if not len(own) or not len(self.codes):
            return np.ones(len(self.names))
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        hit = self.codes[at] == own
        dot = times[hit] @ self.counts[at[hit]]
        return 1 - dot / (np.sqrt(float((times * times).sum())) * self.norms)

    def nearest(self, codes: np.ndarray) -> tuple[str | None, float | None]:
        """The nearest language below difference 1, ties by name, and its difference to 6 digits."""
        best = min(((rounded(d), name) for d, name in zip(self.differences(codes).tolist(), self.names) if d < 1), default=None)
        return (None, None) if best is None or best[0] >= 1 else (best[1], best[0])


def rounded(x: float) -> float:
    """To 6 digits, half up, as SQL does."""
    return float(Decimal(repr(x)).quantize(_MICRO, ROUND_HALF_UP))


def small_model(models: DataFrame, lang: str = "lang", n: int = 3, most: int = MODEL_ROWS) -> GramModel | None:
    """A table (lang, gram, n) as arrays, if it has at most ``most`` rows."""
    t = models.where(F.col(lang).isNotNull()).select(lang, "gram", "n").limit(most + 1).toArrow()
    if t.num_rows > most or n > 3:
        return None
    return GramModel(*[t.column(i).to_pylist() for i in range(3)], n)
