"""SentencePiece encoding and decoding of texts of any length.

A document longer than ``GIANT`` characters is cut into chunks of ``CHUNK`` characters at
fixed places. What crosses a cut is the piece that covers the character before it, so
the state at a cut is that piece's reach to either side, and a chunk is a matrix of the
best score from each state at its left cut to each state at its right cut, in the
(max, +) semiring. Matrices of neighbours multiply associatively: they are combined in
groups of ``FAN`` up a tree, the states are chosen on the way down, and then each chunk
is traced back by itself.

Scores: in a unigram model, the pieces' own. A byte-pair model has no score for a
sequence, but its result is the one sequence in which every two neighbouring pieces
encode to themselves, so a step weighs 0 if the two pieces do and -inf if not; the same
scan then finds the library's result exactly. Pieces never hold a space mark behind
another character, so every path passes through the starts of words; between the first
and the last start of a word in a chunk the library's encoding of single words is used,
each distinct word of a slice once, and each distinct text of a slice once, as a mix
has many twice.

Defined results: a null text encodes as an empty one, to no pieces; a text that holds the
space mark U+2581 itself decodes with spaces in its place; repeated rows give repeated
results; an empty table gives an empty result; ``encode`` keeps the columns it is asked to,
whatever their names, but for doc_id and ids, which are its own.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import free_name, written
from .textops import raw, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT, CHUNK, FAN = 32_768, 32_768, 64
HOT_UNITS = 200_000
DECODED = 1 << 18
MARK = "▁"
BAD = -np.inf


class Pieces:
    """One model: the library for single words, and what the scan needs to know."""

    def __init__(self, model: str | bytes) -> None:
        import sentencepiece as sp
        from sentencepiece import sentencepiece_model_pb2 as pb

        data = model if isinstance(model, bytes) else open(model, "rb").read()
        proto = pb.ModelProto()
        proto.ParseFromString(data)
        self.lib = sp.SentencePieceProcessor(model_proto=data)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave the text as it is can be scanned in chunks")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.unigram = proto.trainer_spec.model_type == 1
        kinds = [p.type for p in proto.pieces]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 6 byte
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if kinds[i] in (1, 4)}
        self.score = {p.piece: p.score for p in proto.pieces if p.type in (1, 4)}
        self.unknown_score = min(self.score.values()) - 10.0
        self.unknown = next((i for i, k in enumerate(kinds) if k == 2), 0)
        self.bytes = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 6}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses the start of a word")
        self.most = max(map(len, self.ids))
        self.alone = "\n" not in "".join(self.ids)
        self.units = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if self.alone else f"{MARK}*[^{MARK}]+|{MARK}+")
        text = [p.piece.replace(MARK, " ").encode() if k in (1, 4) else bytes([int(p.piece[3:5], 16)]) if k == 6 else b"" for p, k in zip(proto.pieces, kinds)]
        self.piece_off = np.concatenate([[0], np.cumsum([len(t) for t in text])])
        self.piece_raw = np.frombuffer(b"".join(text), np.uint8)
        self.hot: dict[str, int] = {}  # units met first, up to HOT_UNITS and one slice
        self.hot_size, self.hot_ids = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.sound: dict[tuple[str, str], bool] = {}
        if not self.alone:
            raise ValueError("the scan takes a line feed as a piece by itself")

    def normal(self, text: str) -> str:
        return self.prefix + text.replace(" ", MARK) if text else ""

    def of(self, units: list[str]) -> list[list[int]]:
        """Pieces of single units: what follows a line feed has no prefix."""
        return [x[2:] for x in self.lib.encode(["\n" + u.replace(MARK, " ") for u in units], num_threads=1)] if self.prefix else self.lib.encode([u.replace(MARK, " ") for u in units], num_threads=1)

    def _flat(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of pieces, and all pieces, of units with spaces for space marks, as ``of`` has them."""
        got = self.lib.encode(["\n" + u for u in units] if self.prefix else units, num_threads=1) if units else []
        size = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(itertools.chain.from_iterable(got), np.int32, int(size.sum()))
        if not self.prefix or not len(got):
            return size, ids
        own = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size) >= 2  # not the prefix and the line feed
        return np.maximum(size - 2, 0), ids[own]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces of normal texts that start and end between pieces, and n + 1 offsets."""
        return self._encode(pa.array([t.replace(MARK, " ") for t in texts], pa.string()))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All pieces of texts as they stand in a table, none of them null, and n + 1 offsets; equal texts are encoded once."""
        d = pc.dictionary_encode(texts)
        ids, off = self._encode(self.spaced(d.dictionary))
        if len(d.dictionary) == len(texts):
            return ids, off
        which = d.indices.to_numpy()
        return gather(ids, off, which), np.concatenate([[0], np.cumsum(np.diff(off)[which])])

    def spaced(self, texts: pa.Array) -> pa.Array:
        """Normal texts, but with spaces for space marks."""
        texts = pc.replace_substring(texts, MARK, " ")
        if not self.prefix:
            return texts
        return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(" ", texts, ""))

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        b, off = raw(texts)
        if not len(b):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        at = unit_starts(b, off)
        d = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(b)).astype(np.int32)), pa.py_buffer(b)).dictionary_encode()
        units, hot, base = d.dictionary.to_numpy(zero_copy_only=False), self.hot, len(self.hot)
        codes = np.fromiter(map(hot.get, units, itertools.repeat(-1)), np.int64, len(units))
        fresh = np.flatnonzero(codes < 0)
        codes[fresh] = base + np.arange(len(fresh))
        new = units[fresh].tolist()
        own, got = self._flat(new)
        size, table = np.concatenate([self.hot_size, own]), np.concatenate([self.hot_ids, got])
        if base < HOT_UNITS:
            hot.update(zip(new, codes[fresh].tolist()))
            self.hot_size, self.hot_ids = size, table
        codes = codes[d.indices.to_numpy()]
        return gather(table, np.concatenate([[0], np.cumsum(size)]), codes), np.concatenate([[0], np.cumsum(size[codes])])[np.searchsorted(at, off)]

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.piece_raw, self.piece_off, ids).tobytes()

    def texts(self, ids: np.ndarray, off: np.ndarray) -> pa.Array:
        """The decoded texts of rows of pieces, given n + 1 offsets, without their prefix; bytes that are not UTF-8 become U+FFFD."""
        b = gather(self.piece_raw, self.piece_off, ids)
        ends = np.concatenate([[0], np.cumsum((self.piece_off[1:] - self.piece_off[:-1])[ids])])[off]
        some = np.flatnonzero(ends[1:] > ends[:-1])
        if not self.prefix or (b[ends[some]] == 32).all():
            bare, to = b, ends
            if self.prefix:
                bare, to = np.delete(b, ends[some]), ends - np.searchsorted(some, np.arange(len(ends)))
            out = pa.StringArray.from_buffers(len(off) - 1, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(bare))
            try:
                out.validate(full=True)
                return out
            except pa.ArrowInvalid:
                pass
        return pa.array([b[x:y].tobytes().decode("utf-8", "replace")[len(self.prefix) :] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string())

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes[f"<0x{b:02X}>"] for b in piece.encode()] if self.bytes else [self.unknown]

    def weight(self, before: str | None, piece: str) -> float:
        if self.unigram:
            return self.score.get(piece, self.unknown_score)
        if before is None:
            return 0.0
        key = (before, piece)
        if key not in self.sound:
            if len(self.sound) > 500_000:
                self.sound.clear()
            self.sound[key] = self.of([before + piece])[0] == self.ids_of(before) + self.ids_of(piece)
        return 0.0 if self.sound[key] else BAD

    def starting(self, text: str, at: int) -> list[int]:
        """Ends of the pieces, or the single unknown character, that start at ``at``."""
        ends = [e for e in range(at + 1, min(at + self.most, len(text)) + 1) if text[at:e] in self.ids]
        return ends if ends and ends[0] == at + 1 else [at + 1, *ends]

    def covering(self, text: str, cut: int) -> list[tuple[int, int]]:
        """States at a cut: the pieces (start, end) that cover the character before it."""
        return [(s, e) for s in range(max(0, cut - self.most), cut) for e in self.starting(text, s) if e >= cut]

    def paths(self, text: str, first: tuple[int, int] | None, begin: int, cut: int) -> dict[tuple[int, int], tuple[float, tuple | None]]:
        """Best score and predecessor of each piece from a first state on, up to the pieces that cover ``cut - 1``."""
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        at: dict[int, list[tuple[int, int]]] = {}
        if first is not None and first[0] >= 0:
            best[first] = (0.0, None)
            at[first[1]] = [first]
            begin = first[1]
        for p in range(begin, cut):
            before = at.pop(p, [])
            if not before and p != begin:
                continue
            for e in self.starting(text, p):
                piece, found = text[p:e], (BAD, None)
                for b in before or [None]:
                    w = self.weight(text[b[0] : b[1]] if b else None, piece) + (best[b][0] if b else 0.0)
                    if w > found[0]:
                        found = (w, b)
                if found[0] > BAD:
                    best[(p, e)] = found
                    at.setdefault(e, []).append((p, e))
        return best

    def sync(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """First and last place in low..high where every path has a boundary."""
        places = [m.start() for m in re.finditer(f"(?<=[^{MARK}]){MARK}|\n", text[: high + 1]) if low <= m.start() <= high]
        return (places[0], places[-1]) if places else None


@functools.lru_cache(maxsize=2)
def load(model: str) -> Pieces:
    return Pieces(model)


def gather(values: np.ndarray, off: np.ndarray, which: np.ndarray) -> np.ndarray:
    size = (off[1:] - off[:-1])[which]
    total = np.cumsum(size)
    if not len(total) or not total[-1]:
        return values[:0]
    return values[np.arange(total[-1]) + np.repeat(off[:-1][which] - (total - size), size)]


def unit_starts(b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Places where words with the spaces before them, runs of spaces before a line feed or the end, and line feeds start."""
    space, feed = b == 32, b == 10
    start = feed.copy()
    start[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
    start[off[:-1][off[:-1] < len(b)]] = True
    return np.flatnonzero(start)


class Chunk:
    """A chunk with enough text around it to see its cuts' states; places are relative to ``text``."""

    def __init__(self, model: Pieces, text: str, left: int, right: int, first: bool, last: bool) -> None:
        self.m, self.text, self.left, self.right, self.first, self.last = model, text, left, right, first, last
        self.ins = [(-1, -1)] if first else model.covering(text, left)
        self.outs = [(-1, -1)] if last else model.covering(text, right)
        reach = model.most + 1
        self.sync = model.sync(text, left + reach, right - reach)

    def _to(self, best: dict, place: int) -> tuple[float, tuple | None]:
        ends = [(v[0], k) for k, v in best.items() if k[1] == place]
        return max(ends, default=(BAD, None))

    def _tail(self, begin: int, first: tuple | None, out: tuple) -> tuple[float, list]:
        best = self.m.paths(self.text, first, begin, self.right)
        return self._end(best, out, begin)

    def _end(self, best: dict, out: tuple, begin: int) -> tuple[float, list]:
        score, node = self._to(best, self.right) if out == (-1, -1) else (best.get(out, (BAD, None))[0], out)
        path = []
        while node is not None and score > BAD:
            path.append(node)
            node = best[node][1]
        return score, path[::-1]

    def matrix(self) -> np.ndarray:
        t = np.full((len(self.ins), len(self.outs)), BAD)
        if self.sync:
            p1, p2 = self.sync
            head = np.array([self._to(self.m.paths(self.text, s, self.left, p1), p1)[0] for s in self.ins])
            tail = self.m.paths(self.text, None, p2, self.right)
            middle = sum(self.m.score.get(self.text[a:b], self.m.unknown_score) for a, b in self._middle(p1, p2)) if self.m.unigram else 0.0
            ends = np.array([self._end(tail, o, p2)[0] for o in self.outs])
            return head[:, None] + middle + ends[None, :]
        for i, s in enumerate(self.ins):
            best = self.m.paths(self.text, s, self.left, self.right)
            t[i] = [self._end(best, o, self.left)[0] for o in self.outs]
        return t

    def _middle(self, p1: int, p2: int) -> list[tuple[int, int]]:
        out, at = [], p1
        for u in self.m.units.findall(self.text[p1:p2]):
            best = self.m.paths(u, None, 0, len(u))
            out += [(at + a, at + b) for a, b in self._end_of(best, len(u))]
            at += len(u)
        return out

    def _end_of(self, best: dict, place: int) -> list:
        node, path = self._to(best, place)[1], []
        while node is not None:
            path.append(node)
            node = best[node][1]
        return path[::-1]

    def trace(self, s: tuple[int, int], o: tuple[int, int]) -> np.ndarray:
        """The pieces that start in the chunk, on the best path from state s to state o."""
        def ids(path: list) -> list[int]:
            return [i for a, b in path if (a, b) != s for i in self.m.ids_of(self.text[a:b])]

        if not self.sync:
            return np.array(ids(self._end(self.m.paths(self.text, s, self.left, self.right), o, self.left)[1]), np.int32)
        p1, p2 = self.sync
        head = self._end_of(self.m.paths(self.text, s, self.left, p1), p1)
        middle = self.m.encode([self.text[p1:p2]])[0]
        return np.concatenate([np.array(ids(head), np.int32), middle, np.array(ids(self._tail(p2, None, o)[1]), np.int32)])


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product in the (max, +) semiring."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def choose(matrices: list[np.ndarray], start: int, stop: int) -> list[int]:
    """States at all cuts of a run of matrices, given its first and last."""
    ahead = [None] * len(matrices)
    row = np.full(matrices[0].shape[0], BAD)
    row[start] = 0.0
    for i, t in enumerate(matrices):
        ahead[i] = row
        row = (row[:, None] + t).max(axis=0)
    at, out = stop, [stop]
    for i in range(len(matrices) - 1, 0, -1):
        at = int(np.argmax(ahead[i] + matrices[i][:, at]))
        out.append(at)
    return [start, *out[::-1]]


_KEY = "doc_id long, h long"


def _chunks(giants: DataFrame, model: str, chunk: int) -> DataFrame:
    """Rows (doc_id, h, i, n, text, left, right): a giant's chunks with a margin of text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        margin = 2 * m.most + 2
        for batch in batches:
            for part in slices(batch):
                for d, h, t in zip(*[part.column(c).to_pylist() for c in ("doc_id", "h", "text")]):
                    t = m.normal(t)
                    cuts = [*range(0, len(t), chunk), len(t)]
                    if len(cuts) > 2 and cuts[-1] - cuts[-2] < 4 * margin:
                        cuts.pop(-2)
                    for i in range(len(cuts) - 1):
                        a, b = max(0, cuts[i] - margin), min(len(t), cuts[i + 1] + margin)
                        row = {"doc_id": d, "h": h, "i": i, "n": len(cuts) - 1, "text": t[a:b], "left": cuts[i] - a, "right": cuts[i + 1] - a}
                        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("i", pa.int64()), ("n", pa.int64()), ("text", pa.string()), ("left", pa.int64()), ("right", pa.int64())]))

    return giants.select("doc_id", "h", "text").mapInArrow(run, f"{_KEY}, i long, n long, text string, left long, right long")


def _chunk(m: Pieces, r: dict) -> Chunk:
    return Chunk(m, r["text"], r["left"], r["right"], r["i"] == 0, r["i"] == r["n"] - 1)


def _matrices(chunks: DataFrame, model: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for batch in batches:
            for r in batch.to_pylist():
                t = _chunk(m, r).matrix()
                row = {"doc_id": r["doc_id"], "h": r["h"], "i": r["i"], "n": r["n"], "rows": t.shape[0], "matrix": t.ravel().tolist()}
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("i", pa.int64()), ("n", pa.int64()), ("rows", pa.int64()), ("matrix", pa.list_(pa.float64()))]))

    return chunks.mapInArrow(run, f"{_KEY}, i long, n long, rows long, matrix array<double>")


def _array(r) -> np.ndarray:
    return np.asarray(r.matrix, float).reshape(int(r.rows), -1)


def _combine(level: DataFrame, fan: int) -> DataFrame:
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("i")
        t = functools.reduce(times, [_array(r) for r in g.itertuples()])
        r = g.iloc[0]
        return pd.DataFrame({"doc_id": [r.doc_id], "h": [r.h], "i": [r.i // fan], "n": [-(-r.n // fan)], "rows": [t.shape[0]], "matrix": [t.ravel().tolist()]})

    return level.groupBy("doc_id", "h", F.expr(f"i div {fan}").alias("block")).applyInPandas(run, level.schema)


def _descend(level: DataFrame, above: DataFrame, fan: int) -> DataFrame:
    """First and last states of a level's entries from those of the level above."""
    def run(g: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("i")
        states = choose([_array(r) for r in g.itertuples()], int(up["s"].iloc[0]), int(up["o"].iloc[0]))
        return pd.DataFrame({"doc_id": g["doc_id"], "h": g["h"], "i": g["i"], "s": states[:-1], "o": states[1:]})

    block = F.expr(f"i div {fan}").alias("block")
    return level.groupBy("doc_id", "h", block).cogroup(above.groupBy("doc_id", "h", F.col("i").alias("block"))).applyInPandas(run, f"{_KEY}, i long, s long, o long")


def _traced(chunks: DataFrame, states: DataFrame, model: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for batch in batches:
            for r in batch.to_pylist():
                c = _chunk(m, r)
                ids = c.trace(c.ins[r["s"]], c.outs[r["o"]])
                yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"]], pa.int64()), pa.array([r["h"]], pa.int64()), pa.array([r["i"]], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int32()))], ["doc_id", "h", "i", "ids"])

    return chunks.join(states, ["doc_id", "h", "i"]).mapInArrow(run, f"{_KEY}, i long, ids array<int>")


def encode_giants(giants: DataFrame, model: str = MODEL, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """(doc_id, h, i, ids): the pieces of each chunk of texts with keys doc_id and h (unique, not null)."""
    chunks = written(_chunks(giants, model, chunk), "chunks")
    levels = [written(_matrices(chunks, model), "matrices")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(written(_combine(levels[-1], fan), "matrices"))
        most = -(-most // fan)
    states = levels[-1].select("doc_id", "h", "i", F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("o"))  # a whole text has one state at either end
    for level in levels[-2::-1]:
        states = _descend(level, states, fan)
    return _traced(chunks, written(states, "states"), model)


def encode(documents: DataFrame, model: str = MODEL, giant: int = GIANT, chunk: int = CHUNK, fan: int = FAN, keep: tuple[str, ...] = ("source", "lang"), decoded: str | None = None) -> DataFrame:
    """doc_id, the columns ``keep``, and ids array<int> of every document; with ``decoded``, a column of that name too, of the text that the ids give again.

    Only giants move: the others are encoded, and decoded, where they are read.
    """
    keep = tuple(c for c in dict.fromkeys(keep) if c not in ("doc_id", "ids", decoded))
    kept = ["doc_id", *keep]
    last = [decoded] if decoded else []
    text, h, key = (free_name([*documents.columns, "doc_id", "ids", *last], c) for c in ("_text", "_h", "_key"))
    d = documents.select(*[F.col(f"`{c}`") for c in kept], F.coalesce("text", F.lit("")).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for batch in batches:
            for part in slices(batch, text):
                ids, off = m.encode_column(part.column(text))
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], lists, *[m.texts(ids, off) for _ in last]], [*kept, "ids", *last])

    schema = T.StructType([*[f for f in d.schema if f.name in keep or f.name == "doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), *[T.StructField(c, T.StringType()) for c in last]])
    short = d.where(F.length(text) <= giant).mapInArrow(run, schema)
    long = d.where(F.length(text) > giant).withColumns({h: F.xxhash64(text), key: F.coalesce("doc_id", F.lit(-1))})
    pieces = encode_giants(long.select(F.col(key).alias("doc_id"), F.col(h).alias("h"), F.col(text).alias("text")).dropDuplicates(["doc_id", "h"]), model, chunk, fan)
    # a giant's pieces make one row, as its text does
    whole = pieces.groupBy(F.col("doc_id").alias(key), F.col("h").alias(h)).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("i", "ids"))), lambda x: x["ids"])).alias("ids"))
    giants = long.drop(text).join(whole, [key, h]).select(*[F.col(f"`{c}`") for c in kept], "ids")
    return short.unionByName(decode(giants, model, (*keep, "ids"), decoded) if decoded else giants)


def decode(encoded: DataFrame, model: str = MODEL, keep: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """doc_id, the columns ``keep``, which may be ids too, and ``text`` of rows with ``ids``; bytes that are not UTF-8 become U+FFFD."""
    kept = ["doc_id", *[c for c in dict.fromkeys(keep) if c not in ("doc_id", text)]]
    columns = list(dict.fromkeys([*kept, "ids"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for batch in batches:
            start, n = 0, batch.num_rows
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy())
            while start < n:  # rows of DECODED pieces at a time, or one
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + DECODED, side="right")))
                part = batch.slice(start, stop - start)
                ids = part.column("ids")  # flatten leaves out what a null row may hold
                off = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], m.texts(ids.flatten().to_numpy(), off)], [*kept, text])
                start = stop

    schema = T.StructType([*[encoded.schema[c] for c in kept], T.StructField(text, T.StringType())])
    return encoded.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def digest(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the pieces as little-endian int32) and text_sha256 (of the decoded text)."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        skip = len(m.prefix)
        for batch in batches:
            off = batch.column("ids").offsets.to_numpy()
            ids = batch.column("ids").values.to_numpy()
            n, a, b = [], [], []
            for s, e in zip(off[:-1], off[1:]):
                n.append(e - s)
                a.append(hashlib.sha256(ids[s:e].astype("<i4").tobytes()).hexdigest())
                b.append(hashlib.sha256(m.decode(ids[s:e])[skip:]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "text_sha256"])

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, text_sha256 string")
