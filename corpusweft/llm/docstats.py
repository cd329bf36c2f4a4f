"""Statistics of documents that the quality rules and the classifier share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .textops import grams, mix, per_row, raw, word_codes, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"'(),-./:;?@[]_`{}~^=+\\")] = True


def duplicate_lines(text: str) -> tuple[int, int]:
    """(lines with a word, those of them equal to an earlier line)."""
    seen: set[str] = set()
    n = again = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            n += 1
            if line in seen:
                again += 1
            else:
                seen.add(line)
    return n, again


def repeated_words(codes: np.ndarray, off: np.ndarray, k: int = 8) -> np.ndarray:
    """By row, the words inside runs of k words that occur twice or more in the row."""
    hashed = mix(codes.astype(np.uint64) + np.uint64(1))
    h, row, at = grams(hashed, off, k)
    cover = np.zeros(len(codes) + 1, np.int32)
    if len(h):
        key = mix(h + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        starts = at[twice]
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + k, -1)
    return per_row(np.cumsum(cover[:-1]) > 0, off)


def _distinct(x: np.ndarray) -> np.ndarray:
    """Distinct numbers, ascending; by sorting, as hashing them one by one takes many times as long."""
    x = np.sort(x)
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    return x[fresh]


def block_variety(codes: np.ndarray, off: np.ndarray, k: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """By row, (distinct words summed over whole blocks of k words, number of such blocks)."""
    n = np.diff(off)
    blocks = n // k
    place = np.arange(len(codes)) - np.repeat(off[:-1], n)
    row = np.repeat(np.arange(len(n)), n)
    whole = place < (blocks * k)[row] if len(codes) else np.zeros(0, bool)
    first = np.concatenate([[0], np.cumsum(blocks)])
    block = (first[row] + place // k)[whole]
    width = int(codes.max()) + 1 if len(codes) else 1
    distinct = _distinct(block * width + codes[whole]) // width
    return np.diff(np.searchsorted(distinct, first)), blocks


def doc_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts for each text; a null or empty text has zeros."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    b, off = raw(texts)
    blank, lead = _BLANK[b], (b & 0xC0) != 0x80
    values, woff = words(texts)
    codes, _ = word_codes(values)
    lengths = pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), np.diff(woff))
    out = {
        "n_bytes": np.diff(off),
        "n_chars": per_row(lead, off),
        "n_words": np.diff(woff),
        "word_chars": per_row(~blank & lead, off),
        "n_symbols": per_row(_SYMBOL[b], off),
        "n_upper": per_row(_UPPER[b], off),
        "n_lower": per_row(_LOWER[b], off),
        "n_digits": per_row(_DIGIT[b], off),
        "n_punct": per_row(_PUNCT[b], off),
        "n_bang": per_row(b == 33, off),
        "n_bar": per_row(b == 124, off),
        "n_stop": per_row((b == 46) | (b == 63), off),
        "n_wide": per_row(b >= 0xC0, off),
    }
    lines = np.array([duplicate_lines(t) for t in texts.to_pylist()], np.int64).reshape(-1, 2)
    out["n_lines"], out["n_dup_lines"] = lines[:, 0], lines[:, 1]
    out["n_repeat_words"] = repeated_words(codes, woff)
    out["variety"], out["n_blocks"] = block_variety(codes.astype(np.int64), woff)
    out["sq_len"] = per_row(lengths * lengths, woff)
    same = np.zeros(len(codes), bool)
    if len(codes) > 1:
        same[1:] = (codes[1:] == codes[:-1]) & (rows[1:] == rows[:-1])
    out["n_echo"] = per_row(same, woff)
    top = np.zeros(len(texts), np.int64)
    if len(codes):
        np.maximum.at(top, rows, lengths)
        pair = _distinct(rows.astype(np.int64) * (int(codes.max()) + 1) + codes)
        out["n_distinct"] = np.bincount(pair // (int(codes.max()) + 1), minlength=len(texts)).astype(np.int64)
    else:
        out["n_distinct"] = np.zeros(len(texts), np.int64)
    out["max_len"] = top
    return out
