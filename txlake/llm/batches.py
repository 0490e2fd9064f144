"""Vectorised views of the texts of one Arrow batch, for functions that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from txlake.llm.text import WHITE

# Stands between texts; no UTF-8 text holds this byte.
SEPARATOR = 0xFF
BLOCK_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[*WHITE.encode(), SEPARATOR]] = False
_LOWER_TABLE, _WORD_TABLE = _LOWER.tobytes(), _IS_WORD.tobytes()
# Any odd base is invertible modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = np.empty(0, dtype=np.uint64)
_INVERSES = np.empty(0, dtype=np.uint64)


def text_blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, starts): consecutive rows whose texts together have about `most` bytes, one long text
    having its own block. Each text is followed by a separator; starts has one entry more than rows. Null is empty.
    """
    binary = texts.fill_null("").cast(pa.large_binary())
    _, raw_offsets, raw = binary.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    first, n = 0, len(binary)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        last = min(last, n)
        part = offsets[first : last + 1] - offsets[first]
        starts = part + np.arange(len(part))
        joined = np.full(starts[-1], SEPARATOR, dtype=np.uint8)
        body = np.ones(starts[-1], dtype=bool)
        body[starts[1:] - 1] = False
        joined[body] = data[offsets[first] : offsets[last]]
        yield first, joined, starts
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: each input bit changes each output bit with probability one half."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.full(n, _BASE, dtype=np.uint64))
        _INVERSES = np.cumprod(np.full(n, _INVERSE, dtype=np.uint64))
    return _POWERS[:n], _INVERSES[:n]


def placed_words(
    block: np.ndarray, starts: np.ndarray, fold: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, begin, end) of every word of the block in order, places in bytes; with `fold`, A-Z count as a-z."""
    # The bytes' own translation is much faster than indexing a table with them.
    body = block.tobytes()
    inside = np.frombuffer(body.translate(_WORD_TABLE), bool)
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    begin = np.flatnonzero(inside & ~before)
    if not len(begin):
        none = np.empty(0, dtype=np.int64)
        return np.empty(0, dtype=np.uint64), none, none, none
    # The block ends with a separator, so every word has an end.
    end = np.flatnonzero(~inside & before)
    power, inverse = _powers(len(block))
    total = (np.frombuffer(body.translate(_LOWER_TABLE), np.uint8) if fold else block).astype(np.uint64)
    total += np.uint64(1)
    total *= power
    np.cumsum(total, out=total)
    head = np.where(begin > 0, total[np.maximum(begin, 1) - 1], np.uint64(0))
    hashes = (total[end - 1] - head) * inverse[begin]
    # Words begin before the separator of their row; both ascend.
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(np.searchsorted(begin, starts)))
    return mix(hashes + (end - begin).astype(np.uint64) * _BASE), rows, begin, end


def byte_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes data[begin:end] of each pair, that of `placed_words` for a word."""
    return run_hashes(data.astype(np.uint64) + np.uint64(1), begin, end)


def words(block: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of the block in order; A-Z count as a-z."""
    return placed_words(block, starts)[:2]


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the number of each value's: np.unique by a hash table."""
    # Tasks that do not come here need not hold pandas in memory.
    import pandas as pd

    code, found = pd.factorize(values)
    order = np.argsort(found)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return found[order], rank[code]


def run_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of values[first:last] for each pair, equal for equal runs wherever they stand."""
    power, inverse = _powers(len(values) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(power[: len(values)] * values)])
    return mix((total[last] - total[first]) * inverse[first] + (last - first).astype(np.uint64) * _BASE)
