"""Maximal periodic runs of words, found by the branching-tandem test on an enhanced suffix array.

The suffixes of all texts of a block are sorted by prefix doubling, with the text's number as part of each word, so
that no two texts share an interval. Every boundary between neighbouring suffixes splits the LCP interval whose least
value it holds in two. A square with a root of `depth` words that the next word does not continue is a pair of suffixes, `depth` apart,
which are parted by a boundary of exactly that value; so each suffix of the smaller part asks the inverse array whether
the suffix `depth` further or before stands in the other part. Each suffix is in the smaller part of a logarithmic
number of intervals. Squares found are rotated to the left as far as the text allows, which gives their runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.llm.batches import distinct, placed_words, text_blocks
from txlake.llm.vocabulary import gather

LEAST_WORDS = 12
FOUND = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
# Suffixes of smaller parts that are looked up at a time.
STEP = 1 << 20


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffixes in order, ranks by the first 1, 2, 4 ... symbols); only suffixes that are still equal are sorted on."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    ahead = symbols[order]
    new = np.concatenate([[True], ahead[1:] != ahead[:-1]])
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int32)
    levels = []
    width = 1
    while True:
        begins = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank = rank.copy()
        rank[order[slots]] = begins
        levels.append(rank)
        # A slot stays when it has a neighbour of its group.
        alone = new & np.concatenate([new[1:], [True]])
        slots = slots[~alone]
        if not len(slots):
            return order, levels
        at = order[slots]
        after = np.where(at + width < n, rank[np.minimum(at + width, n - 1)].astype(np.int64) + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + after
        by = np.argsort(key, kind="stable")
        order[slots] = at[by]
        key = key[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        width *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """For each boundary b, the number of symbols that suffixes b - 1 and b share; 0 at b = 0 and b = n."""
    n = len(order)
    shared = np.zeros(n + 1, dtype=np.int32)
    first = levels[0]
    b = 1 + np.flatnonzero(first[order[1:]] == first[order[:-1]])
    left, right = order[b - 1].astype(np.int64), order[b].astype(np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        inside = (left < n) & (right < n)
        same = inside & (rank[np.minimum(left, n - 1)] == rank[np.minimum(right, n - 1)])
        left[same] += 1 << level
        right[same] += 1 << level
    shared[b] = left - order[b - 1]
    return shared


def _nearest_below(shared: np.ndarray, at: np.ndarray, step: int, strict: bool) -> np.ndarray:
    """For each boundary of `at`, the next one in the direction of `step` with a value that is smaller (or equal, if
    not strict). Boundaries pass on what lies beyond the ones they have left behind."""
    nearest = np.arange(len(shared), dtype=np.int64) + step
    open_ = at
    while len(open_):
        value, found = shared[open_], shared[nearest[open_]]
        goes_on = found >= value if strict else found > value
        open_ = open_[goes_on]
        nearest[open_] = nearest[nearest[open_]]
    return nearest[at]


def branching_squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length of the root) of every square whose root the text does not go on repeating by a word more."""
    n = len(symbols)
    none = np.empty(0, dtype=np.int64)
    if n < 2:
        return none, none
    order, levels = suffix_array(symbols)
    shared = common_prefixes(order, levels)
    place = levels[-1]
    b = np.flatnonzero(shared)
    low = _nearest_below(shared, b, -1, strict=True)
    high = _nearest_below(shared, b, 1, strict=False) - 1
    starts, roots = [none], [none]
    # Suffixes low .. b-1 are the left part, b .. high the right one.
    smaller_left = b - low <= high - b + 1
    size = np.where(smaller_left, b - low, high - b + 1)
    begin = np.where(smaller_left, low, b)
    ends = np.cumsum(size)
    edge = 0
    while edge < len(b):
        done = ends[edge - 1] if edge else 0
        last = max(edge + 1, int(np.searchsorted(ends, done + STEP, side="right")))
        part = slice(edge, last)
        which = np.repeat(np.arange(edge, last), size[part])
        suffix = gather(order, begin[part], size[part]).astype(np.int64)
        depth = shared[b[which]].astype(np.int64)
        left = smaller_left[which]
        other_low, other_high = np.where(left, b[which], low[which]), np.where(left, high[which], b[which] - 1)
        for partner in (suffix + depth, suffix - depth):
            there = place[np.clip(partner, 0, n - 1)]
            hit = (partner >= 0) & (partner < n) & (there >= other_low) & (there <= other_high)
            starts.append(np.minimum(suffix, partner)[hit])
            roots.append(depth[hit])
        edge = last
    return np.concatenate(starts), np.concatenate(roots)


def _rotated(symbols: np.ndarray, start: int, root: int) -> int:
    """The first place from which on the text has the period up to the square."""
    step = 64
    while start:
        a = max(0, start - step)
        differs = np.flatnonzero(symbols[a:start] != symbols[a + root : start + root])
        if len(differs):
            return a + int(differs[-1]) + 1
        start, step = a, step * 2
    return 0


def runs(symbols: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of at least `least` symbols and two periods, in order.

    `symbols` has a number for each word; words of different texts have different numbers.
    """
    start, root = branching_squares(symbols)
    end = start + 2 * root
    short = 2 * root < least
    # A run with a short period has to reach back further than its last square.
    far = np.maximum(end - least, 0)
    ok = ~short | (end >= least)
    for back in range(least):
        i = far + back
        test = ok & short & (i + root < end)
        ok[test] &= symbols[i[test]] == symbols[i[test] + root[test]]
    start, root, end = start[ok], root[ok], end[ok]
    by = np.lexsort((root, end))
    start, root, end = start[by], root[by], end[by]
    found = []
    edges = np.concatenate([[0], 1 + np.flatnonzero(end[1:] != end[:-1]), [len(end)]]) if len(end) else np.zeros(1, dtype=np.int64)
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        left_start, left_root = start[a:z], root[a:z]
        while len(left_root):
            # The smallest root is primitive; squares of its multiples within its run are the same run.
            q, stop = int(left_root[0]), int(end[a])
            first = _rotated(symbols, int(left_start[0]), q)
            found.append((first, stop - first, q))
            other = (left_root % q != 0) | (2 * left_root > stop - first)
            left_start, left_root = left_start[other], left_root[other]
    return sorted(r for r in found if r[1] >= max(least, 2 * r[2]))


def _found(texts: pa.Array, least: int) -> pa.Array:
    n_words, all_runs, collapsed = [], [], []
    for _, block, starts in text_blocks(texts):
        hashes, rows, begin, end = placed_words(block, starts, fold=False)
        kinds, number = distinct(hashes)
        symbols = rows * max(1, len(kinds)) + number
        n_rows = len(starts) - 1
        edge = np.searchsorted(rows, np.arange(n_rows + 1))
        of_row = [[] for _ in range(n_rows)]
        covered = np.zeros(len(rows) + 1, dtype=np.int64)
        for first, length, period in runs(symbols, least):
            row = int(rows[first])
            of_row[row].append({"start": first - int(edge[row]), "length": length, "period": period})
            covered[first + period] += 1
            covered[first + length] -= 1
        kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
        size = end[kept] - begin[kept] + 1
        body = gather(block, begin[kept], size)
        places = np.concatenate([[0], np.cumsum(size)])
        body[places[1:] - 1] = 32
        joined = body.tobytes()
        bounds = places[np.searchsorted(rows[kept], np.arange(n_rows + 1))].tolist()
        n_words += np.diff(edge).tolist()
        all_runs += of_row
        collapsed += [joined[a : max(a, z - 1)].decode() for a, z in zip(bounds[:-1], bounds[1:], strict=True)]
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(all_runs, run), pa.array(collapsed, pa.string())], ["n_words", "runs", "collapsed"]
    )


def find_runs(text: Column, least: int = LEAST_WORDS) -> Column:
    """struct<n_words, runs: array<struct<start, length, period>>, collapsed>; words are `[^\\x20\\x09-\\x0D]+`, numbered from 0.

    A run is a stretch of consecutive words, at least `least` and two of its smallest period long, which no neighbouring
    word extends; runs come by start, then period. `collapsed` are the words that no run holds after its
    first period, joined by one space. Null, empty and blank texts have no words, no runs and an empty `collapsed`. Words are equal when
    their 64-bit hashes are. Each row is judged on its own, so repeated rows and ids do not matter, an empty
    table gives none, and no column names are reserved. A text is held by one task: some 80 bytes a word, and four more
    each time its longest repeat doubles.
    """

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        return _found(texts, least)

    return found(text)
