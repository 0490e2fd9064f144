"""Scores of texts under a hierarchical Pitman-Yor model of words."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm import blocks
from txlake.llm.batches import distinct, text_blocks, words
from txlake.plans.session import workspace

BLOCK_BYTES = 4 << 20
DISCOUNT, STRENGTH = 0.8, 10.0  # of the restaurants of contexts
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 10.0
BURN, THIN, SAMPLES = 8, 2, 3  # sweeps before the first sample, sweeps for each, samples
LIGHT, GRID = 256, 129
# A context with more than this share of all customers is dealt to several buckets; there are no more such contexts
# than 1 / share.
HOT_SHARE = 1 / 64
END = np.uint64(1)  # stands among the hashes of words
BEGIN = 0xFFFFFFFF  # number of the context in front of the first word
ROWS = "kind int, target int, source int, body binary, a bigint, b bigint"
TO_BLOCK, TOTALS, TO_WORDS, SHARED = 0, 1, 2, 3


def _dump(*columns: np.ndarray) -> bytes:
    """Columns of any lengths, compressed."""
    head = np.array([len(columns), *[len(c) for c in columns]], dtype=np.uint32)
    body = head.tobytes() + b"".join(c.tobytes() for c in columns)
    return len(body).to_bytes(4, "little") + pa.Codec("zstd", compression_level=1).compress(body, asbytes=True)


def _parse(body: bytes, types: str) -> list[np.ndarray]:
    raw = pa.decompress(body[4:], int.from_bytes(body[:4], "little"), "zstd").to_pybytes()
    kinds = types.split()
    sizes = np.frombuffer(raw, np.uint32, len(kinds) + 1)[1:].tolist()
    out, at = [], 4 * len(kinds) + 4
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    return out


def _rows(found: list[tuple[int, int, int, bytes]], totals: list[tuple[int, int]] | None = None) -> pa.Table:
    """Packed rows, and rows with two totals of the bucket, numbered in `source`."""
    totals = totals or []
    a, b = ([None] * len(found) + [pair[i] for pair in totals] for i in range(2))
    found = found + [(TOTALS, 0, i, b"") for i in range(len(totals))]
    kind, target, source, body = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [], [])
    return pa.table({
        "kind": pa.array(kind, pa.int32()), "target": pa.array(target, pa.int32()),
        "source": pa.array(source, pa.int32()), "body": pa.array(body, pa.binary()),
        "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
    })


def _steps(samples: np.ndarray) -> list[np.ndarray]:
    """The first sample, and what each later one differs by from it, which compresses to little."""
    first = np.asarray(samples[0], dtype=np.int64)
    return [first, *[np.asarray(s, dtype=np.int64) - first for s in samples[1:]]]


def _unstep(columns: list[np.ndarray]) -> np.ndarray:
    return np.array([columns[0], *[columns[0] + c for c in columns[1:]]])


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0."""
    y = x + 8.0
    low = np.ones_like(y)
    for i in range(8):
        low = low * (x + i)
    inverse = 1 / (y * y)
    tail = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + tail - np.log(low)


@lru_cache(maxsize=4)
def seatings(discount: float) -> np.ndarray:
    """Row n, column t: log of the weight of all seatings of n customers at t tables, a generalised Stirling number, n <= LIGHT."""
    out = np.full((LIGHT + 1, LIGHT + 1), -np.inf)
    out[1, 1] = 0
    tables = np.arange(LIGHT + 1)
    for n in range(1, LIGHT):
        with np.errstate(divide="ignore"):
            join = out[n] + np.log(np.maximum(n - discount * tables, 0))
        out[n + 1, 1:] = np.logaddexp(join[1:], out[n, :-1])
    return out


def _series(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log Stirling number as the sum over j of (-1)^j C(t, j) Gamma(n - d j) / Gamma(-d j), over t! d^t."""
    sizes, of = np.unique(n, return_inverse=True)
    log_choose, j = np.zeros(t.shape), 0
    top = _lgamma(sizes - discount)
    total = np.zeros_like(log_choose)
    while True:
        j += 1
        more = t >= j
        with np.errstate(divide="ignore"):
            log_choose = log_choose + np.log(np.maximum(t - j + 1, 0) / j)
        size = log_choose + (_lgamma(np.maximum(sizes - discount * j, 0.1)) - top)[of] + _lgamma(np.float64(1 + discount * j))
        total += np.where(more, (-1) ** (j + 1) * np.sin(np.pi * discount * j) * np.exp(size), 0)
        if j > 32 and not (more & (size > -45)).any():
            break
    return np.log(np.maximum(total, 1e-300) / np.pi) + top[of] - _lgamma(t + 1.0) - t * np.log(discount)


def _saddle(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log Stirling number, n! / t! times the n-th coefficient of ((1 - (1 - x)^d) / d)^t, at its saddle point."""
    low, high = np.full(t.shape, -41.0), np.full(t.shape, -1e-12)
    for _ in range(60):
        middle = (low + high) / 2
        s = np.exp(middle)
        many = t * -np.expm1(middle) * s ** (discount - 1) * discount > n * -np.expm1(discount * middle)
        low, high = np.where(many, middle, low), np.where(many, high, middle)
    s = np.exp(high)
    r, f = -np.expm1(high), -np.expm1(discount * high) / discount
    mean = r * s ** (discount - 1) / f
    spread = t * (r * r * (1 - discount) * s ** (discount - 2) / f + mean - mean * mean)
    value = _lgamma(n + 1.0) - _lgamma(t + 1.0) + t * np.log(f) - n * np.log(r) - 0.5 * np.log(2 * np.pi * spread)
    return np.where(t == n, 0.0, value)


def log_seatings(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """`seatings` for n > LIGHT, of arrays of one shape: the series where it hardly cancels, the saddle point beyond, where some
    13 / (1 - d) large tables share the customers: its relative error is below 1 in 100, and rises to 1 in 12 where nearly every table has one customer."""
    out = np.empty(t.shape)
    few = t < (13 / (1 - discount)) ** (1 - discount) * n**discount
    for part, way in ((few, _series), (~few, _saddle)):
        if part.any():
            out[part] = way(n[part], t[part], discount)
    return out


def _centre(n: np.ndarray, rate: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """About the mean and deviation of the number of tables of n customers, each table weighing discount * rate."""
    low, high = np.full(n.shape, -41.0), np.full(n.shape, -1e-9)
    for _ in range(16):
        middle = (low + high) / 2
        many = discount * rate * -np.expm1(middle) * np.exp((discount - 1) * middle) > n
        low, high = np.where(many, middle, low), np.where(many, high, middle)
    s, r = np.exp(high), -np.expm1(high)
    f = -np.expm1(discount * high) / discount
    mean = r * s ** (discount - 1) / f
    square = r * r * (1 - discount) * s ** (discount - 2) / f + mean
    tables = np.clip(discount * rate * f, 1, n)
    return tables, np.sqrt(tables * np.maximum(0, 1 - mean * mean / square))


class Dishes:
    """Log weights of the numbers of tables of dishes that have the same numbers to choose from, but for the context's share."""

    def __init__(self, places: np.ndarray, first: np.ndarray, step: np.ndarray, weights: np.ndarray, most: np.ndarray) -> None:
        self.places, self.first, self.step, self.weights, self.most = places, first, step, weights, most
        self.steps = np.arange(weights.shape[1])

    def draw(self, log_share: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        weights = self.weights + (self.first + self.step * self.steps) * log_share[:, None]
        weights = np.exp(weights - weights.max(axis=1, keepdims=True)).cumsum(axis=1)
        at = (weights < (rng.random(len(weights)) * weights[:, -1])[:, None]).sum(axis=1, keepdims=True)
        found = self.first + self.step * at
        wide = self.step > 1
        if wide.any():
            found = found + np.where(wide, rng.integers(0, self.step) - self.step // 2, 0)
        return np.clip(found[:, 0], 1, self.most)


def seat(
    count: np.ndarray, parent: np.ndarray, context: np.ndarray, slices: np.ndarray, discount: float, strength: float, seed: int,
    samples: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """(tables of each dish, tables of each context), one row for each retained sample of a Gibbs chain.

    count customers eat a dish in a restaurant whose parent serves the dish with probability `parent`. The weight of a seating with t tables
    of a dish is the product of its generalised Stirling numbers S(count, t), of parent^t, and of strength (strength + d) ... over all
    T tables of the context. That last factor is d^T Gamma(strength / d + T) up to a constant, so it is split by a variable g of the context: g is drawn from
    Gamma(strength / d + T), and given g the dishes are independent, t with weight S(count, t) (d g parent)^t. Both
    are exact Gibbs steps, of whole dishes at once and in any order. Up to LIGHT customers all t are listed. Beyond,
    GRID numbers around the mean are, one deviation divided into at most eight steps.

    Of a context dealt to several buckets, `slices`, the bucket's share of T stands for the whole when g is drawn.
    """
    rng = np.random.default_rng(seed)
    tables = np.ones(len(count), dtype=np.int64)
    many = np.flatnonzero(count > 1)
    total = np.bincount(context, tables, minlength=len(slices))
    kept = [], []
    if not len(many):
        return np.repeat(tables[None], samples, 0), np.repeat(total[None], samples, 0)
    n, p = count[many].astype(np.int64), parent[many]
    of = context[many]
    log_p = np.log(np.maximum(discount * p, 1e-300))
    singles = np.bincount(context[count <= 1], minlength=len(slices))
    mean, deviation = np.ones(len(n)), np.zeros(len(n))
    open_ = np.ones(len(slices), dtype=bool)
    while (moving := np.flatnonzero(open_[of])).size:
        # Where the chain begins: tables and g at each other's means.
        mean[moving], deviation[moving] = _centre(n[moving], (total * slices + strength / discount)[of[moving]] * p[moving], discount)
        before, total = total, singles + np.bincount(of, mean, minlength=len(slices))
        open_ &= np.abs(total - before) > 1e-3 * total
    classes = []
    size = 2
    while size <= LIGHT:
        places = np.flatnonzero((n <= size) & (n > size // 2 if size > 2 else n > 1))
        if len(places):
            numbers = np.arange(1, size + 1)
            weights = seatings(discount)[n[places], 1 : size + 1] + log_p[places, None] * numbers
            one = np.ones((len(places), 1), dtype=np.int64)
            classes.append(Dishes(places, one, one, weights, n[places]))
        size *= 2
    heavy = np.flatnonzero(n > LIGHT)
    for places in np.split(heavy, np.arange(512, len(heavy), 512)) if len(heavy) else []:
        step = np.maximum(1, np.ceil(deviation[places] / 8)).astype(np.int64)[:, None]
        first = np.maximum(1, np.rint(mean[places]).astype(np.int64)[:, None] - GRID // 2 * step)
        numbers = first + step * np.arange(GRID)
        real = numbers <= n[places, None]
        numbers_ = np.where(real, numbers, 1).astype(np.float64)
        weights = log_seatings(np.repeat(n[places, None], GRID, 1).astype(np.float64), numbers_, discount)
        weights = np.where(real, weights + log_p[places, None] * numbers_, -np.inf)
        classes.append(Dishes(places, first, step, weights, n[places]))
    for sweep in range(BURN + THIN * samples):
        log_share = np.log(np.maximum(rng.gamma(strength / discount + total * slices), 1e-300))
        for dishes in classes:
            tables[many[dishes.places]] = dishes.draw(log_share[of[dishes.places]], rng)
        total = np.bincount(context, tables, minlength=len(slices))
        if sweep >= BURN and (sweep - BURN) % THIN == THIN - 1:
            kept[0].append(tables.copy())
            kept[1].append(total)
    return np.array(kept[0]), np.array(kept[1])


class Tokens:
    """Words and ends of a block's texts: number of each token's word, row, and number of the word before (-1: none)."""

    def __init__(self, table: pa.Table) -> None:
        n = len(table)
        hashes, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for first, block, starts in text_blocks(table.column("text").combine_chunks()):
            found, row = words(block, starts)
            hashes.append(found)
            rows.append(row + first)
        found, row = np.concatenate(hashes), np.concatenate(rows)
        self.n_tokens = np.bincount(row, minlength=n) + 1
        last = np.cumsum(self.n_tokens) - 1
        tokens = np.full(len(found) + n, END, dtype=np.uint64)
        inside = np.ones(len(tokens), dtype=bool)
        inside[last] = False
        tokens[inside] = found
        self.rows = np.repeat(np.arange(n), self.n_tokens)
        self.hashes, self.number = distinct(tokens)
        self.before = np.empty(len(tokens), dtype=np.int64)
        self.before[1:] = self.number[:-1]
        self.before[last[:-1] + 1] = -1
        self.before[:1] = -1
        self.train = np.asarray(table.column("train").to_pylist(), dtype=bool)[self.rows]

    def word_buckets(self, n: int) -> np.ndarray:
        return (self.hashes % np.uint64(n)).astype(np.int64)


def _split(keys: np.ndarray, n: int) -> list[np.ndarray]:
    """Places of the keys of each of n buckets, in order."""
    order = np.argsort(keys, kind="stable")
    return np.split(order, np.searchsorted(keys[order], np.arange(1, n)))


def _bodies(table: pa.Table, kind: int) -> dict[int, bytes]:
    out = {}
    for k, source, body in zip(*(table.column(c).to_pylist() for c in ("kind", "source", "body")), strict=True):
        if k == kind:
            out[source] = body
    return out


def _merge_words(table: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    """Blocks, the places of their words among the bucket's distinct words, hashes, training counts."""
    found = sorted(_bodies(table, TO_WORDS).items())
    parts = [_parse(body, "u8 u4") for _, body in found]
    hashes, at = distinct(np.concatenate([p[0] for p in parts]))
    count = np.bincount(at, np.concatenate([p[1] for p in parts]).astype(np.float64)).astype(np.int64)
    return [b for b, _ in found], np.split(at, np.cumsum([len(p[0]) for p in parts])[:-1]), hashes, count


class Bigrams:
    """The distinct pairs (context, word) of known words in a block, as asked of the buckets of contexts."""

    def __init__(self, tokens: Tokens, count: np.ndarray, ident: np.ndarray, total: int, n: int) -> None:
        d = len(tokens.hashes)
        # The last place is the context in front of a text; as many training texts begin as end.
        ends = int(count[np.flatnonzero(tokens.hashes == END)[0]])
        self.context_count = np.append(count, ends)
        context_id = np.append(ident, BEGIN).astype(np.int64)
        before = np.where(tokens.before < 0, d, tokens.before)
        known = (count[tokens.number] > 0) & (self.context_count[before] > 0)
        self.token_pair = np.full(len(before), -1)
        pairs, at = distinct(before[known] * d + tokens.number[known])
        self.token_pair[known] = at
        self.token_context = before
        self.context, self.word = np.divmod(pairs, d)
        self.train = np.bincount(at, tokens.train[known], minlength=len(pairs)).astype(np.int64)
        slices = 1 + (self.context_count / HOT_SHARE // max(1, total)).astype(np.int64)
        slice_ = (ident[self.word].astype(np.int64) * 0x9E3779B1 >> 7) % slices[self.context]
        self.bucket = ((context_id[self.context] + slice_ * 0x85EBCA6B) * 0xC2B2AE35 >> 5) % n
        # Contexts without a known pair in the block are asked for as well.
        alone = np.setdiff1d(np.unique(before[(self.context_count[before] > 0)]), self.context)
        self.alone = alone
        self.alone_bucket = (context_id[alone] * 0xC2B2AE35 >> 5) % n
        self.context_id, self.slices = context_id, slices
        self.order = [
            part[np.lexsort((ident[self.word[part]], context_id[self.context[part]]))] for part in _split(self.bucket, n)
        ]
        self.alone_order = _split(self.alone_bucket, n)

    def contexts(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Contexts listed for a bucket, with the number of pairs of each."""
        found, first, size = np.unique(self.context_id[self.context[self.order[b]]], return_index=True, return_counts=True)
        mine = self.alone[self.alone_order[b]]
        places = np.concatenate([self.context[self.order[b]][first], mine])
        return places, np.concatenate([size, np.zeros(len(mine), dtype=np.int64)])


def score(
    docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score for every row.

    Tokens are the words of the text, A-Z as a-z, and one end. The model learns from the rows where `train` is true. base_score
    sums log10((c + 0.5) / (N + 0.5 (V + 1))), score the model's log10 probabilities: each word follows the one before
    it, in a restaurant of that context; the restaurants of all contexts share the root restaurant, whose base
    deals V + 1 words alike. n_known counts tokens seen in training.

    Null and empty texts have the end only; every row is a text of its own, whatever its id; a null `train` is false; without any
    training row all words are unknown. Other columns are not read, whatever their names.

    Blocks of texts ask for the counts of their words, then for their pairs of words, then for the root; each distinct word or pair goes once per
    block. Contexts are sampled where their pairs meet, the parent's probabilities held at relative frequencies; the tables of each retained
    sample are then the customers of a root of its own, which is sampled where its words meet. The probability of a token is averaged over the
    samples. Contexts with more than HOT_SHARE of the customers are dealt out by word. What the steps find is written to the checkpoint folder.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    kind = plain.schema["doc_id"].dataType.simpleString()
    dealt, n = blocks.deal(plain, BLOCK_BYTES)

    def kept(rows: DataFrame, name: str) -> DataFrame:
        folder = workspace(spark, f"hpylm-{name}")
        rows.write.option("compression", "zstd").parquet(folder)
        return spark.read.parquet(folder)

    def ask_words(table: pa.Table) -> pa.Table:
        tokens = Tokens(table)
        seen = np.bincount(tokens.number, tokens.train, minlength=len(tokens.hashes)).astype(np.uint32)
        block = int(table.column("block")[0].as_py())
        return _rows([
            (TO_WORDS, b, block, _dump(tokens.hashes[part], seen[part]))
            for b, part in enumerate(_split(tokens.word_buckets(n), n)) if len(part)
        ])

    def count_words(table: pa.Table) -> pa.Table:
        bucket = int(table.column("target")[0].as_py())
        asking, places, hashes, count = _merge_words(table)
        ident = (np.arange(len(hashes)) * n + bucket).astype(np.uint32)
        return _rows([
            (TO_BLOCK, b, bucket, _dump(count[at].astype(np.uint32), ident[at])) for b, at in zip(asking, places, strict=True)
        ], [(int(count.sum()), int(np.count_nonzero(count)))])

    asked = dealt.groupBy("block").applyInArrow(ask_words, ROWS)
    counted = kept(asked.groupBy("target").applyInArrow(count_words, ROWS), "words")

    def sums(rows: DataFrame, size: int) -> list[tuple[int, int]]:
        found = rows.filter(F.col("kind") == TOTALS).groupBy("source").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
        by_source = {r.source: (r.a, r.b) for r in found}
        return [by_source.get(i, (0, 0)) for i in range(size)]

    ((total, vocabulary),) = sums(counted, 1)

    def known_words(tokens: Tokens, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        bodies = _bodies(table, TO_BLOCK)
        count, ident = np.zeros(len(tokens.hashes), np.int64), np.zeros(len(tokens.hashes), np.int64)
        for b, part in enumerate(_split(tokens.word_buckets(n), n)):
            if len(part):
                count[part], ident[part] = _parse(bodies[b], "u4 u4")
        return count, ident

    def ask_pairs(table: pa.Table, counts: pa.Table) -> pa.Table:
        if not len(table):
            return _rows([])
        tokens = Tokens(table)
        count, ident = known_words(tokens, counts)
        pairs = Bigrams(tokens, count, ident, total, n)
        block = int(table.column("block")[0].as_py())
        # Relative frequencies travel as a twentieth of a power of ten.
        rate = np.clip(np.rint(-20 * np.log10(np.maximum(count, 1) / max(1, total))), 0, 255).astype(np.uint8)
        out = []
        for b, part in enumerate(pairs.order):
            context, size = pairs.contexts(b)
            if len(context):
                out.append((TO_WORDS, b, block, _dump(
                    pairs.context_id[context].astype(np.uint32), pairs.slices[context].astype(np.uint8), size.astype(np.uint32),
                    ident[pairs.word[part]].astype(np.uint32), pairs.train[part].astype(np.uint32), rate[pairs.word[part]],
                )))
        return _rows(out)

    def seat_pairs(table: pa.Table) -> pa.Table:
        bucket = int(table.column("target")[0].as_py())
        asking = sorted(_bodies(table, TO_WORDS).items())
        parts = [_parse(body, "u4 u1 u4 u4 u4 u1") for _, body in asking]
        listed = np.concatenate([p[0] for p in parts])
        ids, place = np.unique(listed, return_inverse=True)
        slices = np.ones(len(ids))
        slices[place] = np.concatenate([p[1] for p in parts])
        places = np.split(place, np.cumsum([len(p[0]) for p in parts])[:-1])
        context = np.concatenate([np.repeat(at, p[2]) for at, p in zip(places, parts, strict=True)])
        word = np.concatenate([p[3] for p in parts])
        keys, first, at = np.unique(context.astype(np.uint64) << np.uint64(32) | word, return_index=True, return_inverse=True)
        count = np.bincount(at, np.concatenate([p[4] for p in parts]).astype(np.float64), minlength=len(keys))
        rate = 10.0 ** (-np.concatenate([p[5] for p in parts])[first] / 20.0)
        real = count > 0
        tables, total_tables = np.zeros((SAMPLES, len(keys)), np.int64), np.zeros((SAMPLES, len(ids)))
        if real.any():
            tables[:, real], total_tables = seat(
                count[real], rate[real], context[first][real], slices, DISCOUNT, STRENGTH, bucket, SAMPLES
            )
        ends = np.cumsum([len(p[3]) for p in parts])
        out = []
        for (block, _), mine, entries in zip(asking, places, np.split(at, ends[:-1]), strict=True):
            # A pair that was seen once has one table.
            often = entries[count[entries] > 1]
            out.append((TO_BLOCK, block, bucket, _dump(
                count[entries].astype(np.uint32), *_steps(total_tables[:, mine]), *_steps(tables[:, often]),
            )))
        words_, at_word = np.unique(word[first][real], return_inverse=True)
        guests = np.array([np.bincount(at_word, t, minlength=len(words_)) for t in tables[:, real]])
        for b, part in enumerate(_split(words_.astype(np.int64) % n, n)):
            if len(part):
                out.append((TO_WORDS, b, bucket, _dump(words_[part], *_steps(guests[:, part]))))
        shared = np.flatnonzero(slices > 1)
        out += [(SHARED, 0, int(ids[i].astype(np.int32)), total_tables[:, i].astype(np.float64).tobytes()) for i in shared]
        return _rows(out)

    questions = dealt.groupBy("block").cogroup(
        counted.filter(F.col("kind") == TO_BLOCK).withColumn("block", F.col("target")).groupBy("block")
    ).applyInArrow(ask_pairs, ROWS)
    seated = kept(questions.groupBy("target").applyInArrow(seat_pairs, ROWS), "pairs")
    # Contexts dealt to several buckets: not more than 1 / HOT_SHARE of them, each in few more parts.
    hot: dict[int, np.ndarray] = {}
    for row in seated.filter(F.col("kind") == SHARED).select("source", "body").collect():
        ident = row.source & 0xFFFFFFFF
        hot[ident] = hot.get(ident, 0.0) + np.frombuffer(row.body)

    def seat_root(table: pa.Table, guests: pa.Table) -> pa.Table:
        if not len(table):
            return _rows([])
        bucket = int(table.column("target")[0].as_py())
        asking, places, hashes, _ = _merge_words(table)
        customers = np.zeros((SAMPLES, len(hashes)), np.int64)
        for body in _bodies(guests, TO_WORDS).values():
            ident, *more = _parse(body, "u4" + " i8" * SAMPLES)
            for mine, part in zip(customers, _unstep(more), strict=True):
                np.add.at(mine, ident.astype(np.int64) // n, part)
        real = np.flatnonzero(customers[0])
        tables = np.zeros_like(customers)
        base, zeros = np.full(len(real), 1 / (vocabulary + 1)), np.zeros(len(real), dtype=np.int64)
        for i in range(SAMPLES if len(real) else 0):
            tables[i, real] = seat(
                customers[i, real], base, zeros, np.array([float(n)]), ROOT_DISCOUNT, ROOT_STRENGTH, SAMPLES * bucket + i
            )[0][0]
        totals = [(int(c.sum()), int(t.sum())) for c, t in zip(customers, tables, strict=True)]
        return _rows([
            (TO_BLOCK, b, bucket, _dump(*_steps(customers[:, at]), *_steps(tables[:, at]))) for b, at in zip(asking, places, strict=True)
        ], totals)

    to_root = seated.filter(F.col("kind") == TO_WORDS)
    root = kept(asked.groupBy("target").cogroup(to_root.groupBy("target")).applyInArrow(seat_root, ROWS), "root")
    root_sums = sums(root, SAMPLES)

    def evaluate(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([
            table.schema.field("doc_id"), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
        ])
        if not len(table):
            return schema.empty_table()
        step = answers.column("step").to_numpy()
        of = [answers.filter(pa.array(step == i)) for i in range(3)]
        tokens = Tokens(table)
        count, ident = known_words(tokens, of[0])
        pairs = Bigrams(tokens, count, ident, total, n)
        bodies = _bodies(of[1], TO_BLOCK)
        tables = np.zeros((SAMPLES, len(pairs.context_count)))
        pair_count, pair_tables = np.zeros(len(pairs.word)), np.zeros((SAMPLES, len(pairs.word)))
        for b, part in enumerate(pairs.order):
            context, _ = pairs.contexts(b)
            if len(context):
                pair_count[part], *more = _parse(bodies[b], "u4" + " i8" * 2 * SAMPLES)
                tables[:, context] = _unstep(more[:SAMPLES])
                pair_tables[:, part] = pair_count[part] > 0
                pair_tables[:, part[pair_count[part] > 1]] = _unstep(more[SAMPLES:])
        for i in np.flatnonzero(pairs.slices > 1):
            tables[:, i] = hot.get(int(pairs.context_id[i]), 0.0)
        bodies = _bodies(of[2], TO_BLOCK)
        customers, root_tables = np.zeros((2, SAMPLES, len(tokens.hashes)))
        for b, part in enumerate(_split(tokens.word_buckets(n), n)):
            if len(part):
                more = _parse(bodies[b], "i8" + " i8" * (2 * SAMPLES - 1))
                customers[:, part], root_tables[:, part] = _unstep(more[:SAMPLES]), _unstep(more[SAMPLES:])
        context, entry = pairs.token_context, pairs.token_pair
        has, guests = entry >= 0, pairs.context_count[pairs.token_context]
        chance = np.zeros(len(entry))
        for i, (all_customers, all_tables) in enumerate(root_sums):
            # The predictive probability under one sample of all restaurants.
            open_ = (ROOT_STRENGTH + ROOT_DISCOUNT * all_tables) / (vocabulary + 1)
            in_root = ((customers[i] - ROOT_DISCOUNT * root_tables[i] + open_) / (ROOT_STRENGTH + all_customers))[tokens.number]
            mine = np.zeros(len(entry))
            mine[has] = np.maximum(pair_count[entry[has]] - DISCOUNT * pair_tables[i][entry[has]], 0)
            back = (STRENGTH + DISCOUNT * tables[i][context]) / (STRENGTH + guests)
            chance += np.where(guests > 0, mine / (STRENGTH + guests) + back * in_root, in_root) / SAMPLES
        base = np.log10((count + 0.5) / (total + 0.5 * (vocabulary + 1)))
        rows = len(table)

        def add(values: np.ndarray) -> np.ndarray:
            return np.bincount(tokens.rows, values, minlength=rows)

        return pa.table({
            "doc_id": table.column("doc_id"), "train": table.column("train"), "n_tokens": tokens.n_tokens.astype(np.int64),
            "n_known": add(count[tokens.number] > 0).astype(np.int64), "train_tokens": np.full(rows, total, np.int64),
            "base_score": add(base[tokens.number]), "score": add(np.log10(chance)),
        }, schema=schema)

    steps = None
    for i, rows in enumerate((counted, seated, root)):
        part = rows.filter(F.col("kind") == TO_BLOCK).select(F.lit(i).alias("step"), "kind", F.col("target").alias("block"), "source", "body")
        steps = part if steps is None else steps.union(part)
    return dealt.groupBy("block").cogroup(steps.groupBy("block")).applyInArrow(
        evaluate,
        f"doc_id {kind}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )


def perplexity(scores: DataFrame) -> DataFrame:
    """(train, perplexity) over all tokens."""
    return scores.groupBy("train").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))
