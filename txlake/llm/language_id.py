"""Language identification with a bit-sliced Bloom filter of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.batches import mix

UNKNOWN = "und"
BLOCK_BYTES = 1 << 19
FLUSH_GRAMS = 1_000_000
HASHES = 4


# No code point from here on is a letter.
POINTS = 0x34000
_LETTERS = np.empty(0, dtype=bool)


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _LETTERS
    if not len(_LETTERS):
        _LETTERS = np.array([chr(c).isalpha() for c in range(POINTS)] + [False])
    return _LETTERS[np.minimum(points, POINTS)]


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, trigrams, rows): trigrams around every letter, as numbers; the row of each.

    All that is no letter is a space; the ends of a text are spaces too.
    """
    ends = np.cumsum(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, side="right")))
        part = [(text or "").lower() for text in texts.slice(first, last - first).to_pylist()]
        points = np.frombuffer(("\n" + "\n".join(part) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)
        letter = _is_letter(points)
        clean = np.where(letter, points, 32).astype(np.uint64)
        at = np.flatnonzero(letter)
        grams = (clean[at - 1] << np.uint64(42)) | (clean[at] << np.uint64(21)) | clean[at + 1]
        starts = np.cumsum([1] + [len(t) + 1 for t in part])
        yield first, last, grams, np.searchsorted(starts, at, side="right") - 1
        first = last


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): counts of the batches of a task, combined as far as memory is bounded."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)
            yield pa.record_batch({"lang": pa.array([lang] * len(grams)), "gram": grams.astype(np.int64), "n": n})

    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        codes, names = np.asarray(langs.indices), langs.dictionary.to_pylist()
        for first, last, grams, rows in _blocks(batch.column("text")):
            of = codes[first:last][rows]
            for code in np.unique(of):
                part = np.unique(grams[of == code], return_counts=True)
                held.setdefault(names[code], []).append(part)
                size += len(part[0])
        if size > FLUSH_GRAMS:
            yield from merged()
            held, size = {}, 0
    yield from merged()


@dataclass
class LanguageFilter:
    """slots[word, slot]: bit l of word l // 64 is set when a gram of language l hashes to the slot."""

    langs: list[str]
    slots: np.ndarray
    false_positive: np.ndarray

    @staticmethod
    def places(grams: np.ndarray, size: int) -> list[np.ndarray]:
        h = mix(grams)
        step = (h >> np.uint64(32)) | np.uint64(1)
        return [((h + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64) for i in range(HASHES)]

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], bits_per_gram: int = 16) -> LanguageFilter:
        langs = sorted(grams)
        most = max((len(g) for g in grams.values()), default=1)
        size = 1 << max(10, int(np.ceil(np.log2(bits_per_gram * most))))
        slots = np.zeros((max(1, -(-len(langs) // 64)), size), dtype=np.uint64)
        used = np.zeros(len(langs))
        for i, lang in enumerate(langs):
            word, bit = slots[i // 64], np.uint64(1 << (i % 64))
            for place in cls.places(grams[lang], size):
                word[place] |= bit
            used[i] = np.count_nonzero(word & bit) / size
        return cls(langs, slots, used**HASHES)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language whose share of the text's trigrams, less the share that false positives explain, is
        largest; that share. Of equal languages, the alphabetically first."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return names, scores
        size = self.slots.shape[1]
        for first, last, grams, rows in _blocks(texts):
            n = np.bincount(rows, minlength=last - first)
            places = self.places(grams, size)
            share = np.empty((len(self.langs), last - first))
            for word, slots in enumerate(self.slots):
                mask = slots[places[0]]
                for place in places[1:]:
                    mask &= slots[place]
                for bit in range(min(64, len(self.langs) - 64 * word)):
                    lang = 64 * word + bit
                    hits = np.bincount(rows[(mask >> np.uint64(bit)) & np.uint64(1) == 1], minlength=last - first)
                    false = self.false_positive[lang]
                    share[lang] = (hits / np.maximum(n, 1) - false) / (1 - false)
            best = share.argmax(axis=0)
            for i in np.flatnonzero(n):
                names[first + i] = self.langs[best[i]]
                scores[first + i] = min(1.0, max(0.0, share[best[i], i]))
        return names, scores


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", min_share: float = 1e-5) -> LanguageFilter:
    """Learn from all rows whose language and text are not null.

    A trigram belongs to a language when it makes up at least `min_share` of the language's trigrams, at any
    size of the corpus. So a language has at most 1 / min_share of them, which bounds what reaches the driver,
    the filter and its copies on the executors.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    counts = rows.mapInArrow(_partial_counts, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").filter(F.col("n") >= min_share * F.col("total")).select("lang", "gram")
    table = kept.toArrow().combine_chunks()
    langs, grams = np.asarray(table.column("lang").to_pylist(), dtype=object), table.column("gram").to_numpy()
    return LanguageFilter.build({name: grams[langs == name].astype(np.uint64) for name in set(langs.tolist())})


def predict(text: Column, model: LanguageFilter) -> Column:
    """struct<lang: string, score: double>; `und` and 0 for a text that is null, empty or has no letter, and
    for every text when nothing was learned."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def language(texts: pa.Array) -> pa.Array:
        names, scores = model.predict(texts)
        return pa.StructArray.from_arrays([pa.array(names, type=pa.string()), pa.array(scores)], ["lang", "score"])

    return language(text)
