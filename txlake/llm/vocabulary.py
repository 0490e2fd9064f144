"""The distinct words of blocks of documents, each encoded once for the whole corpus."""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from txlake.llm import blocks
from txlake.llm.batches import byte_hashes, distinct

# Words are hashed so many at a time, since a byte takes some 50 meanwhile.
READ_WORDS = 1 << 14

_PUNCTUATION, _DIGITS, _ALPHA = np.zeros((3, 256), dtype=bool)
_PUNCTUATION[[*string.punctuation.encode()]] = True
_DIGITS[[*string.digits.encode()]] = True
_ALPHA[[*string.ascii_letters.encode()]] = True


@dataclass
class BlockWords:
    """Words of the texts of a block: the hashes of the distinct ones in order, and for each occurrence its row and
    the number of its word; the distinct words, with A-Z as a-z if they count as equal, and where each stands in `data`."""

    rows: np.ndarray
    number: np.ndarray
    hashes: np.ndarray
    known: pa.LargeBinaryArray
    data: np.ndarray
    begin: np.ndarray
    length: np.ndarray

    @classmethod
    def read(cls, texts: pa.ChunkedArray, fold: bool) -> BlockWords:
        whole = texts.cast(pa.large_string()).combine_chunks().fill_null("")
        words = pc.ascii_split_whitespace(pc.ascii_lower(whole) if fold else whole)
        rows = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
        coded = words.flatten().dictionary_encode()
        code, known = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary())
        data, ends = _bytes(known)
        hashes = np.empty(len(known), dtype=np.uint64)
        for i in range(0, len(known), READ_WORDS):
            part = ends[i : i + READ_WORDS + 1]
            hashes[i : i + READ_WORDS] = byte_hashes(data[part[0] : part[-1]], part[:-1] - part[0], part[1:] - part[0])
        order = np.argsort(hashes)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        number = rank[code]
        # White space at the ends of a text stands beside an empty word.
        if len(empty := np.flatnonzero(ends[1:] == ends[:-1])):
            stay = code != empty[0]
            rows, number = rows[stay], number[stay]
            number -= number > rank[empty[0]]
            order = order[order != empty[0]]
        known = known.take(pa.array(order))
        data, ends = _bytes(known)
        return cls(rows, number, hashes[order], known, data, ends[:-1], np.diff(ends))

    def spelled(self, words: np.ndarray) -> bytes:
        """The words, by number, between spaces."""
        return spell(self.known.take(pa.array(words)), np.array([0, len(words)]))[0].as_py()

    def buckets(self, n: int) -> np.ndarray:
        """A bucket for each word, the same for words that differ in the ASCII punctuation at their ends only."""
        left = before_tails(self.data, self.begin, self.length)
        some = np.flatnonzero((left > 0) & (left < self.length))
        key = self.hashes.copy()
        for part in np.split(some, range(READ_WORDS, len(some), READ_WORDS)):
            end = np.cumsum(left[part])
            key[part] = byte_hashes(gather(self.data, self.begin[part], left[part]), end - left[part], end)
        return (key % np.uint64(n)).astype(np.int64)

    def postings(self, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word number, row, count), by word and row."""
        return counted_pairs(self.number, self.rows, n_rows)


def _bytes(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words one behind the other, and the first byte of each word with the end of the last."""
    if not len(words):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(data, np.uint8)[: ends[-1]] if data is not None else np.empty(0, np.uint8), ends


def counted_pairs(first: np.ndarray, second: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, count) of the distinct pairs in order; `most` is above all second numbers. Shifts are much faster than divisions."""
    bits = int(most).bit_length()
    pairs = np.sort(first << bits | second)
    new = np.empty(len(pairs), dtype=bool)
    new[:1], new[1:] = True, pairs[1:] != pairs[:-1]
    at = np.flatnonzero(new)
    pairs = pairs[at]
    return pairs >> bits, pairs & ((1 << bits) - 1), np.diff(at, append=len(new))


def spell(words: pa.LargeBinaryArray, edges: np.ndarray) -> pa.LargeBinaryArray:
    """The words between two neighbouring edges, with spaces between them."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), words), pa.scalar(b" ", pa.large_binary()))


def before_tails(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Lengths of the words without the ASCII punctuation at their ends."""
    left = length.copy()
    some = np.arange(len(left))
    while len(some := some[(left[some] > 0) & _PUNCTUATION[data[begin[some] + left[some] - 1]]]):
        left[some] -= 1
    return left


def cut_tails(words: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Two numbers of parts for each word, the distinct parts, the last of them empty, and which have letters of Latin-1 only. A word is
    cut after its last letter or digit, if ASCII punctuation follows; where some other character stands before that, it is whole."""
    if not words:
        return np.empty((0, 2), dtype=np.int64), [""], np.zeros(1, dtype=bool)
    data = np.frombuffer(f"{' '.join(words)} ".encode(), np.uint8)
    end = np.flatnonzero(data == 32)
    begin = np.concatenate([[0], end[:-1] + 1])
    left = before_tails(data, begin, end - begin)
    # Letters beyond those of ASCII and Latin-1 may change when they are folded, or be others in a tokenizer's version of Unicode.
    last = np.maximum(begin + left - 1, 0)
    middle = np.where((left > 0) & ((_DIGITS | _ALPHA)[data[last]] | _latin(data)[last]), begin + left, end)
    begin, end = np.concatenate([begin, middle]), np.concatenate([middle, end])
    known, number = distinct(np.where(end > begin, byte_hashes(data, begin, end), np.uint64(2**64 - 1)))
    one = np.empty(len(known), dtype=np.int64)
    one[number] = np.arange(len(number))
    # Empty parts, whose number is the greatest, come last.
    size = np.append(end[one] - begin[one], 0) if (end > begin).all() else end[one] - begin[one]
    spelled = gather(data, np.append(begin[one], 0)[: len(size)], size + 1)
    stop = np.cumsum(size + 1)
    spelled[stop - 1] = 32
    letters = _ALPHA[spelled] | (spelled == 0xC3) | _latin(spelled) | (spelled == 32)
    return number.reshape(2, -1).T, spelled.tobytes().decode().split(" ")[:-1], np.logical_and.reduceat(letters, stop - size - 1) & (size > 0)


def _latin(data: np.ndarray) -> np.ndarray:
    """Which bytes are the second ones of letters of Latin-1."""
    found = np.zeros(len(data), dtype=bool)
    found[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return found


def ask(block: int, found: BlockWords, holders: np.ndarray, n: int) -> pa.Table:
    """One row per bucket: number of words, rows of the block that hold each, the words between spaces."""
    bucket = found.buckets(n)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    used = np.flatnonzero(np.diff(edges))
    spelled = spell(found.known.take(pa.array(order)), edges)
    asking = holders[order].astype("<u4")
    bodies = []
    for b in used:
        a, z = int(edges[b]), int(edges[b + 1])
        bodies.append(blocks.squeeze(np.array([z - a], dtype=np.uint32).tobytes() + blocks.planes(asking[a:z]) + spelled[b].as_py()))
    return pa.table({
        "bucket": pa.array(used, pa.int32()), "block": pa.array(np.full(len(used), block), pa.int32()),
        "body": pa.array(bodies, pa.binary()),
    })


def encode_words(questions: DataFrame, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], fold: bool) -> DataFrame:
    """Answers for each word: rows of the corpus that hold it, and its ids. `encode` gives the ids of all words one behind the other, and
    how many each has."""

    def of_bucket(table: pa.Table) -> pa.Table:
        bodies = [blocks.unsqueeze(body) for body in table.column("body").to_pylist()]
        sizes = [int(np.frombuffer(body, np.uint32, 1)[0]) for body in bodies]
        spelled = pa.array([body[4 * n + 4 :] for body, n in zip(bodies, sizes, strict=True)], pa.binary()).view(pa.string())
        # Words that differ in the case of A-Z only have the same ids and one count.
        found = BlockWords.read(pa.chunked_array([spelled]), fold)
        known, number = found.hashes, found.number
        asking = np.concatenate([blocks.whole(body, "<u4", 4, n) for body, n in zip(bodies, sizes, strict=True)])
        holders = np.bincount(number, asking.astype(np.float64), minlength=len(known))
        words = found.spelled(np.arange(len(known))).decode().split(" ")
        asked = np.split(number, np.cumsum(sizes)[:-1])
        flat, length = encode(words)
        first = np.cumsum(length) - length
        count = holders.clip(max=0xFFFFFFFF).astype(np.uint32)
        out = []
        for numbers in asked:
            of_words = gather(flat, first[numbers], length[numbers])
            body = [count[numbers], length[numbers].astype("<u4"), of_words.astype("<u4")]
            out.append(blocks.squeeze(np.array([len(numbers)], np.uint32).tobytes() + b"".join(map(blocks.planes, body))))
        return pa.table({
            "bucket": table.column("bucket"), "block": table.column("block"), "body": pa.array(out, pa.binary()),
        })

    return questions.groupBy("bucket").applyInArrow(of_bucket, blocks.PACKED)


def places(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places begin to begin + length of all pairs, one behind the other."""
    end = np.cumsum(length)
    at = np.repeat(begin - (end - length), length)
    at += np.arange(len(at))
    return at


def gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[begin : begin + length] of all pairs, one behind the other."""
    return flat[places(begin, length)]


def gather_into(
    out: np.ndarray, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, number: np.ndarray, step: int = 1 << 17
) -> None:
    """`gather` into an array of the pairs with these numbers, some at a time, so that the places need little memory."""
    at = 0
    for i in range(0, len(number), step):
        some = number[i : i + step]
        part = gather(flat, begin[some], length[some])
        out[at : at + len(part)] = part
        at += len(part)


def answers(table: pa.Table, found: BlockWords, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows of the corpus, ids of all words, first, length): answers to a block in the order of its words."""
    order = np.argsort(found.buckets(n), kind="stable")
    bodies = dict(zip(table.column("bucket").to_pylist(), table.column("body").to_pylist(), strict=True))
    holders, lengths, ids = [], [], []
    for bucket in sorted(bodies):
        body = blocks.unsqueeze(bodies[bucket])
        k = int(np.frombuffer(body, np.uint32, 1)[0])
        holders.append(blocks.whole(body, "<u4", 4, k))
        lengths.append(blocks.whole(body, "<u4", 4 + 4 * k, k))
        ids.append(blocks.whole(body, "<u4", 4 + 8 * k, len(body) // 4 - 1 - 2 * k))
    if not bodies:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    length = np.concatenate(lengths).astype(np.int64)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return np.concatenate(holders)[place], np.concatenate(ids), (np.cumsum(length) - length)[place], length[place]
