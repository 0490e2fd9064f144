"""Remove passages that occur in an earlier document, as spans over consecutive sentences."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm import blocks
from txlake.llm.batches import mix, placed_words, run_hashes, text_blocks

BLOCK_BYTES = 8 << 20
# Words of a span.
SPAN = 51
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True
_ASKED = ["u8", "u8", "i8"]
_SECOND = np.uint64(0xD1B54A32D192ED03)


@dataclass
class Runs:
    """Words of a block of texts and the spans of them, one for every word with which a span can begin."""

    row: np.ndarray  # of a word
    begin: np.ndarray  # byte at which it begins
    sentence: np.ndarray  # number of its sentence
    hashes: np.ndarray  # of a word
    first: np.ndarray  # word with which a span begins
    mark: np.ndarray  # smallest hash of the parts of a span, each half its words long
    words: int  # of a span

    def hash(self, seed: np.uint64 = np.uint64(0)) -> np.ndarray:
        values = mix(self.hashes ^ seed) if seed else self.hashes
        return run_hashes(values, self.first, self.first + self.words)

    def only(self, chosen: np.ndarray) -> Runs:
        return replace(self, first=self.first[chosen], mark=self.mark[chosen])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :])


def find_runs(block: np.ndarray, starts: np.ndarray, words: int) -> Runs:
    """All spans of exactly `words` words of a text, wherever they begin.

    A sentence ends behind a word that ends with . ! or ?, and at a line break. Equal spans have equal marks, and
    neighbouring spans often the same: a text has about four different marks for as many words as a span has.
    """
    hashes, rows, begin, end = placed_words(block, starts)
    n = len(hashes)
    new = np.ones(n, dtype=bool)
    if n:
        breaks = np.cumsum(block == 10)
        new[1:] = (rows[1:] != rows[:-1]) | _ENDS[block[end[:-1] - 1]] | (breaks[begin[1:]] > breaks[end[:-1] - 1])
    first, mark = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    if n >= words:
        part = words - words // 2
        at = np.arange(n - part + 1)
        mark = least(run_hashes(hashes, at, at + part), words // 2 + 1)
        first = np.flatnonzero(rows[: n - words + 1] == rows[words - 1 :])
    return Runs(rows, begin, np.cumsum(new) - 1, hashes, first, mark[first], words)


def _marks(runs: list[Runs]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct marks of a block in order, and whether several of its texts have them."""
    pairs, before = [[np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)]], 0
    for r in runs:
        row = r.row[r.first] + before
        fresh = np.ones(len(row), dtype=bool)
        fresh[1:] = (r.mark[1:] != r.mark[:-1]) | (row[1:] != row[:-1])
        pairs.append([r.mark[fresh], row[fresh]])
        before = before + int(r.row.max(initial=-1)) + 1
    mark, row = (np.concatenate(c) for c in zip(*pairs, strict=True))
    by = np.lexsort((row, mark))
    mark, row = mark[by], row[by]
    new = np.ones(len(mark), dtype=bool)
    new[1:] = mark[1:] != mark[:-1]
    other = np.zeros(len(mark), dtype=bool)
    other[1:] = ~new[1:] & (row[1:] != row[:-1])
    return mark[new], np.bincount(np.cumsum(new) - 1, other, minlength=int(new.sum())) > 0


def _several(mark: np.ndarray, asking: np.ndarray) -> list[np.ndarray]:
    """1 for marks that several blocks name."""
    _, number, count = np.unique(mark, return_inverse=True, return_counts=True)
    return [(count[number] > 1).astype(np.uint8)]


def _keys(runs: list[Runs], order: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes (a, b) of all spans, the smallest document among those holding each, the number of the key of
    every span, and the first span of every key, numbered over all parts."""
    a, b = np.concatenate([r.hash() for r in runs]), np.concatenate([r.hash(_SECOND) for r in runs])
    doc = np.concatenate([o[r.row[r.first]] for r, o in zip(runs, order, strict=True)])
    by = np.lexsort((np.arange(len(a)), doc, b, a))
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
    key = np.empty(len(a), dtype=np.int64)
    key[by] = np.cumsum(new) - 1
    heads = by[new]
    return a[heads], b[heads], doc[heads], key, heads


def _first_holder(a: np.ndarray, b: np.ndarray, doc: np.ndarray, asking: np.ndarray) -> list[np.ndarray]:
    """1 for the block that holds the first occurrence of a key: that of the smallest document."""
    by = np.lexsort((asking, doc, b, a))
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
    first = np.empty(len(a), dtype=np.uint8)
    first[by] = new
    return [first]


def remove_repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SPAN) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed_words, text (what is left) for every row.

    Spans of `words` words, wherever they begin, that occur in several documents, words compared with A-Z as a-z
    and any white space between them, stay only in the document with the smallest id, however often that repeats them. In the
    others all words they cover go, with the white space behind them; n_removed counts the sentences that lose words. So nothing goes that does not stand,
    `words` words long, in an earlier document; what a text repeats of itself is left to `periodic_runs`.

    Ids that are no integers are ordered by a hash, null ids come first; rows that repeat an id are documents of their
    own, the one in the block of the smaller number (a hash of id and text) counting as first. A null or empty text has no sentences and
    stays empty. Other columns are not read, whatever their names.

    Texts are shuffled once, into blocks of bounded size. Blocks first ask which marks of spans (see `find_runs`) other texts have
    too; then, of the spans with such marks only, which block holds the first. Both as hashes, each once per block.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    number = F.col("doc_id").cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64("doc_id")
    plain = plain.withColumn("number", F.coalesce(number, F.lit(-(1 << 63))))
    dealt, n = blocks.deal(plain, BLOCK_BYTES)

    def read(table: pa.Table):
        parts, order = [], []
        numbers = table.column("number").to_numpy()
        for first, block, starts in text_blocks(table.column("text").combine_chunks()):
            parts.append((first, block, starts, find_runs(block, starts, words)))
            order.append(numbers[first : first + len(starts) - 1])
        return parts, order

    def bucket(hashes: np.ndarray) -> np.ndarray:
        return (hashes % np.uint64(n)).astype(np.int64)

    def ask_marks(table: pa.Table) -> pa.Table:
        mark, _ = _marks([p[3] for p in read(table)[0]])
        return blocks.pack(table.column("block")[0].as_py(), bucket(mark), [mark], n)

    def shared(table: pa.Table, answers: pa.Table):
        """The parts of a block with the spans whose marks other texts have too, and their keys."""
        parts, order = read(table)
        mark, own = _marks([p[3] for p in parts])
        (others,) = blocks.replies(answers, bucket(mark), ["u1"])
        chosen = own | (others == 1)
        parts = [(*p, r.only(chosen[np.searchsorted(mark, r.mark)])) for *p, r in parts]
        return parts, _keys([p[3] for p in parts], order)

    def ask_spans(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("body", pa.binary())]).empty_table()
        _, (a, b, doc, _, _) = shared(table, answers)
        return blocks.pack(table.column("block")[0].as_py(), bucket(a), [a, b, doc], n)

    out_schema = pa.schema([
        ("doc_id", pa.null()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("removed_words", pa.int64()),
        ("text", pa.string()),
    ])

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = out_schema.set(0, table.schema.field("doc_id"))
        if not len(table):
            return schema.empty_table()
        of_marks = np.asarray(answers.column("of_marks"))
        parts, (a, _, _, key, heads) = shared(table, answers.filter(pa.array(of_marks)))
        (first_here,) = blocks.replies(answers.filter(pa.array(~of_marks)), bucket(a), ["u1"])
        done, at = [], 0
        for first, block, starts, runs in parts:
            rows, count, size = len(starts) - 1, len(runs.row), len(runs.first)
            mine = np.arange(at, at + size)
            # Places of the first holder's own text stay, all of them.
            head = heads[key[mine]] - at
            near = (first_here[key[mine]] == 1) & (head >= 0) & (head < size)
            lost = np.ones(size, dtype=bool)
            lost[near] = runs.row[runs.first[near]] != runs.row[runs.first[head[near]]]
            at += size
            cover = np.zeros(count + 1, dtype=np.int64)
            np.add.at(cover, runs.first[lost], 1)
            np.add.at(cover, runs.first[lost] + words, -1)
            covered = np.cumsum(cover[:-1]) > 0
            # A word reaches to the next one of its text.
            reach = np.append(runs.begin[1:], len(block))
            reach = np.minimum(reach, starts[runs.row + 1] - 1) if count else reach[:0]
            inside = np.zeros(len(block) + 1, dtype=np.int32)
            np.add.at(inside, runs.begin[covered], 1)
            np.add.at(inside, reach[covered], -1)
            stays = np.cumsum(inside[:-1]) == 0
            stays[starts[1:] - 1] = False
            sizes = np.add.reduceat(stays, starts[:-1]) if rows else np.empty(0)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            left = pa.Array.from_buffers(
                pa.large_string(), rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(block[stays].tobytes())]
            ).cast(pa.string())
            of_sentence = runs.row[np.flatnonzero(np.diff(runs.sentence, prepend=-1))]
            done.append(pa.table({
                "doc_id": table.column("doc_id").slice(first, rows),
                "n_sentences": np.bincount(of_sentence, minlength=rows).astype(np.int64),
                "n_removed": np.bincount(of_sentence[np.unique(runs.sentence[covered])], minlength=rows).astype(np.int64),
                "removed_words": np.bincount(runs.row[covered], minlength=rows).astype(np.int64),
                "text": left,
            }, schema=schema))
        return pa.concat_tables(done)

    by_block = dealt.groupBy("block")
    marks = blocks.answer(by_block.applyInArrow(ask_marks, blocks.PACKED), ["u8"], _several)
    spans = blocks.answer(by_block.cogroup(marks.groupBy("block")).applyInArrow(ask_spans, blocks.PACKED), _ASKED, _first_holder)
    answers = marks.withColumn("of_marks", F.lit(True)).unionByName(spans.withColumn("of_marks", F.lit(False)))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        remove, f"doc_id {kind}, n_sentences bigint, n_removed bigint, removed_words bigint, text string"
    )
