"""Ranked lexical search: documents are grouped by the mask of the query terms they hold, masks are taken by descending bound."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.batches import distinct, text_blocks
from txlake.llm.terms import placed_terms
from txlake.plans.session import shared_folder

# Bytes of different item texts that are asked in one pass over the documents; a longer text has a pass of its own.
QUERY_BYTES = 4 << 20
# Documents times query terms whose bitmaps are held at a time.
CELLS = 4 << 20
# Rows of one item that may meet in a task before the last step, for each of so many salts.
SALTS = 64
N, TOTAL = -1, -2


@dataclass
class Items:
    """Distinct terms of a block of items in order of their hashes; for each item the numbers and repeats of its terms."""

    hashes: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def read(cls, texts: list[str]) -> Items:
        hashes, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for first, block, starts in text_blocks(pa.array(texts, pa.large_string())):
            found, row, _, _ = placed_terms(block, starts)
            hashes.append(found)
            rows.append(row + first)
        known, number = distinct(np.concatenate(hashes))
        pairs, count = np.unique(np.concatenate(rows) * max(1, len(known)) + number, return_counts=True)
        row, term = np.divmod(pairs, max(1, len(known)))
        edge = np.searchsorted(row, np.arange(1, len(texts)))
        return cls(known, np.split(term, edge), np.split(count, edge))


@dataclass
class Postings:
    """Terms of a block of documents: `length` terms of each row; (term of the items, row, occurrences), by term and row."""

    length: np.ndarray
    term: np.ndarray
    row: np.ndarray
    count: np.ndarray

    @classmethod
    def read(cls, block: np.ndarray, starts: np.ndarray, hashes: np.ndarray) -> Postings:
        n_rows = len(starts) - 1
        found, row, _, _ = placed_terms(block, starts)
        place = np.minimum(np.searchsorted(hashes, found), max(0, len(hashes) - 1))
        asked = hashes[place] == found if len(hashes) else np.zeros(len(found), dtype=bool)
        pairs, count = np.unique(place[asked] * n_rows + row[asked], return_counts=True)
        term, of_row = np.divmod(pairs, n_rows)
        return cls(np.bincount(row, minlength=n_rows), term, of_row, count)


def _counts(items: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents with terms, terms of all documents, and documents with each term of the items, of a partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders = np.zeros(len(items.hashes), dtype=np.int64)
        n = total = 0
        for batch in batches:
            for _, block, starts in text_blocks(batch.column("text")):
                found = Postings.read(block, starts, items.hashes)
                holders += np.bincount(found.term, minlength=len(holders))
                n += int(np.count_nonzero(found.length))
                total += int(found.length.sum())
        used = np.flatnonzero(holders)
        yield pa.record_batch({
            "term": pa.array([N, TOTAL, *used.tolist()], pa.int32()), "n": pa.array([n, total, *holders[used].tolist()], pa.int64()),
        })

    return count


@dataclass
class Best:
    """The `k` best documents of each item so far; equal scores by ascending id, null ids last."""

    k: int
    scores: list[np.ndarray] = field(default_factory=list)
    ids: list[np.ndarray] = field(default_factory=list)
    missing: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, k: int, items: int) -> Best:
        none = np.empty(0, dtype=np.int64)
        return cls(k, [none] * items, [none] * items, [none.astype(bool)] * items)

    def least(self, item: int) -> int:
        """What a document needs to come among the best; with an equal score its id decides."""
        return int(self.scores[item][-1]) if len(self.scores[item]) == self.k else 1

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        good = scores >= self.least(item)
        scores = np.concatenate([self.scores[item], scores[good]])
        ids = np.concatenate([self.ids[item], ids[good]])
        missing = np.concatenate([self.missing[item], missing[good]])
        by = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores[item], self.ids[item], self.missing[item] = scores[by], ids[by], missing[by]


def _groups(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct columns of a table of bits, number of each column's): the matched-term masks and their documents."""
    packed = np.packbits(present, axis=0)
    wide = np.zeros((present.shape[1], -(-len(packed) // 8) * 8), dtype=np.uint8)
    wide[:, : len(packed)] = packed.T
    if wide.shape[1] == 8:
        masks, group = distinct(wide.view(np.uint64).ravel())
    else:
        masks, group = np.unique(wide.view(np.dtype((np.void, wide.shape[1]))).ravel(), return_inverse=True)
    bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), -1), axis=1, count=len(present))
    return bits, group.ravel()


def _search_block(items: Items, weights: np.ndarray, found: Postings, m: np.ndarray, ids: np.ndarray, missing: np.ndarray, best: Best) -> None:
    used, local = np.unique(found.term, return_inverse=True)
    number = np.full(len(items.hashes), -1, dtype=np.int64)
    number[used] = np.arange(len(used))
    rows = np.unique(found.row)
    step = max(1, CELLS // max(1, len(used)))
    place = np.searchsorted(rows, found.row)
    for first in range(0, len(rows), step):
        part = rows[first : first + step]
        mine = (place >= first) & (place < first + step)
        term, row, tf = local[mine], place[mine] - first, found.count[mine]
        # Parts of the score with the term's weight, 0 where a document does not hold the term.
        value = np.zeros((len(used), len(part)), dtype=np.int64)
        value[term, row] = weights[found.term[mine]] * (1_000_000_000 * tf // (1000 * tf + 8 * m[part][row]))
        most = value.max(axis=1)
        present = np.zeros(value.shape, dtype=bool)
        present[term, row] = True
        for item, (terms, repeats) in enumerate(zip(items.terms, items.repeats, strict=True)):
            at = number[terms]
            here = at >= 0
            at, times = at[here], repeats[here].astype(np.int64)
            bound = times * most[at]
            if bound.sum() < best.least(item):
                continue
            bits, group = _groups(present[at])
            bounds = bits @ bound
            order = np.argsort(-bounds, kind="stable")
            by_group = np.argsort(group, kind="stable")
            edges = np.searchsorted(group[by_group], np.arange(len(bits) + 1))
            done, width = 0, 1
            # No document of a later mask scores more than its bound; an equal score may win by its id.
            while done < len(order) and bounds[order[done]] >= best.least(item):
                some = order[done : done + width]
                some = some[bounds[some] >= best.least(item)]
                docs = np.concatenate([by_group[edges[g] : edges[g + 1]] for g in some.tolist()])
                scores = times @ value[np.ix_(at, docs)]
                best.add(item, scores, ids[part[docs]], missing[part[docs]])
                done, width = done + width, width * 2


def _tops(items: Items, n: int, total: int, holders: np.ndarray, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * h + 1))) for h in holders.tolist()], dtype=np.int64)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best.of(k, len(items.terms))
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            missing = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            for first, block, starts in text_blocks(batch.column("text")):
                found = Postings.read(block, starts, items.hashes)
                m = 100 - 75 + 75 * found.length * n // max(1, total)
                last = first + len(starts) - 1
                _search_block(items, weights, found, m, ids[first:last], missing[first:last], best)
        sizes = [len(s) for s in best.scores]
        ids, missing = (np.concatenate(x) if x else np.empty(0) for x in (best.ids, best.missing))
        yield pa.record_batch({
            "number": pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
            "doc_id": pa.array(ids.astype(np.int64), pa.int64(), mask=missing.astype(bool)),
            "score": pa.array(np.concatenate(best.scores) if sizes else [], pa.int64()),
        })

    return tops


def _best_rows(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` documents with the highest score above 0 for each item.

    `docs` has doc_id (a long) and text, `items` item_id and text. Terms are those of `terms.placed_terms`; weights and scores are whole numbers
    as in BM25 with k1 = 0.8 and b = 0.75: the sum over the item's terms, repeats included, of
    w * (10^9 tf div (1000 tf + 8 m)), with w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 25 + 75 n N div L.
    Counts cover all documents. Equal scores are ranked by ascending doc_id, null ids last. Rows that repeat an id
    or a text are documents, or items, of their own. Null, empty and termless texts are found by no item and count for
    nothing; such items find nothing; without documents or items the result is empty. Terms are equal when their 64-bit hashes are.

    Different item texts are asked in blocks of about QUERY_BYTES, each with one pass for counts and one for scores over the
    documents; a block reaches the driver and every task. A task keeps the best rows of every item, so later documents are only
    scored where the bound of their mask reaches them. What the tasks found is cut by item and salt, then by item.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    asked = items.select(F.col("item_id"), F.col("text"))
    texts = asked.select("text").filter(F.octet_length("text") > 0).distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // QUERY_BYTES)
    out = []
    for block in range(blocks):
        mine = texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        known = [r.text for r in mine.collect()]
        queries = Items.read(known)
        counted = docs.mapInArrow(_counts(queries), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        counts = dict(zip(counted.column("term").to_pylist(), counted.column("n").to_pylist(), strict=True))
        holders = np.array([counts.get(t, 0) for t in range(len(queries.hashes))], dtype=np.int64)
        found = docs.mapInArrow(_tops(queries, counts.get(N, 0), counts.get(TOTAL, 0), holders, k), "number int, doc_id long, score long")
        salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        tops = _best_rows(_best_rows(salted, ["number", "salt"], k).drop("rank", "salt"), ["number"], k).checkpoint()
        numbers = spark.createDataFrame(pa.table({"number": pa.array(range(len(known)), pa.int32()), "text": pa.array(known, pa.string())}))
        out.append(asked.join(numbers, "text").select("item_id", "number").join(tops, "number").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole
