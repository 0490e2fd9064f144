"""Near-duplicate documents by weighted Jaccard similarity of their word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm import blocks
from txlake.llm.batches import mix, text_blocks, words
from txlake.llm.components import components
from txlake.operators.skew import spread_join
from txlake.plans.session import shared_folder

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD1B54A32D192ED03)
# Bags and shingles of a block of bags that are compared with each other.
TASK_BAGS, TASK_UNITS = 600, 400_000
# Texts of a batch that are packed or unpacked at once.
UNPACKED_ROWS = 512


def _multiple(x: np.uint64, n: int) -> np.uint64:
    return np.uint64(int(x) * n % (1 << 64))


def shingle_counts(block: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count), by row and shingle: runs of `size` words; a shorter text is one shingle."""
    hashes, rows = words(block, starts)
    n = len(hashes)
    of_row = np.bincount(rows, minlength=len(starts) - 1)
    found_rows, found = [], []
    if n >= size:
        whole = np.flatnonzero(rows[: n - size + 1] == rows[size - 1 :])
        shingle = np.zeros(len(whole), dtype=np.uint64)
        for k in range(size):
            shingle = shingle * _STEP + hashes[whole + k]
        found_rows.append(rows[whole])
        found.append(mix(shingle))
    first = np.cumsum(of_row) - of_row
    for short in range(1, size):
        at = np.flatnonzero(of_row == short)
        shingle = np.full(len(at), short, dtype=np.uint64)
        for k in range(short):
            shingle = shingle * _STEP + hashes[first[at] + k]
        found_rows.append(at)
        found.append(mix(shingle))
    row, shingle = np.concatenate(found_rows), np.concatenate(found)
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return row[at], shingle[at], np.diff(np.append(at, len(row)))


def units(row: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, unit): each occurrence of a shingle by a number of its own, so that multisets become sets."""
    all_rows = np.repeat(row, count)
    begin = np.cumsum(count) - count
    nth = np.arange(len(all_rows)) - np.repeat(begin, count)
    return all_rows, mix(np.repeat(shingle, count) + nth.astype(np.uint64) * _STEP)


def signatures(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """n_rows x m BagMinHash values; components of two rows agree with their weighted Jaccard similarity as probability.

    The weight of a shingle is cut into the intervals [0, 1), [1, 2), [2, 4), [4, 8) ... below its count. Each
    interval has a Poisson process of its own, seeded by the shingle, whose points have a time, a component
    and a place; a point behind the count is left out. A component's value is its earliest time. Processes are
    followed in step, each until its time passes the latest value of its row, so that a row costs about its number
    of shingles plus m log m points whatever the counts are.
    """
    values = np.full(n_rows * m, np.inf)
    parts = []
    level = 0
    while len(row):
        start, length = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        inside = count > start
        row, shingle, count = row[inside], shingle[inside], count[inside]
        seed = mix(shingle ^ _multiple(_SECOND, level + 1))
        parts.append((row, seed, np.full(len(row), length), np.minimum(count - start, length)))
        level += 1
    if not parts:
        return values.reshape(n_rows, m)
    at, seed, length, reach = (np.concatenate(p) for p in zip(*parts, strict=True))
    time = np.zeros(len(at))
    point = 0
    while len(at):
        point += 1
        draw = mix(seed + _multiple(_STEP, point))
        other = mix(draw ^ _SECOND)
        time = time - np.log(((draw >> np.uint64(11)) + 0.5) * 2.0**-53) / (m * length)
        component = (((other >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        place = (other & np.uint64(0xFFFFFFFF)) & (length - 1).astype(np.uint64)
        hit = place < reach
        np.minimum.at(values, (at * m + component)[hit], time[hit])
        latest = np.full(n_rows, -1.0)
        live = np.unique(at) if len(at) < n_rows else np.arange(n_rows)
        latest[live] = values.reshape(n_rows, m)[live].max(axis=1)
        go_on = time < latest[at]
        at, seed, length, reach, time = at[go_on], seed[go_on], length[go_on], reach[go_on], time[go_on]
    return values.reshape(n_rows, m)


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    """rows x bands numbers; a band's number stands for its values and its place."""
    n, m = values.shape
    bits = values.view(np.uint64).reshape(n, bands, m // bands)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _SECOND, (n, bands))
    for k in range(m // bands):
        keys = mix(keys * _STEP + bits[:, :, k])
    return keys


def _signed(batches: Iterator[pa.RecordBatch], size: int, bands: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, block, starts in text_blocks(batch.column("text")):
            n = len(starts) - 1
            row, shingle, count = shingle_counts(block, starts, size)
            unit_row, unit = units(row, shingle, count)
            total = np.bincount(unit_row, minlength=n)
            digest = np.zeros((n, 2), dtype=np.uint64)
            np.add.at(digest[:, 0], unit_row, unit)
            np.add.at(digest[:, 1], unit_row, mix(unit ^ _SECOND))
            keys = band_keys(signatures(row, shingle, count, n, bands * width), bands)
            part = batch.slice(first, n)
            empty = total == 0
            yield pa.record_batch({
                "doc_id": part.column("doc_id"),
                "row": part.column("row"),
                "bag": pa.array([None if e else d.tobytes() for e, d in zip(empty, digest, strict=True)], pa.binary()),
                "size": total.astype(np.int64),
                "bands": pa.ListArray.from_arrays(
                    np.arange(n + 1, dtype=np.int32) * bands, keys.astype(np.int64).ravel()
                ),
            })


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle, few at a time."""
    codec = pa.Codec("zstd", compression_level=1)
    for whole in batches:
        for at in range(0, len(whole), UNPACKED_ROWS):
            batch = whole.slice(at, UNPACKED_ROWS)
            bodies = [t.as_buffer() for t in batch.column("text")]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "row": batch.column("row"), "octets": pa.array([b.size for b in bodies], pa.int32()),
                "packed": pa.array([codec.compress(b, asbytes=True) for b in bodies], pa.binary()),
            })


def _bags(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), UNPACKED_ROWS):
            batch = whole.slice(at, UNPACKED_ROWS)
            texts = blocks.joined_texts(batch.column("packed"), batch.column("octets").to_pylist())
            for first, block, starts in text_blocks(texts):
                n = len(starts) - 1
                unit_row, unit = units(*shingle_counts(block, starts, size))
                ends = np.concatenate([[0], np.cumsum(np.bincount(unit_row, minlength=n))])
                yield pa.record_batch({
                    "bag": batch.column("bag").slice(first, n),
                    "units": pa.ListArray.from_arrays(ends.astype(np.int32), unit.astype(np.int64)),
                })


def _verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose multisets of shingles overlap enough."""
    u = bags.select(F.col("bag").alias("u"), F.col("units").alias("units_u"))
    v = bags.select(F.col("bag").alias("v"), F.col("units").alias("units_v"))
    # v is the hub: few rows, so that little is carried to the other side.
    both = pairs.join(v, "v").join(u, "u")
    overlap = F.size(F.array_intersect("units_u", "units_v"))
    union = F.size("units_u") + F.size("units_v") - overlap
    return both.filter(overlap >= similarity * union).select("u", "v")


def _compare(table: pa.Table, similarity: float) -> pa.Table:
    """Edges that connect the similar bags of a task: those of one block, or of one block with those of another."""
    table = table.combine_chunks()
    lists = table.column("units").combine_chunks()
    flat, number = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    edges = lists.offsets.to_numpy().astype(np.int64)
    edges = edges - edges[0]
    size, block = np.diff(edges), table.column("block").to_numpy()
    names, parent = table.column("bag").to_pylist(), list(range(len(size)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    known: dict[bytes, int] = {}
    for i, part in enumerate(table.column("part").to_pylist()):
        parent[root(i)] = root(known.setdefault(part, i))
    first = block == block.min()
    across = not first.all()
    found = []
    mark = np.zeros(len(flat), dtype=bool)
    for i in np.flatnonzero(first):
        own = number[edges[i] : edges[i + 1]]
        mark[own] = True
        overlap = np.add.reduceat(mark[number], edges[:-1], dtype=np.int64)
        mark[own] = False
        near = overlap >= similarity * (size + size[i] - overlap)
        if across:
            near &= ~first
        for j in np.flatnonzero(near).tolist():
            a, b = root(int(i)), root(j)
            if a != b:
                parent[a] = b
                found.append((names[i], names[j]))
    return pa.table({
        "u": pa.array([u for u, _ in found], pa.binary()), "v": pa.array([v for _, v in found], pa.binary()),
    })


def similar_bags(signed: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Edges (u, v) between different bags: enough to connect all bags that share a band and are similar.

    First the members of each bucket of a band are compared with its hub, the member with the largest buckets, as
    the text from which the others were made is. What the hub links needs no comparison among itself.
    Buckets that are still apart are joined where they share bags, and all bags of such a group are compared in
    tasks of bounded size: one for each block of the group and each pair of blocks. No bucket is cut off.
    """
    apart = signed.filter(F.col("bag").isNotNull()).groupBy("bag").agg(
        F.first("size").alias("size"), F.first("bands").alias("bands")
    ).select("bag", "size", F.explode("bands").alias("bucket"))
    full = apart.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    members = apart.join(full, "bucket").checkpoint()
    rank = members.groupBy("bag").agg(F.sum("n").alias("rank")).checkpoint()
    # The row that stands for a bag is looked up for the bags that are compared only, not carried along with each band.
    at = signed.filter(F.col("bag").isNotNull()).groupBy("bag").agg(F.min(F.struct("doc_id", "row")).alias("at"))
    chosen = at.join(rank, "bag").select("bag", F.col("at.doc_id").alias("doc_id"), F.col("at.row").alias("row"))
    # Texts are compressed for the shuffle. Of rows that repeat id and text, each gives the same bag.
    id_type = texts.schema["doc_id"].dataType.simpleString()
    packed = texts.mapInArrow(_packed, f"doc_id {id_type}, row bigint, octets int, packed binary")
    bags = (
        packed.join(chosen, packed.doc_id.eqNullSafe(chosen.doc_id) & (packed.row == chosen.row))
        .select("bag", "octets", "packed")
        .mapInArrow(lambda b: _bags(b, size), "bag binary, units array<bigint>")
        .dropDuplicates(["bag"])
        .checkpoint()
    )
    ranked = members.select("bucket", "bag", "size").join(rank.select("bag", "rank"), "bag")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("rank", "bag", "size")).alias("hub")).select(
        "bucket", F.col("hub.bag").alias("v"), F.col("hub.size").alias("v_size")
    )
    led = ranked.join(hubs, "bucket").filter(F.col("bag") != F.col("v")).select(
        "bucket", F.col("bag").alias("u"), "size", "v", "v_size"
    ).checkpoint()
    similar_size = F.least("size", "v_size") >= similarity * F.greatest("size", "v_size")
    direct = _verified(led.filter(similar_size).select("u", "v").distinct(), bags, similarity).checkpoint()

    parts = components(direct).select(F.col("node").alias("bag"), "component")
    rest = led.select("bucket", F.col("u").alias("bag")).join(parts, "bag", "left").select(
        "bucket", "bag", F.coalesce("component", "bag").alias("part")
    )
    open_ = rest.groupBy("bucket").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.min("bag").alias("least")).filter(
        F.col("a") != F.col("b")
    ).select("bucket", "least")
    still = rest.join(open_, "bucket").checkpoint()
    chains = components(still.select(F.col("bag").alias("u"), F.col("least").alias("v")))
    weighed = (
        still.select("bag", "part").distinct()
        .join(chains.select(F.col("node").alias("bag"), F.col("component").alias("chain")), "bag")
        .join(bags, "bag").withColumn("n", F.size("units").cast("long")).checkpoint()
    )
    weights = weighed.groupBy("chain").agg(
        F.ceil(F.greatest(F.count("*") / TASK_BAGS, F.sum("n") / TASK_UNITS)).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("bag"), F.col("blocks")).cast("int")
    tasks = weighed.join(weights, "chain").withColumn("block", block).select(
        "bag", "part", "units", "block", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda o: F.xxhash64("chain", F.least(o, F.col("block")), F.greatest(o, F.col("block"))),
        )).alias("task")
    )
    left = tasks.groupBy("task").applyInArrow(lambda t: _compare(t, similarity), "u binary, v binary")
    return direct.union(left)


def near_duplicate_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shingle: int = 5, similarity: float = 0.8, bands: int = 32, width: int = 5,
) -> DataFrame:
    """doc_id, class_id, class_size, kept for every row, and `row`, which with doc_id names the row.

    Words are separated by white space, A-Z counts as a-z; a text is the multiset of its runs of `shingle` words, a shorter
    one a single run of all its words. Texts whose multisets have a weighted Jaccard similarity of at least
    `similarity` are linked; a class is what links connect, and its id the smallest doc_id in it. Two texts
    at exactly 0.8 share none of the 32 bands of 5 with a probability below 4 in a million.

    Equal multisets are one node, however many rows have them. A text without words, null ones included, is a class of its own with its
    own id. Null ids are ignored in the choice of class ids unless a class has no other. The kept row is that
    of the smallest id, then of the smallest text hash; rows that repeat id and text share their flag. Other
    columns are not read, whatever their names.
    """
    shared_folder(docs.sparkSession)
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    id_type = texts.schema["doc_id"].dataType.simpleString()
    signed = texts.mapInArrow(
        lambda b: _signed(b, shingle, bands, width),
        f"doc_id {id_type}, row bigint, bag binary, size bigint, bands array<bigint>",
    ).checkpoint()
    edges = similar_bags(signed, texts, shingle, similarity)
    parts = components(edges)
    # A text without words is its own class.
    alone = F.concat(F.lit("alone:"), F.xxhash64("doc_id", "row").cast("string")).cast("binary")
    placed = signed.select("doc_id", "row", "bag").join(
        parts.select(F.col("node").alias("bag"), "component"), "bag", "left"
    ).select("doc_id", "row", F.coalesce("component", "bag", alone).alias("class"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = placed.groupBy("class").agg(F.count("*").alias("class_size"), F.min(first).alias("first"))
    return spread_join(placed, classes, "class", "inner").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))).alias("kept"),
        "row",
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class, with all its columns; rules as in `near_duplicate_classes`. Rows that repeat id and text
    stay together. Column names beginning with two underscores are reserved."""
    lost = near_duplicate_classes(docs, doc_id, text, **options).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__row")
    ).distinct()
    row = F.coalesce(F.xxhash64(F.col(f"`{text}`")), F.lit(0))
    return docs.join(lost, F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (row == F.col("__row")), "left_anti")
