"""Questions that blocks of documents ask about keys of the whole corpus.

A block packs its distinct keys, split by a hash into buckets, into one row per bucket. A bucket sees the keys of all
blocks, and answers each block in the order of its keys. So a key costs a few bytes in the shuffle however
often it occurs in a block, and a frequent key is one entry per block.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACKED = "bucket int, block int, body binary"


def count_blocks(docs: DataFrame, block_bytes: int, least_bytes: int = 256 << 10) -> tuple[int, int, int]:
    """(blocks, rows, bytes of text): one block for every `block_bytes`; of a small corpus, one for every
    `least_bytes`, up to the number of shuffle partitions."""
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, -(-size // block_bytes), min(partitions, -(-size // least_bytes)))
    return n, rows, size


def deal(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The rows with `block`, a hash of id and text, and the number of blocks. `docs` has the columns doc_id and text."""
    n, _, _ = count_blocks(docs, block_bytes)
    block = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(n)).cast("int")
    return docs.withColumn("block", block), n


@functools.cache
def _zstd(level: int) -> pa.Codec:
    return pa.Codec("zstd", compression_level=level)


def squeeze(body: bytes, level: int = 1) -> bytes:
    return len(body).to_bytes(4, "little") + _zstd(level).compress(body, asbytes=True)


def unsqueeze(body: bytes) -> bytes:
    return _zstd(1).decompress(memoryview(body)[4:], int.from_bytes(body[:4], "little"), asbytes=True)


def squeeze_texts(texts: Column) -> Column:
    """Texts compressed one by one, for the shuffle; with their sizes, `texts` reads them."""

    @F.arrow_udf("binary")
    def squeezed(column: pa.Array) -> pa.Array:
        codec = pa.Codec("zstd", compression_level=1)
        return pa.array([codec.compress(t.as_buffer(), asbytes=True) if t.is_valid else b"" for t in column], pa.binary())

    return squeezed(texts)


def texts(squeezed: pa.Array | pa.ChunkedArray, sizes: list[int]) -> Iterator[bytes]:
    codec = pa.Codec("zstd")
    for t, size in zip(squeezed.to_pylist(), sizes, strict=True):
        yield codec.decompress(t, size, asbytes=True) if size else b""


def joined_texts(squeezed: pa.Array | pa.ChunkedArray, sizes: list[int]) -> pa.Array:
    """The texts as a column."""
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    data = np.empty(int(ends[-1]), np.uint8)
    for i, text in enumerate(texts(squeezed, sizes)):
        data[ends[i] : ends[i + 1]] = np.frombuffer(text, np.uint8)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.string())


def planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones, so that high bytes compress to nothing."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def whole(body: bytes, kind: str, begin: int, n: int) -> np.ndarray:
    """`n` numbers written by `planes`, the first of them at byte `begin`."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8, n * size, begin).reshape(size, n).T).view(kind).ravel()


def pack(block: int, bucket_of: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.Table:
    """One row per bucket that has keys; a body holds the columns one after the other, in the given order of keys."""
    order = np.argsort(bucket_of, kind="stable")
    edges = np.searchsorted(bucket_of[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(edges))
    sorted_columns = [c[order] for c in columns]
    bodies = [b"".join(c[edges[i] : edges[i + 1]].tobytes() for c in sorted_columns) for i in used]
    return pa.table({
        "bucket": pa.array(used, pa.int32()), "block": pa.array(np.full(len(used), block), pa.int32()),
        "body": pa.array(bodies, pa.binary()),
    })


def unpack(body: bytes, types: list[str]) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    n = len(body) // sum(widths)
    places = np.cumsum([0] + [n * w for w in widths])
    return [np.frombuffer(body, dtype=t, count=n, offset=int(at)) for t, at in zip(types, places, strict=False)]


def answer(questions: DataFrame, types: list[str], reply: Callable[..., list[np.ndarray]]) -> DataFrame:
    """`reply` gets the concatenated columns of a bucket and the number of the asking block for each entry, and
    returns columns with an entry for each, which go back packed to the blocks."""

    def of_bucket(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        bodies = table.column("body").to_pylist()
        parts = [unpack(bodies[i], types) for i in order]
        sizes = [len(p[0]) for p in parts]
        asking = np.repeat(blocks[order], sizes)
        columns = reply(*[np.concatenate(c) for c in zip(*parts, strict=True)], asking)
        ends = np.cumsum([0, *sizes])
        out = [b"".join(c[ends[i] : ends[i + 1]].tobytes() for c in columns) for i in range(len(parts))]
        return pa.table({
            "bucket": pa.array(np.full(len(parts), table.column("bucket")[0].as_py()), pa.int32()),
            "block": pa.array(blocks[order], pa.int32()), "body": pa.array(out, pa.binary()),
        })

    return questions.groupBy("bucket").applyInArrow(of_bucket, PACKED)


def replies(table: pa.Table, bucket_of: np.ndarray, types: list[str]) -> list[np.ndarray]:
    """The answers of all buckets to one block, in the order in which it listed its keys."""
    order = np.argsort(bucket_of, kind="stable")
    bodies = dict(zip(table.column("bucket").to_pylist(), table.column("body").to_pylist(), strict=True))
    parts = [unpack(bodies[b], types) for b in sorted(bodies)]
    out = []
    for i, kind in enumerate(types):
        whole = np.empty(len(order), dtype=kind)
        whole[order] = np.concatenate([p[i] for p in parts]) if parts else np.empty(0, dtype=kind)
        out.append(whole)
    return out
