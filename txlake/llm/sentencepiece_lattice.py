"""SentencePiece encoding over a table of lattice edges, and decoding."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import blocks
from txlake.llm.batches import mix, run_hashes
from txlake.llm.vocabulary import gather, gather_into

SPACE = "▁"
BLOCK_BYTES = 5 << 20
MOST_PIECES = 1 << 20
# Longer words are merged one by one, with a heap: a word without white space may be a whole text.
LONG = 48
BATCH = 16384
_UNSEEN = 1 << 30


@dataclass
class PieceModel:
    kind: str  # "bpe" or "unigram"
    pieces: list[tuple[str, int, float]]  # piece, id, score: what text can match
    byte_ids: list[int]  # empty without byte fallback
    unknown: int
    spelled: list[bytes]  # what each id stands for

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    def ranks(self) -> dict[str, tuple[int, int]]:
        """(rank, id) of a piece; pieces of equal score share a rank."""
        levels = {s: r for r, s in enumerate(sorted({s for _, _, s in self.pieces}, reverse=True))}
        return {p: (levels[s], i) for p, i, s in self.pieces}


def load(path: str, kind: str | None = None) -> PieceModel:
    """Read a model file. Supported are models that keep text as it is, put a space in front and let no
    piece hold a space behind another character or a line break; `kind` overrides the file's type."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm = model.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only models without normalisation and with a leading space are supported")
    normal, byte, defined = 1, 6, 4
    pieces = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type in (normal, defined)]
    if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p, _, _ in pieces):
        raise ValueError("a piece crosses the border of a word")
    if len(pieces) > MOST_PIECES:
        raise ValueError("the piece table is too large for a task")
    bytes_of = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == byte}
    spelled = [
        bytes([int(p.piece[1:-1], 16)]) if p.type == byte
        else p.piece.replace(SPACE, " ").encode() if p.type in (normal, defined) else b""
        for p in model.pieces
    ]
    types = {1: "unigram", 2: "bpe"}
    return PieceModel(
        kind or types[model.trainer_spec.model_type], pieces, [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else [],
        next((i for i, p in enumerate(model.pieces) if p.type == 2), 0), spelled,
    )


class Lattice:
    """Encodes many words at once, all arrays running over the characters or pieces of a batch of words.

    The lattice is a table of edges, a substring that is a piece each: substrings one character longer at a time are joined to the
    beginnings of pieces, and those that begin no piece go no further. Merging models fold merges over it, others its best path.
    """

    def __init__(self, model: PieceModel) -> None:
        self.kind, self.longest = model.kind, model.longest
        beginnings = dict.fromkeys(p[:k] for p, _, _ in model.pieces for k in range(1, len(p) + 1))
        number = {p: k for k, (p, _, _) in enumerate(model.pieces)}
        values, size = _characters(list(beginnings))
        keys = run_hashes(_hashed(values), np.cumsum(size) - size, np.cumsum(size))
        order = np.argsort(keys)
        self.keys, self.piece = keys[order], np.array([number.get(b, -1) for b in beginnings], np.int32)[order]
        ranks = model.ranks()
        self.rank = np.array([ranks[p][0] for p, _, _ in model.pieces], np.int64)
        self.id = np.array([ranks[p][1] for p, _, _ in model.pieces], np.uint32)
        self.score = np.array([s for _, _, s in model.pieces], np.float64)
        self.byte_ids, self.unknown = model.byte_ids, model.unknown
        self.long = LongWords(model)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one behind the other, and how many each has; no word is empty."""
        out, counts, at = [np.empty(0, np.uint32)], [np.empty(0, np.int64)], 0
        while at < len(words):
            if len(words[at]) > LONG:
                ids = np.array(self.long(words[at]), np.uint32)
                found, at = (ids, np.array([len(ids)], np.int64)), at + 1
            else:
                end = at + 1
                while end < len(words) and end < at + BATCH and len(words[end]) <= LONG:
                    end += 1
                found, at = self._encode(words[at:end]), end
            out.append(found[0])
            counts.append(found[1])
        return np.concatenate(out), np.concatenate(counts)

    def _edges(self, values: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Number of the piece by length and first character, -1 for none; `stop` is the end of a character's word."""
        edges = np.full((self.longest + 1, len(values)), -1, np.int32)
        hashed, at = _hashed(values), np.arange(len(values))
        for length in range(1, self.longest + 1):
            at = at[at + length <= stop[at]]
            if not len(at):
                break
            keys = run_hashes(hashed, at, at + length)
            found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[found] == keys
            at, found = at[hit], found[hit]
            edges[length, at] = self.piece[found]
        return edges

    def _merge(self, edges: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First characters and ends of the pieces after merging, again and again, the two neighbours in each word that make
        the best piece, the leftmost of equally good ones."""
        start = np.arange(len(word))
        stop = start + 1

        def ranked(i: np.ndarray) -> np.ndarray:
            """Ranks of pieces i joined to their next ones."""
            out = np.full(len(i), _UNSEEN, np.int64)
            k = np.flatnonzero(i + 1 < len(start))
            k = k[word[i[k]] == word[i[k] + 1]]
            length = stop[i[k] + 1] - start[i[k]]
            k, length = k[length <= self.longest], length[length <= self.longest]
            piece = edges[length, start[i[k]]]
            out[k[piece >= 0]] = self.rank[piece[piece >= 0]]
            return out

        done, rank = [], ranked(start)
        while len(start):
            head = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat((rank << 32) | np.arange(len(rank)), head)
            live = best >> 32 < _UNSEEN
            stays = np.repeat(live, np.diff(np.append(head, len(word))))
            done.append((start[~stays], stop[~stays]))
            i = best[live] & 0xFFFFFFFF
            stop[i] = stop[i + 1]
            stays[i + 1] = False
            i = np.cumsum(stays)[i] - 1
            start, stop, word, rank = start[stays], stop[stays], word[stays], rank[stays]
            rank[i] = ranked(i)
            left = i[i > 0] - 1
            rank[left] = ranked(left)
        start, stop = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(start)
        return start[order], stop[order]

    def _best(self, edges: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First characters and ends of the pieces on the path with the largest sum of scores; a character without piece counts less than any."""
        unseen = self.score.min() - 10
        score = np.full((len(size), size.max() + 1), -np.inf)
        back = np.zeros(score.shape, np.int64)
        score[:, 0] = 0
        for end in range(1, score.shape[1]):
            row = np.flatnonzero(size >= end)
            for length in range(1, min(end, self.longest) + 1):
                piece = edges[length, begin[row] + end - length]
                step = np.where(piece >= 0, self.score[piece], unseen if length == 1 else -np.inf)
                way = score[row, end - length] + step
                better = way >= score[row, end]
                score[row[better], end], back[row[better], end] = way[better], length
        row, end, found = np.arange(len(size)), size.copy(), []
        while len(row):
            length = back[row, end]
            found.append((begin[row] + end - length, begin[row] + end))
            end = end - length
            row, end = row[end > 0], end[end > 0]
        start, stop = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(start)
        return start[order], stop[order]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        values, size = _characters(words)
        begin = np.cumsum(size) - size
        word = np.repeat(np.arange(len(size)), size)
        edges = self._edges(values, (begin + size)[word])
        start, stop = self._merge(edges, word) if self.kind == "bpe" else self._best(edges, begin, size)
        piece = edges[stop - start, start]
        # What is no piece is one character, written as its bytes or as unknown.
        other, number = np.unique(values[start[piece < 0]], return_inverse=True)
        spelled = [[self.byte_ids[b] for b in chr(c).encode()] if self.byte_ids else [self.unknown] for c in other.tolist()]
        flat = np.concatenate([self.id, np.array([i for x in spelled for i in x], np.uint32)])
        count, first = np.ones(len(piece), np.int64), piece.astype(np.int64)
        length = np.array([len(x) for x in spelled], np.int64)
        count[piece < 0] = length[number]
        first[piece < 0] = (len(self.id) + np.cumsum(length) - length)[number]
        return gather(flat, first, count), np.bincount(word[start], count, minlength=len(size)).astype(np.int64)


def _characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.array([len(w) for w in words], np.int64)


def _hashed(characters: np.ndarray) -> np.ndarray:
    return mix(characters.astype(np.uint64) + np.uint64(1))


def encode_words(spark: SparkSession, words: DataFrame, model: PieceModel, partitions: int | None = None) -> DataFrame:
    """(wid, ids) of words (wid, word): word neither null nor empty, spaces written as SPACE."""
    lattice = Lattice(model)

    def cut(batches):
        for batch in batches:
            ids, count = lattice(batch.column("word").to_pylist())
            ends = np.concatenate([[0], np.cumsum(count)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("wid"), lists], ["wid", "ids"])

    tasks = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = words.schema["wid"].dataType.simpleString()
    return words.select("wid", "word").repartition(tasks, "wid").mapInArrow(cut, f"wid {kind}, ids array<int>")


class LongWords:
    """Encodes a word of any length: merges by a heap, or one Viterbi pass."""

    def __init__(self, model: PieceModel) -> None:
        self.model, self.ranks = model, model.ranks()
        self.scores = {p: s for p, _, s in model.pieces}
        self.longest, self.unseen = model.longest, min(self.scores.values()) - 10

    def _merged(self, word: str) -> list[str]:
        import heapq

        parts: list[str | None] = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(self.ranks[word[i : i + 2]][0], i, 2) for i in range(len(parts) - 1) if word[i : i + 2] in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and parts[a] + parts[b] in self.ranks:
                    heapq.heappush(heap, (self.ranks[parts[a] + parts[b]][0], a, len(parts[a]) + len(parts[b])))
        return [p for p in parts if p is not None]

    def _best(self, word: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(word) + 1):
            ways = [
                (best[end - k] + s, k) for k in range(1, min(end, self.longest) + 1)
                if (s := self.scores.get(word[end - k : end], self.unseen if k == 1 else None)) is not None
            ]
            score, k = max(ways)
            best.append(score)
            back.append(k)
        end, out = len(word), []
        while end:
            out.append(word[end - back[end] : end])
            end -= back[end]
        return out[::-1]

    def __call__(self, word: str) -> list[int]:
        ids = []
        for part in self._merged(word) if self.model.kind == "bpe" else self._best(word):
            if part in self.ranks:
                ids.append(self.ranks[part][1])
            else:
                ids += [self.model.byte_ids[b] for b in part.encode()] if self.model.byte_ids else [self.model.unknown]
        return ids


# A line break, spaces with what follows them, or spaces at the end.
_WORD = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


def _read(table: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of the compressed texts, the number of each occurrence's word, occurrences per text."""
    known: dict[str, int] = {}
    numbers, counts = [], []
    for body in blocks.texts(table.column("packed"), table.column("size").to_pylist()):
        text = body.decode()
        found = _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []
        counts.append(len(found))
        numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in found), np.uint32, len(found)))
    number = np.concatenate(numbers) if numbers else np.empty(0, np.uint32)
    return list(known), number, np.array(counts, dtype=np.int64)


def _by_bucket(words: list[str], n: int) -> dict[int, np.ndarray]:
    """Words by bucket in alphabetical order, which does not depend on the order in which the rows of a block arrive."""
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.uint32)
    bucket = np.fromiter((zlib.crc32(words[i].encode()) % n for i in order), np.uint32, len(order))
    kept = np.argsort(bucket, kind="stable")
    order, bucket = order[kept], bucket[kept]
    first = np.flatnonzero(np.diff(bucket, prepend=np.uint32(n)))
    return dict(zip(bucket[first].tolist(), np.split(order, first[1:]), strict=True)) if len(first) else {}


def encode(docs: DataFrame, model: PieceModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit numbers), n_ids, text (of the row, null as empty) for every row.

    The ids are those of the model on the whole text, with its leading space; an empty text, or null, has none. Every row is a
    document; ids may be null or repeat. Other columns are not read, whatever their names.

    Blocks of texts, compressed, ask hash buckets for their distinct words; each word of the corpus is cut once, in its bucket (`Lattice`).
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    dealt, n = blocks.deal(plain, BLOCK_BYTES)
    dealt = dealt.select("doc_id", "block", F.octet_length("text").alias("size"), blocks.squeeze_texts(F.col("text")).alias("packed"))
    lattice = Lattice(model)

    def ask(table: pa.Table) -> pa.Table:
        words, _, _ = _read(table)
        by = _by_bucket(words, n)
        return pa.table({
            "bucket": pa.array(sorted(by), pa.int32()),
            "block": pa.array([table.column("block")[0].as_py()] * len(by), pa.int32()),
            "body": pa.array([blocks.squeeze(" ".join(words[i] for i in by[b]).encode(), 3) for b in sorted(by)], pa.binary()),
        })

    def reply(table: pa.Table) -> pa.Table:
        # Of the words that many blocks ask for, one copy is kept.
        at: dict[str, int] = {}
        asked = []
        for body in table.column("body"):
            words = blocks.unsqueeze(body.as_py()).decode().split(" ")
            asked.append(np.fromiter((at.setdefault(w, len(at)) for w in words), np.uint32, len(words)))
        words = list(at)
        del at
        flat, length = lattice(words)
        del words
        first = np.cumsum(length) - length
        bodies = []
        for mine in asked:
            body = length[mine].astype("<u4"), gather(flat, first[mine], length[mine]).astype("<u4")
            bodies.append(blocks.squeeze(np.array([len(mine)], np.uint32).tobytes() + b"".join(map(blocks.planes, body))))
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "body": pa.array(bodies, pa.binary())})

    def assemble(table: pa.Table, replies: pa.Table) -> pa.Table:
        schema = pa.schema([table.schema.field("doc_id"), ("ids", pa.binary()), ("n_ids", pa.int64()), ("text", pa.string())])
        if not len(table):
            return schema.empty_table()
        words, number, counts = _read(table)
        by = _by_bucket(words, n)
        length, flat, base = np.zeros(len(words), np.int64), [], 0
        first = np.zeros(len(words), np.int64)
        del words
        bodies = dict(zip(replies.column("bucket").to_pylist(), replies.column("body"), strict=True))
        for bucket, mine in by.items():
            body = blocks.unsqueeze(bodies[bucket].as_py())
            own = blocks.whole(body, "<u4", 4, len(mine)).astype(np.int64)
            length[mine] = own
            first[mine] = base + np.cumsum(own) - own
            flat.append(blocks.whole(body, "<u4", 4 + 4 * len(mine), len(body) // 4 - 1 - len(mine)))
            base += int(own.sum())
        del by, bodies
        ends = np.concatenate([[0], np.cumsum(counts)])
        cut = np.concatenate([[0], np.cumsum(length[number])])[ends]
        ids = np.empty(int(cut[-1]), dtype="<u4")
        gather_into(ids, np.concatenate(flat) if flat else ids, first, length, number)
        del flat, number
        return pa.table({
            "doc_id": table.column("doc_id"),
            "ids": pa.Array.from_buffers(pa.large_binary(), len(table), [None, pa.py_buffer(4 * cut), pa.py_buffer(ids)]).cast(pa.binary()),
            "n_ids": np.diff(cut), "text": blocks.joined_texts(table.column("packed"), table.column("size").to_pylist()),
        }, schema=schema)

    asked = dealt.groupBy("block").applyInArrow(ask, blocks.PACKED)
    answers = asked.groupBy("bucket").applyInArrow(reply, blocks.PACKED)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        assemble, f"doc_id {kind}, ids binary, n_ids bigint, text string"
    )


def decode(ids: Column, model: PieceModel) -> Column:
    """Text of ids as `encode` writes them: the pieces one behind the other, without the leading space; null for null.
    Bytes that are no UTF-8 become replacement characters, as does nothing that `encode` made."""
    spelled = np.frombuffer(b"".join(model.spelled), np.uint8)
    length = np.array([len(s) for s in model.spelled], dtype=np.int64)
    first = np.cumsum(length) - length

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        out = []
        for value in column:
            if not value.is_valid:
                out.append(None)
                continue
            found = np.frombuffer(value.as_buffer(), "<u4").astype(np.int64)
            whole = gather(spelled, first[found], length[found]).tobytes()
            out.append(whole.removeprefix(b" ").decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return text(ids)
