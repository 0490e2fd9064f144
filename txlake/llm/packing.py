"""Pack documents into token sequences next to their lexical neighbours."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm import blocks, vocabulary
from txlake.llm.batches import distinct, mix, run_hashes

BLOCK_BYTES = 4 << 20
K1, B = 1.2, 0.75
MARK = "\x01"  # stands between words that are encoded together
TOGETHER = 128  # so many words are encoded in one text
FIRST = 32  # so many neighbours are sorted at first
DROP = 4  # the index drops used rows when they are one in so many
PARTS = 4  # so many groups of documents under one key fill a shard


class Index:
    """BM25 weights of the words of a shard's documents, by word; idf counts the documents of the whole corpus. Words that
    many rows hold have their weights for all rows side by side, so that long postings are added without being gathered."""

    def __init__(self, word, row, count, holders, total, length, mean) -> None:
        idf = np.log1p((total - holders + 0.5) / (holders + 0.5))
        norm = K1 * (1 - B + B * length / max(mean, 1.0))
        self.weight = idf[word] * count * (K1 + 1) / (count + norm[row])
        self.row, self.rows = row, len(length)
        self.kept = np.arange(self.rows)  # rows that can still be found; `row` and `wide` know them by their places here
        self.edges = np.searchsorted(word, np.arange(len(holders) + 1))
        held = np.diff(self.edges)
        often = held >= max(2, self.rows // 8)
        place = np.cumsum(often) - 1
        at = often[word]
        self.wide = np.zeros((int(often.sum()), self.rows))
        self.wide[place[word[at]], row[at]] = self.weight[at]
        # A word that no other row holds finds nothing.
        self.often = self._by_row(place[word[at]], row[at])
        at = (held[word] >= 2) & ~at
        self.seldom = self._by_row(word[at], row[at])

    def _by_row(self, word: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
        # Sorted as one number, which is much faster than by places.
        bits = len(self.edges).bit_length()
        pairs = np.sort(row << bits | word)
        word, edges = pairs & ((1 << bits) - 1), np.searchsorted(pairs >> bits, np.arange(self.rows + 1)).tolist()
        return [word[a:z] for a, z in zip(edges, edges[1:], strict=False)]

    def keep(self, rows: np.ndarray) -> None:
        """Find these rows only from now on; the others may still ask."""
        stay = rows[self.kept]
        self.kept, self.wide = self.kept[stay], np.compress(stay, self.wide, axis=1)
        at = stay[self.row]
        self.row, self.weight = (np.cumsum(stay) - 1)[self.row[at]], self.weight[at]
        self.edges = np.concatenate([[0], np.cumsum(at)])[self.edges]

    def neighbours(self, row: int, unused: np.ndarray) -> np.ndarray:
        """Unused rows that share a word with a row, the best first; all its words count."""
        return np.fromiter(self.nearest(row, unused), np.int64)

    def nearest(self, row: int, unused: np.ndarray) -> Iterator[int]:
        """`neighbours` one by one, of the rows that are unused at the first."""
        words = self.seldom[row]
        score = self.wide[self.often[row]].sum(axis=0)
        if len(words):
            begin = self.edges[words]
            at = vocabulary.places(begin, self.edges[words + 1] - begin)
            score += np.bincount(self.row[at], self.weight[at], minlength=len(score))
        found = np.flatnonzero(unused[self.kept] & (score > 0))
        score, found = score[found], self.kept[found]
        # Few neighbours fill a window; what is left is sorted when they do not.
        if len(found) > 4 * FIRST:
            best = score >= np.partition(score, len(found) - FIRST)[len(found) - FIRST]
            yield from found[best][np.argsort(-score[best], kind="stable")].tolist()
            score, found = score[~best], found[~best]
        yield from found[np.argsort(-score, kind="stable")].tolist()


def shard_of(
    word: np.ndarray, row: np.ndarray, hashes: np.ndarray, holders: np.ndarray, seed: np.ndarray, total: int, n: int
) -> np.ndarray:
    """Shard of each row, by one of its words: rows whose words are alike often get the same.

    The word is the first in a random order of the corpus's words in which rare words tend to be early, among those that 2
    to `total` / (PARTS n) documents hold. A row without such words takes its rarest that others hold, whose documents are
    spread by their seeds over as many shards as that count asks for; a row that shares no word goes by its seed.
    """
    most = max(2.0, total / (PARTS * n))
    held = holders.astype(np.float64)
    idf = np.log1p((total - held + 0.5) / (held + 0.5))
    early = -np.log((hashes.astype(np.float64) + 1) / 2.0**64) / idf
    rank = np.where(held < 2, np.inf, np.where(held <= most, early, 1e9 + held))[word]
    best = np.full(len(seed), np.inf)
    np.minimum.at(best, row, rank)
    first = np.flatnonzero(np.isfinite(rank) & (rank == best[row]))
    least = np.full(len(seed), np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, row[first], hashes[word[first]])
    first = first[hashes[word[first]] == least[row[first]]]
    place = seed.astype(np.int64).view(np.uint64).copy()
    own, key = row[first], word[first]
    parts = np.ceil(held[key] / most).astype(np.uint64)
    place[own] = hashes[key] + place[own] % parts
    return (mix(place) % np.uint64(n)).astype(np.int32)


def terms(ids: np.ndarray, length: np.ndarray, tags: np.ndarray, step: int = 1 << 14) -> np.ndarray:
    """Numbers of words, given by the ids of all of them one behind the other and a tag each: equal ones have the same.
    Some words at a time, so that their hashing needs little memory."""
    end = np.cumsum(length, dtype=np.int64)
    hashes = np.empty(len(length), dtype=np.uint64)
    most = int(ids.max(initial=0)) + 1
    table = mix(np.arange(1, most + 1, dtype=np.uint64)) if most <= len(ids) else None
    for i in range(0, len(length), step):
        part = slice(i, i + step)
        begin = end[part] - length[part]
        some = ids[begin[0] : end[part][-1]]
        values = mix(some.astype(np.uint64) + np.uint64(1)) if table is None else table.take(some)
        hashes[part] = mix(run_hashes(values, begin - begin[0], end[part] - begin[0]) + tags[part].astype(np.uint64))
    return distinct(hashes)[1]


def write_planes(numbers: np.ndarray) -> list[bytes]:
    """The lowest bytes of all numbers, then the next ones, as far as some number has them."""
    wide = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return [(numbers >> numbers.dtype.type(8 * i)).astype(np.uint8).tobytes() for i in range(wide)]


def write_bodies(
    found: vocabulary.BlockWords, rows: int, holders: np.ndarray, ids: np.ndarray, begin: np.ndarray, length: np.ndarray, apart: bool,
    postings: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Different words, words, and a body for each row: how many bytes a number takes in each part; holders of the different words in
    the order of their `terms`, tag and number of ids of every word, and the ids."""
    tags = (found.hashes & np.uint64(0xFF if apart else 0xFFFFFFFF)).astype("<u4")
    if apart and len(tags):
        tags[np.maximum.reduceat(found.data, found.begin) < 128] = 0
    term = terms(vocabulary.gather(ids, begin, length), length, tags) if len(tags) else tags
    word, row, _ = postings or found.postings(rows)
    pair_row, pair_term, _ = vocabulary.counted_pairs(row, term[word], len(term))
    of_term = np.zeros(len(term), dtype="<u4")
    of_term[term] = holders
    held, tag, size = of_term[pair_term], tags[found.number], length.astype("<u4")[found.number]
    edges = np.searchsorted(pair_row, np.arange(rows + 1))
    places = np.searchsorted(found.rows, np.arange(rows + 1))
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    flat = np.empty(int(ends[-1]), dtype="<u2" if ids.max(initial=0) < 1 << 16 else "<u4")
    vocabulary.gather_into(flat, ids.astype(flat.dtype), begin, length, found.number)
    held, tag, size, flat = (write_planes(x) for x in (held, tag, size, flat))
    wide = bytes(map(len, (held, tag, size, flat)))
    bodies = [
        blocks.squeeze(b"".join([wide, *[p[a:z] for p in held], *[p[i:j] for x in (tag, size) for p in x], *[p[k:m] for p in flat]]))
        for a, z, i, j, k, m in zip(*(x.tolist() for e in (edges, places, ends[places]) for x in (e[:-1], e[1:])), strict=True)
    ]
    return np.diff(edges), np.diff(places), bodies


def read_bodies(bodies: list[bytes], words: np.ndarray, places: np.ndarray):
    """(word, row, count) for each different word of a row, by row; holders of each word, ids of each row, all ids."""
    wide = np.frombuffer(b"".join([b[:4] for b in bodies]), np.uint8).reshape(-1, 4).astype(np.int64)
    sizes = np.stack([words, places, places, np.zeros_like(words)], axis=1).astype(np.int64)
    sizes[:, 3] = (np.array([len(b) for b in bodies], dtype=np.int64) - 4 - (wide * sizes).sum(axis=1)) // wide[:, 3]
    n_ids = sizes[:, 3]
    # The planes of all rows are put one behind the other before numbers are made of them; a plane that a row has not is zero.
    parts: list[list[list[bytes]]] = [[[] for _ in range(w)] for w in wide.max(axis=0, initial=1).tolist()]
    zeros = bytes(int(sizes.max(initial=0)))
    for b, own, size in zip(bodies, wide.tolist(), sizes.tolist(), strict=True):
        at = 4
        for part, w, k in zip(parts, own, size, strict=True):
            for plane in part[:w]:
                plane.append(b[at : at + k])
                at += k
            for plane in part[w:]:
                plane.append(zeros[:k])
    held, tags, length, flat = (read_planes(part) for part in parts)
    term = terms(flat, length, tags) if len(tags) else tags
    many = int(term.max(initial=0)) + 1
    row, word, count = vocabulary.counted_pairs(np.repeat(np.arange(len(bodies)), places), term, many)
    holders = np.ones(many)
    holders[word] = held
    return word, row, count, holders, n_ids, flat


def read_planes(planes: list[list[bytes]]) -> np.ndarray:
    numbers = np.frombuffer(b"".join(planes[0]), np.uint8).astype("<u4")
    for i, plane in enumerate(planes[1:], 1):
        numbers |= np.frombuffer(b"".join(plane), np.uint8).astype("<u4") << np.uint32(8 * i)
    return numbers


def fill_windows(index: Index, sizes: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """(row, start, length, sequence, offset): each seed's window takes its best unused neighbours until it is
    full. A document that does not fit is cut; what is left begins the next window and is its seed. Only the last window is short."""
    pieces = []
    unused = np.ones(len(sizes), dtype=bool)
    sequence, used = 0, 0
    taken = 0  # since the index dropped used documents

    def place(row: int) -> bool:
        """Whether the document was cut, so that a new window began with its rest."""
        nonlocal sequence, used
        start, cut = 0, False
        while start < sizes[row]:
            if used == window:
                sequence, used, cut = sequence + 1, 0, start > 0 or cut
            length = min(window - used, int(sizes[row]) - start)
            pieces.append((row, start, length, sequence, used))
            start, used = start + length, used + length
        return cut

    for seed in range(len(sizes)):
        if not unused[seed]:
            continue
        unused[seed], taken = False, taken + 1
        place(seed)
        while used < window:
            if DROP * taken > len(index.kept):
                index.keep(unused)
                taken = 0
            cut = False
            for row in index.nearest(seed, unused):
                unused[row], taken = False, taken + 1
                cut = place(row)
                if cut or used == window:
                    break
            if not cut:
                break
            seed = row
    return pieces


def encode_together(library, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one behind the other, and how many each has; many words go to the library in one text."""
    fast = functools.partial(library.encode_batch_fast, add_special_tokens=False)
    mark = fast([MARK])[0].ids
    flat, length = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for i in range(0, len(words), TOGETHER):
        some = words[i : i + TOGETHER]
        ids = np.array(fast([f" {MARK} ".join([*some, ""])])[0].ids, np.uint32)
        inside = ids != mark[0] if len(mark) == 1 else np.ones(len(ids), dtype=bool)
        ends = np.flatnonzero(~inside)
        if len(ends) == len(some):
            flat.append(ids[inside])
            ends[1:] -= ends[:-1] + 1
            length.append(ends)
        else:  # a word holds the mark's id, or the mark has none of its own
            single = [e.ids for e in fast(some)]
            flat.append(np.array([i for x in single for i in x], np.uint32))
            length.append(np.array([len(x) for x in single], np.int64))
    return np.concatenate(flat), np.concatenate(length)


def last_ids(told: dict) -> np.ndarray | None:
    """By id, whether its token ends a piece of the pre-tokenizer, as told by a suffix of tokens in a file of the tokenizers library."""
    model = told["model"]
    suffix = model.get("end_of_word_suffix") if model.get("type") == "BPE" else None
    if not suffix:
        return None
    vocab = model["vocab"]
    last = np.zeros(max([*vocab.values(), *[t["id"] for t in told.get("added_tokens") or []]], default=0) + 1, dtype=bool)
    last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
    return last


def encode_letters(library, words: list[str], last: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """`encode_together` for words that are one piece of the pre-tokenizer each, which need no mark between them."""
    flat, length = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for i in range(0, len(words), TOGETHER):
        some = words[i : i + TOGETHER]
        ids = np.array(library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(last[ids]) + 1
        if len(ends) == len(some) and ends[-1] == len(ids):
            ends[1:] -= ends[:-1].copy()
        else:  # some are several pieces, or none
            ids, ends = encode_together(library, some)
        flat.append(ids)
        length.append(ends)
    return np.concatenate(flat), np.concatenate(length)


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1,
    fold: bool = True, apart: bool = True, tails: bool = True,
) -> DataFrame:
    """doc_id, start, length, ids (the piece's ids as little-endian unsigned 32-bit numbers), doc_tokens, sequence_id,
    offset: the pieces into which documents are cut, and their places in sequences of `window` ids.

    A document is the ids of its text, without special ones, and `end_id`; null text is empty. Each id lies in one piece.
    Every row is a document, ids may be null or repeat. Sequences have no gaps; only the last one of a shard is shorter.
    Other columns are not read, whatever their names. An empty table gives no rows.

    `tokenizer` is a file of the tokenizers library, the same on all executors, whose pre-tokenizer never joins words across
    white space; with `fold` it must treat A-Z as a-z, with `apart` it must give different words of ASCII characters different ids,
    as byte-level ones do; with `tails` it must cut a word between a letter or digit and the ASCII punctuation at the word's end, so that
    the two are encoded apart, and often known from other words, and never drop or cut a stretch of letters. Distinct words are encoded once for the corpus, asked for by blocks of about BLOCK_BYTES. Then documents,
    as ids and how many documents hold each word, are dealt to as many shards by one of their words that others hold too
    (`shard_of`), and neighbours are looked for in the index of the shard; those in other shards are not found. A shard knows a word
    by its ids and a tag: 32 bits of its hash, with `apart` 8 bits of those of words with other characters only.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    n, total, size = blocks.count_blocks(plain, BLOCK_BYTES)
    mean = size / max(1, total)
    # The order of seeds does not depend on the order in which rows arrive, so a task that runs again packs alike.
    dealt = plain.withColumn("seed", F.xxhash64("doc_id", F.xxhash64("text"))).select(
        "doc_id", "seed", F.pmod("seed", F.lit(n)).cast("int").alias("block"),
        F.octet_length("text").cast("bigint").alias("octets"), blocks.squeeze_texts(F.col("text")).alias("packed"),
    )

    def read(table: pa.Table) -> vocabulary.BlockWords:
        texts = list(blocks.texts(table.column("packed"), table.column("octets").to_pylist()))
        return vocabulary.BlockWords.read(pa.chunked_array([pa.array(texts, pa.binary()).view(pa.string())]), fold)

    def ask(table: pa.Table) -> pa.Table:
        found = read(table)
        word, _, _ = found.postings(len(table))
        return vocabulary.ask(table.column("block")[0].as_py(), found, np.bincount(word, minlength=len(found.hashes)), n)

    loaded = []

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one behind the other, and how many each has."""
        # Spark runs one task per core; threads of the library's own would only cost memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not loaded:
            with open(tokenizer, encoding="utf-8") as file:
                told = json.load(file)
            loaded.extend([Tokenizer.from_file(tokenizer), told.get("added_tokens") or [], last_ids(told)])
        library, added, last = loaded
        spelled = " ".join(words)
        # A token that was added to the model is one wherever it stands, so words that hold some are not cut.
        if not tails or MARK in spelled or any(t["normalized"] or t["content"] in spelled for t in added):
            return encode_together(library, words)
        parts, known, letters = vocabulary.cut_tails(words)
        # The last part is empty.
        letters = letters[:-1] & (last is not None)
        others, letters = np.flatnonzero(~letters), np.flatnonzero(letters)
        (flat, some), (more, rest) = (
            encode_together(library, [known[i] for i in others.tolist()]), encode_letters(library, [known[i] for i in letters.tolist()], last)
        )
        flat, length = np.concatenate([flat, more]), np.concatenate([some, rest, [0]])
        rank = np.empty(len(known), dtype=np.int64)
        rank[np.concatenate([others, letters, [len(known) - 1]])] = np.arange(len(known))
        parts = rank[parts]
        first, own = np.cumsum(length) - length, length[parts]
        return vocabulary.gather(flat, first[parts.ravel()], own.ravel()), own.sum(axis=1)

    def place(table: pa.Table, replies: pa.Table) -> pa.Table:
        """Documents with their shards; a body has the holders of the different words, tag and number of ids of every word, and the ids."""
        schema = pa.schema([
            table.schema.field("doc_id"), ("seed", pa.int64()), ("octets", pa.int64()), ("shard", pa.int32()),
            ("n_words", pa.int32()), ("n_places", pa.int32()), ("body", pa.binary()),
        ])
        if not len(table):
            return schema.empty_table()
        rows = len(table)
        found = read(table)
        holders, ids, begin, length = vocabulary.answers(replies, found, n)
        word, row, _ = postings = found.postings(rows)
        seed = table.column("seed").to_numpy()
        shard = shard_of(word, row, found.hashes, holders, seed, total, n)
        words, places, bodies = write_bodies(found, rows, holders, ids, begin, length, apart, postings)
        return pa.table({
            "doc_id": table.column("doc_id"), "seed": seed, "octets": table.column("octets"), "shard": shard,
            "n_words": words.astype(np.int32), "n_places": places.astype(np.int32), "body": pa.array(bodies, pa.binary()),
        }, schema=schema)

    def pack(table: pa.Table) -> pa.Table:
        schema = pa.schema([
            table.schema.field("doc_id"), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ])
        table = table.sort_by("seed")
        rows = len(table)
        bodies = [blocks.unsqueeze(b) for b in table.column("body").to_pylist()]
        word, row, count, holders, n_ids, flat = read_bodies(bodies, table.column("n_words").to_numpy(), table.column("n_places").to_numpy())
        del bodies
        order = np.flatnonzero(holders[word] >= 2)
        order = order[np.argsort(word[order] * rows + row[order])]
        octets = table.column("octets").to_numpy().astype(np.float64)
        index = Index(word[order], row[order], count[order].astype(np.float64), holders, total, octets, mean)
        # Ids of all documents one behind the other, each with its end.
        sizes = n_ids + 1
        first = np.cumsum(sizes) - sizes
        flat = np.insert(flat, np.cumsum(n_ids), np.uint32(end_id)).astype("<u4", copy=False)
        pieces = np.array(fill_windows(index, sizes, window), dtype=np.int64)
        at = first[pieces[:, 0]] + pieces[:, 1]
        shard = int(table.column("shard")[0].as_py())
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(pieces[:, 0])),
            "start": pieces[:, 1], "length": pieces[:, 2],
            "ids": pa.array([flat[a : a + k].tobytes() for a, k in zip(at, pieces[:, 2], strict=True)], pa.binary()),
            "doc_tokens": sizes[pieces[:, 0]], "sequence_id": (shard << 32) + pieces[:, 3], "offset": pieces[:, 4],
        }, schema=schema)

    asked = dealt.groupBy("block").applyInArrow(ask, blocks.PACKED)
    replies = vocabulary.encode_words(asked, encode, fold)
    placed = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        place, f"doc_id {kind}, seed bigint, octets bigint, shard int, n_words int, n_places int, body binary"
    )
    return placed.groupBy("shard").applyInArrow(
        pack,
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
