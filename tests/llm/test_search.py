"""Ranked search against scores computed one by one, and on odd rows."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.compare import difference
from tests.llm.conftest import fold_ascii
from txlake.llm import ranked_search
from txlake.llm.queries import ORACLES, QUERIES


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold_ascii(text or ""))


def _ranked(docs, items, k=10):
    held = [(doc_id, Counter(_terms(text))) for doc_id, text in docs]
    held = [(doc_id, c) for doc_id, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in Counter(_terms(text)).items() if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if null else doc_id, -s) for rank, (s, null, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def _found(df):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


def test_query(spark, sf_dir, duck):
    df = QUERIES["op13_ranked_search"](spark, sf_dir)
    assert dict(df.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert difference(df, duck, ORACLES["op13_ranked_search"]) is None


def _made(rnd, n, words):
    return " ".join(rnd.choice(words) for _ in range(rnd.randrange(n)))


def test_equals_scores_of_all_documents(spark, monkeypatch):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["é", "B", "b", "x1"]
    docs = [(i % 270, _made(rnd, 30, words)) for i in range(300)] + [(None, "w1 w2"), (None, "w1 w2"), (5, None)] + [(1000 + i, "w3 w4 w4") for i in range(40)]
    # More than 64 terms make masks of several words; repeated terms, items and ids; an item longer than a block.
    items = [(i, _made(rnd, 12, words)) for i in range(30)] + [(30, " ".join(words * 2)), (30, "w3, w4; w3"), (31, "w3, w4; w3"), (32, None), (33, "-!"), (34, "none"), (None, "w1")]
    many = [(40, " ".join(f"w{i}" for i in range(100)))]
    docs += [(2000 + i, " ".join(f"w{rnd.randrange(100)}" for _ in range(80))) for i in range(60)]
    expected = _ranked(docs, items + many, 7)
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    right = spark.createDataFrame(items + many, "item_id long, text string")
    assert _found(ranked_search.search(left, right, 7)) == expected
    monkeypatch.setattr(ranked_search, "CELLS", 64)
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 300)
    assert _found(ranked_search.search(left, right, 7)) == expected


def test_masks_below_the_best_are_not_scored(monkeypatch):
    """Documents with common terms only are grouped, but their scores are not added up."""
    import numpy as np
    import pyarrow as pa

    from txlake.llm.batches import text_blocks

    texts = ["rare common"] * 12 + ["common"] * 3000 + ["common other"] * 3000
    items = ranked_search.Items.read(["rare common"])
    scored = []
    add = ranked_search.Best.add
    monkeypatch.setattr(ranked_search.Best, "add", lambda self, i, s, *a: (scored.append(len(s)), add(self, i, s, *a)))
    ((_, block, starts),) = text_blocks(pa.array(texts))
    found = ranked_search.Postings.read(block, starts, items.hashes)
    best = ranked_search.Best.of(10, 1)
    ids = np.arange(len(texts))
    holders = np.bincount(found.term)
    weights = np.floor(1000 * np.log((2 * len(texts) + 2) / (2 * holders + 1))).astype(np.int64)
    ranked_search._search_block(items, weights, found, np.full(len(texts), 100), ids, ids < 0, best)
    assert best.ids[0].tolist() == list(range(10)) and sum(scored) == 12


def test_odd_rows(odd, odd_rows, nothing, spark):
    items = odd.select(F.col("doc_id").alias("item_id"), "text", F.lit("x").alias("score"), F.lit("x").alias("number"), F.lit("x").alias("term"))
    expected = _ranked(odd_rows, odd_rows)
    assert _found(ranked_search.search(odd.withColumn("rank", F.lit("x")), items)) == expected
    assert ranked_search.search(nothing, items).count() == 0
    assert ranked_search.search(odd, items.limit(0)).count() == 0
    assert ranked_search.search(odd, items.filter("text is null")).columns == ["item_id", "rank", "doc_id", "score"]
