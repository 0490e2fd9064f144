"""Periodic runs against all periods tried one by one, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import LONG
from txlake.llm import periodic_runs
from txlake.llm.queries import QUERIES


def _runs(words, least=12):
    """Every stretch that repeats with a period, longest first; kept when no smaller period fits it."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        begin = None
        for i, x in enumerate(same):
            if x and begin is None:
                begin = i
            elif not x and begin is not None:
                length = i - begin + q
                if length >= max(least, 2 * q):
                    stretch = words[begin : begin + length]
                    if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                        found.append((begin, length, q))
                begin = None
    return sorted(found)


def _collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    rnd = random.Random(7)
    for _ in range(600):
        texts = []
        for _ in range(rnd.randrange(1, 4)):
            n, k = rnd.randrange(0, 70), rnd.choice([1, 2, 3, 6])
            words = [rnd.choice(["a", "b", "é", "A", "bb", "ab"][:k]) for _ in range(n)]
            if n and rnd.random() < 0.5:
                a = rnd.randrange(n)
                p = 1 + (n - a) // rnd.randrange(2, 9)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        least = rnd.choice([2, 5, 12])
        found = periodic_runs._found(pa.array([rnd.choice([" ", "\n", " \t"]).join(t) for t in texts]), least).to_pylist()
        for words, got in zip(texts, found, strict=True):
            runs = _runs(words, least)
            assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == runs
            assert got["n_words"] == len(words) and got["collapsed"] == _collapsed(words, runs)


def test_each_square_that_branches_is_found():
    rnd = random.Random(11)
    for _ in range(200):
        text = [rnd.randrange(2) for _ in range(rnd.randrange(2, 40))]
        expected = {
            (i, q) for q in range(1, len(text) // 2 + 1) for i in range(len(text) - 2 * q + 1)
            if text[i : i + q] == text[i + q : i + 2 * q] and (i + 2 * q == len(text) or text[i + 2 * q] != text[i + q])
        }
        start, root = periodic_runs.branching_squares(np.array(text, dtype=np.int64))
        assert sorted(zip(start.tolist(), root.tolist(), strict=True)) == sorted(expected)


def test_small_steps_find_the_same(monkeypatch):
    rnd = random.Random(5)
    text = np.array([rnd.randrange(3) for _ in range(500)], dtype=np.int64)
    whole = periodic_runs.runs(text, 4)
    monkeypatch.setattr(periodic_runs, "STEP", 7)
    assert periodic_runs.runs(text, 4) == whole


def test_query(spark, sf_dir, texts):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    with_runs = 0
    for doc_id, text in texts.items():
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:  # trying all periods takes the square of the length
            continue
        runs = _runs(words)
        with_runs += bool(runs)
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(_collapsed(words, runs).encode()).hexdigest()
    assert with_runs >= 10


def test_odd_rows(odd, odd_rows, nothing, spark):
    found = periodic_runs.find_runs(F.col("text")).alias("f")
    rows = odd.select("doc_id", "text", found).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        words = re.findall("[^\x20\x09-\x0d]+", r.text or "")
        assert r.f.n_words == len(words)
        if len(words) < 1000:
            assert r.f.runs == [] and r.f.collapsed == " ".join(words)
        else:
            assert r.text == LONG and r.f.collapsed == " ".join(words)  # line numbers differ
    assert nothing.select(found).count() == 0
    # One long run, and squares of every multiple of its period at its end.
    long = spark.createDataFrame([("x " * 200_000,), ("a b c " * 50_000,)], "text string").select(found).collect()
    assert [[tuple(x) for x in r.f.runs] for r in long] == [[(0, 200_000, 1)], [(0, 150_000, 3)]]
    assert [r.f.collapsed for r in long] == ["x", "a b c"]
