"""Licence notices against plain regular expressions, expressions against a recursive reading, and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import fold_ascii
from txlake.llm import license_scan
from txlake.llm.queries import QUERIES


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold_ascii(text or ""))


def _places(words, phrases):
    joined = [p.split() for p in phrases]
    return [(i, p) for i in range(len(words)) for p, parts in zip(phrases, joined, strict=True) if words[i : i + len(parts)] == parts]


PHRASES = {**license_scan.BASE_PHRASES, **license_scan.OWN_PHRASES}


def test_query(spark, sf_dir, texts):
    got = {r.doc_id: r for r in QUERIES["op12_license_scan"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        words, r = _words(text), got[doc_id]
        base = _places(words, list(license_scan.BASE_PHRASES))
        places = _places(words, list(PHRASES))
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({license_scan.BASE_PHRASES[p] for _, p in base}))
        assert r.labels == ",".join(sorted({PHRASES[p] for _, p in places}))
        assert r.score == 1 - 0.5 ** len(places)
    assert sum(r.n_base > 0 for r in got.values()) >= 3


def test_automaton_equals_search():
    parts = sorted({w for p in PHRASES for w in p.split()} | {"x", "é", "by", "cc"})
    rnd = random.Random(2)
    scanner = license_scan.Scanner(license_scan.BASE_PHRASES, license_scan.OWN_PHRASES, license_scan.TAGS)
    import pyarrow as pa

    texts = []
    for _ in range(2000):
        words = []
        for _ in range(rnd.randrange(8)):
            words += rnd.choice(list(PHRASES)).split()[: rnd.randrange(1, 9)] if rnd.random() < 0.6 else [rnd.choice(parts)]
        texts.append("".join(rnd.choice([w, w.upper(), w.title()]) + rnd.choice([" ", "\n", "-", ". ", "_", "\x00"]) for w in words))
    for text, got in zip(texts, scanner(pa.array(texts)).to_pylist(), strict=True):
        words = _words(text)
        assert got["n_words"] == len(words)
        assert [(n["word"], n["phrase"]) for n in got["notices"]] == _places(words, list(PHRASES))


def _read(tokens):
    """Recursive reading of a well formed expression: (labels, chosen, strength) of its alternatives and parts."""

    def either(i):
        left, i = both(i)
        while i < len(tokens) and tokens[i] == "or":
            right, i = both(i + 1)
            milder = right if right[2] < left[2] else left
            left = (left[0] | right[0], milder[1], milder[2])
        return left, i

    def both(i):
        left, i = single(i)
        while i < len(tokens) and tokens[i] == "and":
            right, i = single(i + 1)
            left = (left[0] | right[0], left[1] | right[1], max(left[2], right[2]))
        return left, i

    def single(i):
        if tokens[i] == "(":
            inner, i = either(i + 1)
            return inner, i + 1
        terms = license_scan.identifier(tokens[i])
        out = (terms.labels, terms.chosen, terms.strength)
        if i + 1 < len(tokens) and tokens[i + 1] == "with":
            return (*out[:2], 1 if out[2] == 2 and tokens[i + 2] in license_scan.LINKING else out[2]), i + 3
        return out, i + 1

    return either(0)[0]


def test_expressions_equal_a_recursive_reading():
    rnd = random.Random(4)
    names = ["mit", "apache-2.0", "gpl-2.0-only", "gpl-3.0+", "lgpl-2.1-or-later", "agpl-3.0", "mpl-2.0", "strange-1.0", "cc-by-sa-4.0"]

    def made(depth):
        kind = rnd.random()
        if depth == 0 or kind < 0.3:
            name = rnd.choice(names)
            return [name, "with", rnd.choice(["classpath-exception-2.0", "other-exception"])] if rnd.random() < 0.3 else [name]
        if kind < 0.45:
            return ["(", *made(depth - 1), ")"]
        return [*made(depth - 1), rnd.choice(["and", "or"]), *made(depth - 1)]

    for _ in range(2000):
        tokens = made(4)
        text, terms = license_scan.evaluate(" " + " ".join(rnd.choice([t, t.upper()]) for t in tokens))
        assert text.lower().split() == tokens
        assert (terms.labels, terms.chosen, terms.strength) == _read(tokens)


@pytest.mark.parametrize(
    ("line", "expression", "chosen", "strength"),
    [
        ("SPDX-License-Identifier: MIT OR Apache-2.0 */", "MIT OR Apache-2.0", ["mit"], 0),
        ("// spdx-license-identifier :GPL-2.0 WITH Classpath-exception-2.0.", "GPL-2.0 WITH Classpath-exception-2.0", ["gpl"], 1),
        ("License-Expression: (MIT OR GPL-2.0-only) AND AGPL-3.0", "(MIT OR GPL-2.0-only) AND AGPL-3.0", ["agpl", "mit"], 3),
        ("SPDX-License-Identifier: MIT. See the file", "MIT", ["mit"], 0),
        ("SPDX-License-Identifier: (MIT", "(MIT", [], None),
        ("SPDX-License-Identifier: MIT AND", "MIT AND", [], None),
        ("SPDX-License-Identifier: GPL-2.0 WITH x WITH y", "GPL-2.0 WITH x WITH y", [], None),
        ("SPDX-License-Identifier: " + "(" * 3000 + "MIT" + ")" * 3000, "(" * 3000 + "MIT" + ")" * 3000, ["mit"], 0),
        ("SPDX-License-Identifier MIT", None, None, None),
        ("SPDX-License-Identifier:\nMIT", None, None, None),
    ],
)
def test_tags(spark, line, expression, chosen, strength):
    found = spark.createDataFrame([("über alles\n" + line + "\nend",)], "text string").select(license_scan.find_licenses(F.col("text")).alias("f"))
    expressions = found.first().f.expressions
    if expression is None:
        assert expressions == []
    else:
        (e,) = expressions
        assert (e.word, e.expression, e.chosen, e.strength) == (2, expression, chosen, strength)


def test_odd_rows(odd, odd_rows, nothing, spark):
    found = license_scan.find_licenses(F.col("text")).alias("f")
    rows = odd.select("text", found).collect()
    assert len(rows) == len(odd_rows)
    assert all(r.f.n_words == len(_words(r.text)) and r.f.notices == [] and r.f.expressions == [] for r in rows)
    assert nothing.select(found).count() == 0
    # Repeated rows are judged alike; overlapping notices all count, by place and then by list.
    twice = spark.createDataFrame([("CC-BY-SA, cc by sa",)] * 2, "text string").select(found).collect()
    assert [[(n.word, n.label) for n in r.f.notices] for r in twice] == [[(0, "cc-by"), (0, "cc-by-sa"), (3, "cc-by"), (3, "cc-by-sa")]] * 2
