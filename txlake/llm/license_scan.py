"""Licence notices: an Aho-Corasick automaton over words finds phrases and tags, a shunting yard evaluates expressions."""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.llm.batches import text_blocks
from txlake.llm.terms import placed_terms, term_hashes

# Phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
OWN_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "apache software license": "apache",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "boost software license": "boost",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
# A colon and a licence expression follow these.
TAGS = ("spdx license identifier", "license expression", "packagelicensedeclared", "packagelicenseconcluded")

# Families of licence identifiers, their label, and what they ask for: 0 notices, 1 sources of changed files,
# 2 sources of the whole work, 3 also from those who offer it as a service.
FAMILIES = {
    "0bsd": ("bsd", 0), "bsd-2-clause": ("bsd", 0), "bsd-3-clause": ("bsd", 0), "bsd-4-clause": ("bsd", 0),
    "mit": ("mit", 0), "mit-0": ("mit", 0), "x11": ("mit", 0), "isc": ("isc", 0), "apache": ("apache", 0),
    "zlib": ("zlib", 0), "bsl": ("boost", 0), "psf": ("psf", 0), "python": ("psf", 0), "postgresql": ("postgresql", 0),
    "ncsa": ("ncsa", 0), "unlicense": ("unlicense", 0), "wtfpl": ("wtfpl", 0), "cc0": ("cc0", 0), "cc-by": ("cc-by", 0),
    "artistic": ("artistic", 0), "mpl": ("mpl", 1), "epl": ("epl", 1), "cddl": ("cddl", 1), "lgpl": ("lgpl", 1),
    "gpl": ("gpl", 2), "eupl": ("eupl", 2), "gfdl": ("gfdl", 2), "cc-by-sa": ("cc-by-sa", 2),
    "cc-by-nc": ("cc-by-nc", 2), "cc-by-nd": ("cc-by-nd", 2), "cc-by-nc-sa": ("cc-by-nc", 2), "cc-by-nc-nd": ("cc-by-nc", 2),
    "agpl": ("agpl", 3), "osl": ("osl", 3), "sspl": ("sspl", 3),
}
UNKNOWN = ("other", 4)
# Exceptions that take linking works out of strength 2.
LINKING = ("classpath-exception-2.0", "gcc-exception-2.0", "gcc-exception-3.1", "llvm-exception", "font-exception-2.0", "autoconf-exception-3.0")

FOUND = (
    "struct<n_words:bigint,notices:array<struct<word:bigint,phrase:string,label:string,base:boolean>>,"
    "expressions:array<struct<word:bigint,expression:string,labels:array<string>,chosen:array<string>,strength:int>>>"
)

_TOKEN = re.compile(r"[ \t]*([A-Za-z0-9][A-Za-z0-9.:+-]*|[()])")
_IDENTIFIER = re.compile(r"(.+?)(?:-v?[0-9][0-9.]*)?(?:-only|-or-later|\+)?")
_BINDS = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Terms:
    """What an expression comes to: all labels in it, those of the mildest alternative, and how strong that is."""

    labels: frozenset[str]
    chosen: frozenset[str]
    strength: int


def identifier(name: str) -> Terms:
    label, strength = FAMILIES.get(name) or FAMILIES.get(_IDENTIFIER.fullmatch(name)[1], UNKNOWN)
    return Terms(frozenset([label]), frozenset([label]), strength)


def _combined(operator: str, a: Terms | str, b: Terms | str) -> Terms | None:
    if operator == "with":
        # Only an identifier may follow, and only one may be qualified.
        if not isinstance(a, str) or not isinstance(b, str):
            return None
        of = identifier(a)
        return Terms(of.labels, of.chosen, 1 if b in LINKING and of.strength == 2 else of.strength)
    a, b = (identifier(x) if isinstance(x, str) else x for x in (a, b))
    if operator == "and":
        return Terms(a.labels | b.labels, a.chosen | b.chosen, max(a.strength, b.strength))
    milder = b if b.strength < a.strength else a
    return Terms(a.labels | b.labels, milder.chosen, milder.strength)


def evaluate(text: str) -> tuple[str, Terms | None]:
    """(the expression at the beginning of a line, what it comes to, or None where it is not well formed).

    Operators `with`, `and`, `or` bind in this order, from the left, in any case; parentheses group. The expression ends
    before what cannot go on with it: another character, or an identifier or parenthesis after a complete part.
    A full stop or colon at the end of an identifier is none of it. Two stacks, no recursion, so depth is not bounded.
    """
    values, operators = [], []
    at, wants_value, open_ = 0, True, 0

    def reduce_() -> bool:
        operator, b, a = operators.pop(), values.pop(), values.pop()
        values.append(_combined(operator, a, b))
        return values[-1] is not None

    while found := _TOKEN.match(text, at):
        token = found[1].lower()
        if token in _BINDS and not wants_value:
            # `a with b` takes no further exception.
            while operators and operators[-1] != "(" and _BINDS[operators[-1]] >= _BINDS[token]:
                if not reduce_():
                    return text[: found.start()].strip(), None
            operators.append(token)
            wants_value = True
        elif token == "(" and wants_value:
            operators.append(token)
            open_ += 1
        elif token == ")" and not wants_value and open_:
            while operators[-1] != "(":
                if not reduce_():
                    return text[: found.start()].strip(), None
            operators.pop()
            # A group is no identifier, so no exception can follow it.
            values[-1] = identifier(values[-1]) if isinstance(values[-1], str) else values[-1]
            open_ -= 1
        elif token not in _BINDS and token not in ("(", ")") and wants_value:
            name = token.rstrip(".:")
            values.append(name)
            wants_value = False
            if name != token:
                at = found.end() - (len(token) - len(name))
                break
        else:
            break
        at = found.end()
    whole = text[:at].strip()
    if wants_value or open_:
        return whole, None
    while operators:
        if not reduce_():
            return whole, None
    return whole, identifier(values[0]) if isinstance(values[0], str) else values[0]


class WordAutomaton:
    """Aho-Corasick over words: `step[state, symbol]` with failure links already followed; word numbers are symbols."""

    def __init__(self, phrases: list[str]):
        split = [p.split() for p in phrases]
        self.lengths = [len(p) for p in split]
        words = sorted({w for p in split for w in p})
        hashes = term_hashes(words)
        by = np.argsort(hashes)
        self.hashes = hashes[by]
        number = {words[i]: k for k, i in enumerate(by.tolist())}
        children: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for i, phrase in enumerate(split):
            state = 0
            for word in phrase:
                if number[word] not in children[state]:
                    children[state][number[word]] = len(children)
                    children.append({})
                    ends.append([])
                state = children[state][number[word]]
            ends[state].append(i)
        step = [[0] * len(words) for _ in children]
        fail = [0] * len(children)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            back = step[fail[state]]
            for symbol in range(len(words)):
                if symbol in children[state]:
                    child = children[state][symbol]
                    fail[child] = back[symbol] if state else 0
                    queue.append(child)
                    step[state][symbol] = child
                else:
                    step[state][symbol] = back[symbol] if state else 0
            ends[state] = ends[state] + (ends[fail[state]] if state else [])
        self.step, self.ends = step, ends

    def find(self, hashes: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
        """(number of the first word, phrase) of every place; words outside all phrases reset the automaton."""
        if not len(hashes):
            return []
        symbol = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = np.flatnonzero(self.hashes[symbol] == hashes)
        fresh = np.ones(len(known), dtype=bool)
        fresh[1:] = (np.diff(known) != 1) | (np.diff(rows[known]) != 0)
        found, state, step, ends, lengths = [], 0, self.step, self.ends, self.lengths
        for word, s, new in zip(known.tolist(), symbol[known].tolist(), fresh.tolist(), strict=True):
            state = step[0 if new else state][s]
            if ends[state]:
                found.extend((word - lengths[p] + 1, p) for p in ends[state])
        return found


class Scanner:
    def __init__(self, base: dict[str, str], own: dict[str, str], tags: tuple[str, ...]):
        self.phrases = [(p, label, True) for p, label in base.items()]
        self.phrases += [(p, label, False) for p, label in own.items() if p not in base]
        self.tags = list(tags)
        self.automaton = WordAutomaton([p for p, _, _ in self.phrases] + self.tags)

    def __call__(self, texts: pa.Array) -> pa.Array:
        n_words, notices, expressions = [], [], []
        for first, block, starts in text_blocks(texts):
            hashes, rows, _, end = placed_terms(block, starts)
            n_rows = len(starts) - 1
            edge = np.searchsorted(rows, np.arange(n_rows + 1)).tolist()
            n_words += np.diff(edge).tolist()
            notices += [[] for _ in range(n_rows)]
            expressions += [[] for _ in range(n_rows)]
            for word, p in sorted(self.automaton.find(hashes, rows)):
                row = int(rows[word])
                place = word - edge[row]
                if p < len(self.phrases):
                    phrase, label, base = self.phrases[p]
                    notices[first + row].append({"word": place, "phrase": phrase, "label": label, "base": base})
                    continue
                behind = int(end[word + self.automaton.lengths[p] - 1])
                found = self._expression(block[behind : int(starts[row + 1]) - 1])
                if found is not None:
                    expressions[first + row].append({"word": place, **found})
        at = pa.field("word", pa.int64())
        notice = pa.struct([at, ("phrase", pa.string()), ("label", pa.string()), ("base", pa.bool_())])
        names = pa.list_(pa.string())
        expression = pa.struct([at, ("expression", pa.string()), ("labels", names), ("chosen", names), ("strength", pa.int32())])
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(notices, pa.list_(notice)), pa.array(expressions, pa.list_(expression))],
            ["n_words", "notices", "expressions"],
        )

    @staticmethod
    def _expression(behind: np.ndarray) -> dict | None:
        """The expression after a tag: behind a colon, in the same line."""
        size = 256
        while True:
            # Texts may be long and lines too: more is only decoded while no line break has come.
            piece = behind[:size].tobytes()
            if size >= len(behind) or b"\n" in piece or b"\r" in piece:
                break
            size *= 4
        line = re.split("[\n\r]", piece.decode(errors="ignore"), maxsplit=1)[0]
        colon = re.match(r"[ \t]*:", line)
        if not colon:
            return None
        text, terms = evaluate(line[colon.end() :])
        if not text:
            return None
        if terms is None:
            return {"expression": text, "labels": [], "chosen": [], "strength": None}
        return {"expression": text, "labels": sorted(terms.labels), "chosen": sorted(terms.chosen), "strength": terms.strength}


def find_licenses(
    text: Column, base: dict[str, str] = BASE_PHRASES, own: dict[str, str] = OWN_PHRASES, tags: tuple[str, ...] = TAGS
) -> Column:
    """struct<n_words, notices, expressions> of a text; words are `terms.placed_terms`, numbered from 0.

    A notice is a place where the words of a phrase stand consecutively, whatever stands between words; all places count, overlapping
    ones too, by first word and then phrase as listed, base phrases before own ones. An expression follows a tag and a colon in the same line; it has
    its labels, those of its mildest alternative and that one's strength (0 notices only, to 3; 4 unknown), or no labels and a null
    strength when it is not well formed. Tags without an expression give nothing. Null, empty and long texts, repeated rows and empty
    tables need no care: each row is judged on its own, and no column names are reserved.
    """
    scanner = Scanner(base, own, tags)

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        return scanner(texts)

    return found(text)


def score(found: Column) -> Column:
    """0 without a finding, else nearer to 1 with each: a notice halves what is missing, a well formed expression leaves an eighth."""
    valid = F.size(F.filter(found["expressions"], lambda e: e["strength"].isNotNull()))
    return F.lit(1.0) - F.pow(F.lit(0.5), F.size(found["notices"]) + F.lit(3) * valid)
