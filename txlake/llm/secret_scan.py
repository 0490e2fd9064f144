"""Find and redact secrets with one deterministic automaton for all rules."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.batches import SEPARATOR, text_blocks

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. The pattern is bytes-like ASCII and its last part is a repeated class or a literal, so
    that a match cannot be prolonged past a byte at which it fails. With `head` this holds for `head` alone, with which each
    match begins and which is a match itself: the automaton finds it, the pattern prolongs it. Matches shorter than `length`, or whose group `group` is, are dropped."""

    kind: str
    pattern: str
    length: int = 0
    group: int = 0
    any_case: bool = False
    head: str = ""


# Fixed values of the first three kinds.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
# Line breaks of a key may be escaped, its lines indented. Up to the END line all lines of base64 letters belong to it;
# without END line the long ones do and a short one with padding.
_BREAK = r"((\r|\n|\\r|\\n)[\x20\t]*)+"
_FIELDS = rf"[\x20\t]*({_BREAK}[A-Za-z][A-Za-z0-9-]*:[A-Za-z0-9+/=:,\x20-]+)*"
_OF_KEY = r"(RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"
PRIVATE_KEY = (
    rf"-----BEGIN {_OF_KEY}({_FIELDS}({_BREAK}[A-Za-z0-9+/=]+[\x20\t]*)*{_BREAK}-----END {_OF_KEY}"
    rf"|{_FIELDS}({_BREAK}[A-Za-z0-9+/]{{16,}}=*[\x20\t]*)+({_BREAK}[A-Za-z0-9+/]+=+)?)?"
)
RULES = (
    *BASE_RULES,
    Rule("private_key", PRIVATE_KEY, head=rf"-----BEGIN {_OF_KEY}"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 20),
)


class _Nfa:
    """States with byte sets; state 0 of a part is where it begins."""

    def __init__(self, any_case: bool, backwards: bool) -> None:
        self.edges: list[list[tuple[frozenset[int] | None, int]]] = []
        self.any_case, self.backwards = any_case, backwards

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def _bytes(self, kind, value) -> frozenset[int]:
        if kind is op.LITERAL:
            found = {value}
        elif kind is op.RANGE:
            found = set(range(value[0], value[1] + 1))
        elif kind is op.IN:
            found = set().union(*(self._bytes(*item) for item in value))
        else:
            raise ValueError(f"{kind} is not supported in a rule")
        if self.any_case:
            found |= {ord(chr(b).swapcase()) for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)

    def add(self, tree, start: int) -> int:
        """Append a parsed pattern behind a state; the state where it ends."""
        for kind, value in reversed(list(tree)) if self.backwards else tree:
            if kind is op.SUBPATTERN:
                start = self.add(value[-1], start)
            elif kind is op.BRANCH:
                end = self.state()
                for choice in value[1]:
                    self.edges[self.add(choice, start)].append((None, end))
                start = end
            elif kind is op.MAX_REPEAT:
                least, most, body = value
                for _ in range(least):
                    start = self.add(body, start)
                if most is op.MAXREPEAT:
                    loop = self.state()
                    self.edges[start].append((None, loop))
                    self.edges[self.add(body, loop)].append((None, loop))
                    start = loop
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.edges[start].append((None, end))
                        start = self.add(body, start)
                    self.edges[start].append((None, end))
                    start = end
            else:
                end = self.state()
                self.edges[start].append((self._bytes(kind, value), end))
                start = end
        return start

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for label, target in self.edges[todo.pop()]:
                if label is None and target not in found:
                    found.add(target)
                    todo.append(target)
        return frozenset(found)


@dataclass
class Automaton:
    """Minimal automaton: state after state * n_classes + class of the byte; accepting rules as bits of a state."""

    classes: np.ndarray
    n_classes: int
    moves: np.ndarray
    accepts: np.ndarray
    start: int
    dead: int = field(default=-1)


def compile_rules(rules: tuple[Rule, ...], backwards: bool = False) -> Automaton:
    """Forwards, the automaton looks for matches that begin anywhere; backwards, for the beginnings of matches
    that end where it starts."""
    nfa = _Nfa(False, backwards)
    root = nfa.state()
    ends = {}
    for i, rule in enumerate(rules):
        nfa.any_case = rule.any_case
        ends[nfa.add(_parser.parse(rule.head or rule.pattern), root)] = 1 << i

    # Bytes that no edge tells apart share a class.
    labels = {label for edges in nfa.edges for label, _ in edges if label is not None}
    kinds: dict[tuple, int] = {}
    classes = np.array(
        [kinds.setdefault(tuple(b in label for label in labels), len(kinds)) for b in range(256)], dtype=np.uint8
    )
    samples = [int(np.flatnonzero(classes == k)[0]) for k in range(len(kinds))]

    # Subset construction.
    first = nfa.closure([root])
    numbers, todo, moves = {first: 0}, [first], []
    while todo:
        subset = todo.pop(0)
        row = []
        for byte in samples:
            after = {t for s in subset for label, t in nfa.edges[s] if label is not None and byte in label}
            if not backwards:
                after.add(root)
            closed = nfa.closure(after)
            if closed not in numbers:
                numbers[closed] = len(numbers)
                todo.append(closed)
            row.append(numbers[closed])
        moves.append(row)
    table = np.array(moves)
    accepts = np.array([sum(ends.get(s, 0) for s in subset) for subset in numbers])

    # Minimisation: split groups of states until the groups' moves agree.
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        if finer.max() == group.max():
            break
        group = finer
    _, member = np.unique(group, return_index=True)
    dead = group[numbers[frozenset()]] if frozenset() in numbers else -1
    return Automaton(
        classes, len(kinds), group[table[member]].astype(np.uint16).ravel(), accepts[member].astype(np.uint32),
        int(group[0]), int(dead),
    )


def states_after(automaton: Automaton, data: np.ndarray, lane: int = 2048) -> np.ndarray:
    """State after every byte, in one pass over lanes side by side.

    Each lane begins in the start state. Where the lane before ended in another one, the lane is walked
    again from there until it meets the states found first.
    """
    n, k = len(data), automaton.n_classes
    lanes = -(-n // lane)
    padded = np.full(lanes * lane, SEPARATOR, dtype=np.uint8)
    padded[:n] = data
    columns = np.ascontiguousarray(automaton.classes[padded].reshape(lanes, lane).T).astype(np.int32)
    moves = automaton.moves
    found = np.empty((lane, lanes), dtype=np.uint16)
    state = np.full(lanes, automaton.start, dtype=np.int32)
    for i in range(lane):
        state = moves[state * k + columns[i]]
        found[i] = state
        state = state.astype(np.int32)
    entered = np.full(lanes, automaton.start, dtype=np.uint16)
    while True:
        begins = np.concatenate([[automaton.start], found[-1, :-1]]).astype(np.uint16)
        active = np.flatnonzero(begins != entered)
        if not len(active):
            break
        state = begins[active].astype(np.int32)
        entered[active] = begins[active]
        for i in range(lane):
            state = moves[state * k + columns[i, active]].astype(np.int32)
            differs = state != found[i, active]
            active, state = active[differs], state[differs]
            if not len(active):
                break
            found[i, active] = state
    return found.T.reshape(-1)[:n]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.forward = compile_rules(rules)
        self.backward = [compile_rules((rule,), backwards=True) for rule in rules]
        # The matches of one repeated class are the stretches that the automaton accepts.
        trees = [list(_parser.parse(rule.pattern)) for rule in rules]
        self.one_class = [
            len(t) == 1 and t[0][0] is op.MAX_REPEAT and t[0][1][:2] == (1, op.MAXREPEAT) and t[0][1][2][0][0] is op.IN
            for t in trees
        ]
        self.patterns = [re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)) for r in rules]

        self.longer = [re.compile(p.pattern.encode(), p.flags & re.IGNORECASE) for p in self.patterns]

    def _begin(self, rule: int, data: np.ndarray, least: int, end: int) -> int:
        """Start of the longest match of the rule that ends before `end` and does not begin before `least`, or -1."""
        automaton = self.backward[rule]
        state, found = automaton.start, -1
        for at in range(end - 1, least - 1, -1):
            state = int(automaton.moves[state * automaton.n_classes + int(automaton.classes[data[at]])])
            if state == automaton.dead:
                break
            if automaton.accepts[state]:
                found = at
        return found

    def spans(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start."""
        accepted = self.forward.accepts[states_after(self.forward, data)]
        found, whole = [], b""
        for i, rule in enumerate(self.rules):
            hit = (accepted & (1 << i)) != 0
            # A match ends where the automaton stops accepting.
            ends = np.flatnonzero(hit & ~np.append(hit[1:], False)) + 1
            if self.one_class[i]:
                begins = np.flatnonzero(hit & ~np.insert(hit[:-1], 0, False))
                long = ends - begins >= rule.length
                found += [(b, i, e) for b, e in zip(begins[long].tolist(), ends[long].tolist(), strict=True)]
                continue
            least = 0
            for end in ends.tolist():
                if end <= least:
                    continue
                start = self._begin(i, data, least, end)
                if start < 0:
                    continue
                if rule.head:
                    whole = whole or data.tobytes()
                    end = self.longer[i].match(whole, start).end()
                least = end
                text = data[start:end].tobytes().decode("ascii")
                size = len(self.patterns[i].fullmatch(text).group(rule.group))
                if size >= rule.length:
                    found.append((start, i, end))
        return sorted(found)

    def __call__(self, texts: pa.Array) -> pa.Array:
        kinds = [rule.kind for rule in self.rules]
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for first, data, starts in text_blocks(texts):
            found = self.spans(data)
            if not found:
                continue
            # Positions count code points, that is bytes that do not continue one.
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            for start, rule, end in found:
                row = int(np.searchsorted(starts, start, side="right")) - 1
                base = points[starts[row]]
                out[first + row].append(
                    {"kind": kinds[rule], "start": int(points[start] - base), "end": int(points[end] - base)}
                )
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.array(out, type=kind)


def find_secrets(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of the secrets in a text: kind, start and end (exclusive) in code points, by start and then kind.

    Matches of a kind are leftmost and do not overlap; different kinds may. Null and empty texts have none.
    A whole batch is scanned in one pass over its bytes, long texts included.
    """
    scanner = Scanner(rules)

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        return scanner(texts)

    return spans(text)


def as_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; each stretch of text that secrets cover, overlapping ones joined, becomes `mark`.

    Texts without secrets, null ones included, stay as they are. Column names beginning with two underscores
    are reserved.
    """
    spans = F.col("__spans")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(F.col(f"`{text}`"), (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        return F.struct(
            F.when(span["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(F.col(f"`{text}`"), (done["at"] + 1).cast("int"), F.lit(2147483647)))

    found = docs.withColumn("__spans", find_secrets(F.col(f"`{text}`")))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(F.col(f"`{text}`"))
    return found.withColumn(text, clean).select(*[F.col(f"`{c}`") for c in docs.columns])
