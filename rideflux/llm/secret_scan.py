"""Secret scan: all rules compiled into one deterministic automaton.

Each rule is a byte regex (a small syntax: literals, classes, groups,
alternation, ``? * + {m} {m,} {m,n}``, and ``(?i:...)`` for letters in either
case).  The rules' reversed languages are put into one automaton by subset
construction, minimised, and stored as transition arrays over byte classes.
One pass over a text's bytes, from its end to its start, then marks every
position where a match of any rule begins.  From the leftmost mark of a rule
its own forward automaton gives the longest match; the next one is looked for
behind it, so matches are leftmost, longest and do not overlap per rule.

Matches that a rule's ``least`` checks refuse are consumed and dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm.common import ship


@dataclass(frozen=True)
class Rule:
    """``value`` is a character set; with ``least``, the run of those bytes
    that ends a match must be at least that long."""
    kind: str
    pattern: str
    value: str = ""
    least: int = 0


# The base rules first, in their order, then further kinds of
# credentials with a published fixed prefix.
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         "A-Za-z0-9+/_.=-", 6),
    Rule("access", r"AKIA[A-Z0-9]+", "A-Z0-9", 16),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", "A-Za-z0-9", 36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", "A-Za-z0-9-", 10),
    Rule("google", r"AIza[A-Za-z0-9_-]+", "A-Za-z0-9_-", 35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "A-Za-z0-9_-", 8),
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("url_password", r"[a-z]+://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$&*+=-]+@"),
)


class Parser:
    """Regex text to a nested tuple: ("set", bytes), ("cat", ...), ("alt", ...),
    ("rep", node, least, most or None)."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def parse(self):
        node = self._alternation(False)
        if self.at < len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r}")
        return node

    def _alternation(self, either: bool):
        options = [self._sequence(either)]
        while self._take("|"):
            options.append(self._sequence(either))
        return options[0] if len(options) == 1 else ("alt", *options)

    def _sequence(self, either: bool):
        items = []
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            items.append(self._repeated(either))
        return ("cat", *items)

    def _repeated(self, either: bool):
        node = self._atom(either)
        while self.at < len(self.text) and self.text[self.at] in "?*+{":
            c = self.text[self.at]
            self.at += 1
            if c == "{":
                inside, self.at = self.text[self.at:self.text.index("}", self.at)], self.text.index("}", self.at) + 1
                least, comma, most = inside.partition(",")
                node = ("rep", node, int(least), (int(most) if most else None) if comma else int(least))
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def _atom(self, either: bool):
        if self._take("("):
            inner = either
            if self._take("?i:"):
                inner = True
            else:
                self._take("?:")
            node = self._alternation(inner)
            if not self._take(")"):
                raise ValueError("missing )")
            return node
        if self._take("["):
            return ("set", self._class())
        return ("set", _fold(self._byte(), either))

    def _class(self) -> frozenset[int]:
        negate, out = self._take("^"), set()
        while not self._take("]"):
            lo = self._byte()
            if self.text[self.at] == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                out.update(range(lo, self._byte() + 1))
            else:
                out.add(lo)
        return frozenset(range(256)) - out if negate else frozenset(out)

    def _byte(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def _take(self, s: str) -> bool:
        if self.text.startswith(s, self.at):
            self.at += len(s)
            return True
        return False


def _fold(byte: int, either: bool) -> frozenset[int]:
    c = chr(byte)
    return frozenset({ord(c.lower()), ord(c.upper())} if either and c.isascii() and c.isalpha() else {byte})


class Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append([])
        return len(self.empty) - 1

    def add(self, node, start: int, backwards: bool) -> int:
        """Adds ``node`` behind ``start``; returns its end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.step[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in (reversed(node[1:]) if backwards else node[1:]):
                start = self.add(part, start, backwards)
            return start
        if kind == "alt":
            end = self.state()
            for part in node[1:]:
                self.empty[self.add(part, start, backwards)].append(end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            start = self.add(inner, start, backwards)
        end = self.state()
        if most is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop, backwards)].append(loop)
            self.empty[loop].append(end)
        else:
            for _ in range(most - least):
                self.empty[start].append(end)
                start = self.add(inner, start, backwards)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(out)


@dataclass
class Dfa:
    """Minimal automaton.  ``classes`` maps a byte to its class; state s goes
    to ``next[s * width + class]``; ``accepts[s]`` has a bit for each rule.
    States are numbered so that the accepting ones come last."""
    classes: bytes
    width: int
    next: list[int]
    accepts: list[int]
    start: int
    first_accepting: int


def determinise(nfa: Nfa, start: int, ends: dict[int, int]) -> Dfa:
    """Subset construction over byte classes, then minimisation by partition
    refinement.  ``ends``: end state -> rule."""
    sets = {s for row in nfa.step for s, _ in row}
    signature: dict[tuple, list[int]] = {}
    ordered = sorted(sets, key=sorted)
    for byte in range(256):
        signature.setdefault(tuple(byte in s for s in ordered), []).append(byte)
    groups = list(signature.values())
    classes = bytearray(256)
    for k, group in enumerate(groups):
        for byte in group:
            classes[byte] = k
    samples, width = [g[0] for g in groups], len(groups)

    first = nfa.closure([start])
    number, order, table = {first: 0}, [first], []
    for states in order:  # grows while it runs
        row = []
        for byte in samples:
            to = nfa.closure({t for s in states for chars, t in nfa.step[s] if byte in chars})
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    accepts = [sum(1 << ends[s] for s in states if s in ends) for states in order]

    block = {a: i for i, a in enumerate(sorted(set(accepts)))}
    of = [block[a] for a in accepts]
    while True:
        keys: dict[tuple, int] = {}
        new = [keys.setdefault((of[s], *(of[t] for t in table[s])), len(keys)) for s in range(len(table))]
        if len(keys) == len(set(of)):
            break
        of = new
    member = {b: s for s, b in reversed(list(enumerate(of)))}
    rank = {b: i for i, b in enumerate(sorted(member, key=lambda b: (accepts[member[b]] != 0, member[b])))}
    by_rank = sorted(member, key=rank.__getitem__)
    marks = [accepts[member[b]] for b in by_rank]
    return Dfa(bytes(classes), width, [rank[of[t]] for b in by_rank for t in table[member[b]]], marks, rank[of[0]],
               next((i for i, m in enumerate(marks) if m), len(marks)))


class Scanner:
    """The combined backward automaton and each rule's forward automaton."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        trees = [Parser(r.pattern).parse() for r in rules]
        nfa = Nfa()
        start = nfa.state()
        nfa.step[start].append((frozenset(range(256)), start))
        ends = {}
        for i, tree in enumerate(trees):
            inner = nfa.state()
            nfa.empty[start].append(inner)
            ends[nfa.add(tree, inner, True)] = i
        self.back = determinise(nfa, start, ends)
        self.forward = []
        for tree in trees:
            nfa = Nfa()
            start = nfa.state()
            self.forward.append(determinise(nfa, start, {nfa.add(tree, start, False): 0}))
        self.value = [Parser(f"[{r.value}]").parse()[1][1] if r.value else None for r in rules]
        # States premultiplied by the row width, so a step is one lookup.
        w = self.back.width
        self._next = [t * w for t in self.back.next]
        self._start, self._accepting = self.back.start * w, self.back.first_accepting * w

    def marks(self, data: bytes) -> list[tuple[int, int]]:
        """(position, rules as bits) of every byte at which a match begins,
        from the last to the first."""
        table, state, accepting, out = self._next, self._start, self._accepting, []
        for i, c in enumerate(data.translate(self.back.classes)[::-1], 1):
            state = table[state + c]
            if state >= accepting:
                out.append((i, state))
        accepts, w, n = self.back.accepts, self.back.width, len(data)
        return [(n - i, accepts[s // w]) for i, s in out]

    def _longest(self, i: int, data: bytes, at: int) -> int:
        """End of the longest match of rule i at a position where one begins."""
        d = self.forward[i]
        state, end = d.start, at
        dead = d.accepts
        while at < len(data):
            state = d.next[state * d.width + d.classes[data[at]]]
            at += 1
            if dead[state]:
                end = at
            elif self._is_dead(i, state):
                break
        return end

    def _is_dead(self, i: int, state: int) -> bool:
        d = self.forward[i]
        return not d.accepts[state] and all(t == state for t in d.next[state * d.width:(state + 1) * d.width])

    def spans(self, data: bytes) -> list[tuple[str, int, int]]:
        """(kind, start, end) in bytes, by start, then by the rules' order."""
        behind = [0] * len(self.rules)
        out = []
        for at, bits in reversed(self.marks(data)):
            for i, rule in enumerate(self.rules):
                if not bits >> i & 1 or at < behind[i]:
                    continue
                end = self._longest(i, data, at)
                behind[i] = end
                if rule.least:
                    value = self.value[i]
                    short = end - at <= rule.least or any(c not in value for c in data[end - rule.least:end])
                    if short or not self._valued(i, data, at, end):
                        continue
                out.append((at, i, end))
        return [(self.rules[i].kind, at, end) for at, i, end in sorted(out)]

    def _valued(self, i: int, data: bytes, at: int, end: int) -> bool:
        """Whether the match still is one with its last ``least`` - 1 bytes
        cut off, that is, whether the final run has ``least`` bytes."""
        d = self.forward[i]
        state = d.start
        for c in data[at:end - self.rules[i].least + 1]:
            state = d.next[state * d.width + d.classes[c]]
        return bool(d.accepts[state])


def in_code_points(data: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Byte positions as code points: bytes that do not continue a character."""
    if not spans or data.isascii():
        return spans
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    before = np.r_[0, np.cumsum(begins)]
    return [(k, int(before[a]), int(before[b])) for k, a, b in spans]


_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    s = scanner(rules)
    for b in batches:
        found = []
        for text in b.column(1).to_pylist():
            data = (text or "").encode("utf-8")
            found.append([{"kind": k, "start": x, "end": y} for k, x, y in in_code_points(data, s.spans(data))])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _SPAN)], ["doc_id", "found"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, found``: all spans (kind, start, end in code points, end
    exclusive) of every whole text, by start, then in the rules' order.

    Per rule matches are leftmost, longest and do not overlap; matches of
    different rules may.  Null and empty texts have none.  Ids are only
    carried: null and repeated ones are fine; other columns are not read.  An
    empty table gives no rows; a very long text is scanned whole, in time and
    memory that grow with it.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(partial(_scan, rules=rules),
                           f"doc_id {kind}, found array<struct<kind: string, start: long, end: long>>")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of
    ``find_secrets``: counts and SHA-256 of the base kinds, all spans as text."""
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    kinds = ", ".join(f"'{k}'" for k in BASE)
    base = f"filter(found, x -> x.kind IN ({kinds}))"
    return found.select(
        "doc_id", *[F.expr(f"size(filter(found, x -> x.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"), F.expr(joined.format("found")).alias("spans"))
