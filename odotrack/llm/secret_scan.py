"""Secrets in texts, found by one deterministic automaton for all rules.

**Compilation.** Each rule's regular expression becomes a nondeterministic automaton. A
state of the combined one holds, for every rule, the threads alive in order of the byte
where they began. Subset construction over such states gives leftmost, longest matches
that do not overlap, rule by rule: when a thread ends a match, those that began later are
cut, and no new ones begin until it dies. A rule whose thread would have to be followed
beyond its last match (``ab(cd)?``) needs a second look at the same bytes and is refused.
States with equal futures are merged (Moore's refinement), bytes that no rule tells
apart share a class, and the table is a flat array: entry ``state + class`` is the next
state, already multiplied by the number of classes.

**Scan.** A text's UTF-8 bytes are mapped to classes and walked once, whatever the number
of rules. A transition that ends a match is negative and names its rules. Where the match
began is read backwards from its end by the rule's reversed automaton, not further than
the rule's previous match; this touches the bytes of matches, and the run that leads up
to one. ``least`` characters of a match (behind ``head``, if the rule has one) are checked
last, so a match that is too short still uses up its bytes.

Offsets are code points, the end exclusive. Null and empty texts hold nothing. Rows are
scanned one by one: ties and repeated rows do not matter, and a column named like the new
one is replaced. A lone surrogate cannot occur in a Spark string."""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern``: literals, ``\\xHH``, classes, groups, ``|``, ``? * + {n} {n,} {n,m}``,
    all ASCII. Where ``body`` is given, a match is ``pattern`` followed by ``body`` and
    only the characters of the body count towards ``least``."""

    kind: str
    pattern: str
    body: str = ""
    least: int = 1
    any_case: bool = False


# The rules that the query's contract names. A run of hexadecimal digits that
# is too short holds no longer one, so its length is part of the pattern.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 12, True),
    Rule("access", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]{16,}", least=16),
)
#: Published formats of further credentials.
MORE = (
    Rule("github", "gh[opsu]_[0-9A-Za-z]+", least=40),
    Rule("google", r"AIza[0-9A-Za-z_\-]+", least=39),
    Rule("slack", r"xox[abpr]-[0-9A-Za-z\-]+", least=16),
    Rule("jwt", r"eyJ[0-9A-Za-z_\-]+\.eyJ[0-9A-Za-z_\-]+\.[0-9A-Za-z_\-]+", least=32),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE + MORE
#: Bound on the states of the combined automaton before they are merged.
MAX_STATES = 1 << 16

# Parsing: a node is a set of bytes, or (operator, nodes...).


class _Parser:
    def __init__(self, pattern: str, any_case: bool):
        self.rest, self.any_case = list(pattern), any_case

    def parse(self):
        node = self.either()
        if self.rest:
            raise ValueError(f"unexpected {self.rest[0]!r}")
        return node

    def either(self):
        ways = [self.sequence()]
        while self.rest and self.rest[0] == "|":
            self.rest.pop(0)
            ways.append(self.sequence())
        return ways[0] if len(ways) == 1 else ("or", *ways)

    def sequence(self):
        parts = []
        while self.rest and self.rest[0] not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("then", *parts)

    def repeated(self, node):
        while self.rest and self.rest[0] in "?*+{":
            sign = self.rest.pop(0)
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(sign, (None, None))
            if sign == "{":
                text = ""
                while (c := self.rest.pop(0)) != "}":
                    text += c
                first, comma, last = text.partition(",")
                low, high = int(first), int(last) if last else None if comma else int(first)
            more = [("star", node)] if high is None else [("or", ("then",), node)] * (high - low)
            node = ("then", *[node] * low, *more)
        return node

    def atom(self):
        c = self.rest.pop(0)
        if c == "(":
            node = self.either()
            if not self.rest or self.rest.pop(0) != ")":
                raise ValueError("a group is not closed")
            return node
        if c == "[":
            return self.klass()
        if c in ".^$":
            raise ValueError(f"{c!r} is not supported outside a class")
        return self.cased({self.literal(c)})

    def literal(self, c: str) -> int:
        if c == "\\":
            c = self.rest.pop(0)
            if c == "x":
                return int(self.rest.pop(0) + self.rest.pop(0), 16)
            if c.isalnum():
                raise ValueError(f"\\{c} is not supported")
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def klass(self) -> frozenset[int]:
        negated = self.rest[0] == "^"
        if negated:
            self.rest.pop(0)
        found: set[int] = set()
        while (c := self.rest.pop(0)) != "]":
            first = last = self.literal(c)
            if self.rest[0] == "-" and self.rest[1] != "]":
                self.rest.pop(0)
                last = self.literal(self.rest.pop(0))
            found.update(range(first, last + 1))
        return frozenset(range(256)) - found if negated else self.cased(found)

    def cased(self, found: set[int]) -> frozenset[int]:
        if self.any_case:
            letters = {b for b in found if chr(b).isalpha() and b < 128}
            found = found | {b ^ 32 for b in letters}
        return frozenset(found)


def _reversed(node):
    if isinstance(node, frozenset):
        return node
    parts = tuple(_reversed(n) for n in node[1:])
    return (node[0], *(reversed(parts) if node[0] == "then" else parts))


class _Nfa:
    """Positions of a pattern: each has its bytes and the positions that may follow it."""

    def __init__(self, node):
        self.bytes: list[frozenset[int]] = []
        self.after: list[set[int]] = []
        self.first, self.last, self.nullable = self._build(node)

    def _build(self, node) -> tuple[set[int], set[int], bool]:
        if isinstance(node, frozenset):
            self.bytes.append(node)
            self.after.append(set())
            here = {len(self.bytes) - 1}
            return here, here, False
        kind, *parts = node
        if kind == "or":
            built = [self._build(n) for n in parts]
            return set().union(*(b[0] for b in built)), set().union(*(b[1] for b in built)), any(b[2] for b in built)
        if kind == "star":
            first, last, _ = self._build(parts[0])
            for p in last:
                self.after[p] |= first
            return first, last, True
        first, last, nullable = set(), set(), True
        for part in parts:
            f, l, n = self._build(part)
            for p in last:
                self.after[p] |= f
            first = first | f if nullable else first
            last = last | l if n else l
            nullable = nullable and n
        return first, last, nullable

    def step(self, ready: Iterable[int], byte: int) -> frozenset[int]:
        """The positions that read ``byte``, of those that may be next."""
        return frozenset(p for p in ready if byte in self.bytes[p])

    def next(self, at: frozenset[int]) -> set[int]:
        return set().union(*(self.after[p] for p in at)) if at else set()


class _Anchored:
    """The longest match from a fixed place, states made when first met."""

    def __init__(self, node):
        self.nfa = _Nfa(node)
        self.table: dict[tuple[frozenset[int] | None, int], frozenset[int]] = {}

    def longest(self, data: Iterable[int]) -> int:
        """Bytes of the longest match at the start of ``data``; 0 for none."""
        at, best = None, 0
        for n, byte in enumerate(data, 1):
            key = (at, byte)
            if key not in self.table:
                ready = self.nfa.first if at is None else self.nfa.next(at)
                self.table[key] = self.nfa.step(ready, byte)
            at = self.table[key]
            if not at:
                break
            if not at.isdisjoint(self.nfa.last):
                best = n
        return best


#: One rule's part of a state: threads in order of their beginning, and whether the first
#: of them has just ended a match.
_Part = tuple[tuple[frozenset[int], ...], bool]
_FRESH: _Part = ((), False)


class Automaton:
    """All rules in one table; see the module's text."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        parsed = [_Parser(r.pattern, r.any_case).parse() for r in rules]
        bodies = [_Parser(r.body, r.any_case).parse() for r in rules]
        self.nodes = [("then", a, b) for a, b in zip(parsed, bodies)]
        self.heads = [_Anchored(n) if r.body else None for r, n in zip(rules, parsed)]
        self.nfas = [_Nfa(n) for n in self.nodes]
        for rule, nfa in zip(rules, self.nfas):
            if nfa.nullable:
                raise ValueError(f"{rule.kind} matches nothing at all")
        self._compile()

    @cached_property
    def backward(self) -> list[_Anchored]:
        return [_Anchored(_reversed(n)) for n in self.nodes]

    def _classes(self) -> list[int]:
        """One byte for each set of bytes that all rules treat alike."""
        sets = list(dict.fromkeys(b for nfa in self.nfas for b in nfa.bytes))
        numbers: dict[tuple[bool, ...], int] = {}
        of, sample = bytearray(256), []
        for byte in range(256):
            key = tuple(byte in s for s in sets)
            if key not in numbers:
                numbers[key] = len(numbers)
                sample.append(byte)
            of[byte] = numbers[key]
        self.class_of, self.end = bytes(of), len(sample)
        return sample

    def _advance(self, rule: int, part: _Part, byte: int | None) -> tuple[_Part, bool]:
        """One rule's next part, and whether a match ended before this byte (None: the
        text's end)."""
        nfa = self.nfas[rule]
        threads, found = part
        moved, seen = [], set()
        for thread in threads if byte is not None else ():
            alive = nfa.step(nfa.next(thread) - seen, byte)
            if alive:
                moved.append(alive)
                seen |= alive
        if found and not moved:
            return self._advance(rule, _FRESH, byte)[0], True
        if byte is not None and not found:
            begun = nfa.step(nfa.first - seen, byte)
            if begun:
                moved.append(begun)
        for i, thread in enumerate(moved):
            if not thread.isdisjoint(nfa.last):
                return (tuple(moved[: i + 1]), True), False
        if found:
            raise ValueError(f"{self.rules[rule].kind} must be followed beyond its match")
        return (tuple(moved), False), False

    def _compile(self) -> None:
        sample = self._classes()
        width = self.end + 1
        if width > 256:
            raise ValueError("too many classes of bytes")
        parts: dict[tuple, tuple[_Part, bool]] = {}
        first = (_FRESH,) * len(self.rules)
        numbers, states, rows = {first: 0}, [first], []
        for state in states:  # grows while it is walked
            row = []
            for byte in [*sample, None]:
                target, ended = [], 0
                for rule, part in enumerate(state):
                    key = rule, part, byte
                    if key not in parts:
                        parts[key] = self._advance(rule, part, byte)
                    moved, over = parts[key]
                    target.append(moved)
                    ended |= over << rule
                number = numbers.setdefault(tuple(target), len(states))
                if number == len(states):
                    if number > MAX_STATES:
                        raise ValueError("the rules need too many states")
                    states.append(tuple(target))
                row.append((number, ended))
            rows.append(row)
        self.n_subsets = len(states)
        self._minimise(rows, width)

    def _minimise(self, rows: list[list[tuple[int, int]]], width: int) -> None:
        block = [0] * len(rows)
        n_blocks = 0
        while True:
            keys: dict[tuple, int] = {}
            refined = [
                keys.setdefault((block[s], *((block[t], e) for t, e in row)), len(keys)) for s, row in enumerate(rows)
            ]
            if len(keys) == n_blocks:
                break
            block, n_blocks = refined, len(keys)
        self.n_states = n_blocks
        self.actions: list[tuple[int, tuple[int, ...]]] = []
        known: dict[tuple[int, int], int] = {}
        table = array("i", bytes(4 * n_blocks * width))
        done: set[int] = set()
        for s, row in enumerate(rows):
            if block[s] in done:
                continue
            done.add(block[s])
            for c, (target, ended) in enumerate(row):
                step = block[target] * width
                if ended:
                    key = step, ended
                    if key not in known:
                        known[key] = len(self.actions)
                        self.actions.append((step, tuple(r for r in range(len(self.rules)) if ended >> r & 1)))
                    step = -1 - known[key]
                table[block[s] * width + c] = step
        self.start = block[0] * width
        self.table = table

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(end, rule) of every match, lengths unchecked: the one pass over the bytes."""
        table, actions, state, found = self.table, self.actions, self.start, []
        for at, c in enumerate(data.translate(self.class_of) + bytes([self.end])):
            state = table[state + c]
            if state < 0:
                state, rules = actions[-1 - state]
                found += [(at, rule) for rule in rules]
        return found

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then by the rules' order."""
        data = text.encode("utf-8")
        plain = len(data) == len(text)
        before = [0] * len(self.rules)
        found = []
        for end, rule in self.ends(data):
            low, before[rule] = before[rule], end
            start = end - self.backward[rule].longest(_back(data, end, low))
            head = self.heads[rule]
            counted = start + head.longest(data[start:end]) if head else start
            if end - counted >= self.rules[rule].least:
                found.append((start, rule, end))
        found.sort()
        if not plain:
            found = _code_points(data, found)
        return [(self.rules[rule].kind, start, end) for start, rule, end in found]


def _back(data: bytes, end: int, low: int) -> Iterator[int]:
    for at in range(end - 1, low - 1, -1):
        yield data[at]


def _code_points(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets as code points, each stretch between two offsets decoded once."""
    offsets = sorted({o for start, _, end in found for o in (start, end)})
    points, at, count = {}, 0, 0
    for offset in offsets:
        count += len(data[at:offset].decode("utf-8"))
        points[offset], at = count, offset
    return [(points[start], rule, points[end]) for start, rule, end in found]


def scan_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", into: str = "secrets"
) -> DataFrame:
    """``docs`` with an array of (kind, start, end) for each text: the spans of all rules
    by start, then in the rules' order. The rules are compiled once; the workers get the
    table, at most MAX_STATES rows and 1 MB for these rules."""
    compiled = docs.sparkSession.sparkContext.broadcast(Automaton(rules))

    def scan(batches: Iterable[pd.Series]) -> Iterator[pd.Series]:
        own = compiled.value
        for texts in batches:
            yield pd.Series(
                [[{"kind": k, "start": a, "end": b} for k, a, b in own.spans(t)] if t else [] for t in texts],
                dtype="object",
            )

    scan.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(scan, "array<struct<kind:string,start:long,end:long>>")
    return docs.withColumn(into, udf(F.coalesce(F.col(text), F.lit(""))))
