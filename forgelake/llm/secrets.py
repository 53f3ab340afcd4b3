"""Secret scans with one combined deterministic automaton.

The rules' regexes are compiled to one non-deterministic automaton over bytes, made
deterministic by subset construction, minimised by partition refinement and laid out as
transition rows. Every text is read once, byte by byte from its end: the automaton of the
reversed rules tells at each byte which rules have a match beginning there. Matches are then
taken per rule from left to right without overlap; only they are read a second time, by the
rule's own forward automaton, which gives the longest end.

Regex syntax: literals, ``\\xNN`` and escaped characters, ``[...]`` with ranges, groups,
``|``, ``?``, ``*``, ``+``, ``{n}`` and ``{n,}``; ASCII only. A rule may ignore the case of
letters outside classes.

Defined cases. A null text counts as empty; both have no spans. Every row, repeated or not,
gets its own result. Spans count code points, end exclusive. Very long texts are read whole; an
empty table gives no rows; columns named like a result column are replaced, others pass through.
Matches of one rule that begin at one place are one, the longest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.llm.textblocks import raw_texts, slices


@dataclass(frozen=True)
class Rule:
    """A match counts if it has ``least`` bytes, not counting the longest match of ``head`` at
    its beginning; shorter ones are dropped after matching. Open repetitions are better
    counted here than in the pattern: counters of many rules multiply the states."""

    kind: str
    pattern: str
    least: int = 0
    head: str = ""
    any_case: bool = False


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
# The base rules, then public formats of access credentials.
BASE_RULES = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=\-]+", 6, _ASSIGN, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_\-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 36),
    Rule("key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)
BASE_KINDS = tuple(r.kind for r in BASE_RULES)


class _Nfa:
    """States with byte transitions and silent moves; fragments are (entry, exit)."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.silent: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.silent.append([])
        return len(self.moves) - 1

    def build(self, node, backward: bool) -> tuple[int, int]:
        """Fragment of a syntax tree; ``backward`` reads sequences from their end."""
        kind, *args = node
        a, z = self.state(), self.state()
        if kind == "bytes":
            self.moves[a].append((args[0], z))
        elif kind == "seq":
            last = a
            for part in reversed(args[0]) if backward else args[0]:
                x, y = self.build(part, backward)
                self.silent[last].append(x)
                last = y
            self.silent[last].append(z)
        elif kind == "any":
            for part in args[0]:
                x, y = self.build(part, backward)
                self.silent[a].append(x)
                self.silent[y].append(z)
        else:  # repeat: least times, then once at most or without end
            part, least, most = args
            last = a
            for _ in range(least):
                x, y = self.build(part, backward)
                self.silent[last].append(x)
                last = y
            self.silent[last].append(z)
            if most != least:
                x, y = self.build(part, backward)
                self.silent[last].append(x)
                self.silent[y].append(z if most == 1 else last)
        return a, z

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.silent[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def parsed(pattern: str, any_case: bool = False):
    """Syntax tree of a pattern."""
    at = 0

    def escaped() -> int:
        nonlocal at
        at += 1
        if pattern[at] == "x":
            at += 3
            return int(pattern[at - 2 : at], 16)
        at += 1
        return ord(pattern[at - 1])

    def char() -> int:
        nonlocal at
        if pattern[at] == "\\":
            return escaped()
        at += 1
        return ord(pattern[at - 1])

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            inner = choice()
            at += 1
            return inner
        if pattern[at] == "[":
            at += 1
            members: set[int] = set()
            while pattern[at] != "]":
                low = high = char()
                if pattern[at] == "-":
                    at += 1
                    high = char()
                members.update(range(low, high + 1))
            at += 1
            return "bytes", frozenset(members)
        c = chr(char())
        return "bytes", frozenset(map(ord, {c.lower(), c.upper()} if any_case else {c}))

    def repeated():
        nonlocal at
        node = atom()
        while at < len(pattern) and pattern[at] in "?*+{":
            if pattern[at] == "{":
                end = pattern.index("}", at)
                low, comma, _ = pattern[at + 1 : end].partition(",")
                node = "repeat", node, int(low), None if comma else int(low)
                at = end
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
                node = "repeat", node, least, most
            at += 1
        return node

    def choice():
        nonlocal at
        options, parts = [], []
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                at += 1
                options.append(("seq", parts))
                parts = []
            else:
                parts.append(repeated())
        return "any", [*options, ("seq", parts)]

    return choice()


def automaton(trees: list, backward: bool, search: bool) -> tuple[list[list[int]], list[int]]:
    """Minimal deterministic automaton of all trees: transitions by state and byte, and the
    bit set of accepted rules by state; state 0 begins. ``search`` lets a match begin at any
    byte."""
    nfa = _Nfa()
    ends: dict[int, int] = {}
    entries = []
    for i, tree in enumerate(trees):
        a, z = nfa.build(tree, backward)
        entries.append(a)
        ends[z] = 1 << i
    begin = nfa.closed(entries)
    # Bytes that no rule tells apart share a column until the rows are laid out.
    sets = list({members for state in nfa.moves for members, _ in state})
    column = {b: tuple(b in s for s in sets) for b in range(256)}
    groups = list(dict.fromkeys(column.values()))
    sample = {g: next(b for b in range(256) if column[b] == g) for g in groups}
    number, rows, todo = {begin: 0}, [], [begin]
    for states in todo:
        row = []
        for g in groups:
            b = sample[g]
            reached = {t for s in states for members, t in nfa.moves[s] if b in members}
            target = nfa.closed(reached) | (begin if search else frozenset())
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    accepts = [sum(bit for z, bit in ends.items() if z in states) for states in number]
    # Minimise: split classes until all members move to the same classes.
    block = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    of = [block[a] for a in accepts]
    while True:
        keys = [(of[s], *(of[t] for t in rows[s])) for s in range(len(rows))]
        names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        new = [names[k] for k in keys]
        if len(names) == len(set(of)):
            break
        of = new
    first = {c: of.index(c) for c in dict.fromkeys(of)}
    order = {c: i for i, c in enumerate(first)}
    index = [groups.index(column[b]) for b in range(256)]
    small = [[order[of[t]] for t in rows[s]] for s in first.values()]
    return [[row[g] for g in index] for row in small], [accepts[s] for s in first.values()]


Forward = tuple[list[list[int]], list[int], set[int]]


def _forward(tree) -> Forward:
    rows, accepts = automaton([tree], backward=False, search=False)
    return rows, accepts, {s for s, row in enumerate(rows) if not accepts[s] and set(row) == {s}}


def longest(machine: Forward, text: bytes, at: int) -> int:
    """End of the longest match that begins at ``at``."""
    rows, accepts, dead = machine
    state, end = 0, at
    for i in range(at, len(text)):
        state = rows[state][text[i]]
        if state in dead:
            break
        if accepts[state]:
            end = i + 1
    return end


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        trees = [parsed(r.pattern, r.any_case) for r in rules]
        table, self.accepts = automaton(trees, backward=True, search=True)
        # A row holds the rows it leads to, and its own number at the end.
        self.table: list[list] = [[] for _ in table]
        for i, row in enumerate(table):
            self.table[i] += [self.table[t] for t in row] + [self.accepts[i]]
        self.whole = [_forward(t) for t in trees]
        self.heads = [_forward(parsed(r.head, r.any_case)) if r.head else None for r in rules]

    def starts(self, text: bytes) -> list[list[tuple[int, int]]]:
        """For each rule the ranges of places where some match begins, from the left."""
        hits: list[list[int]] = []
        row, low, held = self.table[0], -1, 0
        for at, b in zip(range(len(text) - 1, -1, -1), reversed(text)):
            row = row[b]
            if row[256]:
                if at + 1 == low and row[256] == held:
                    hits[-1][0] = at
                else:
                    held = row[256]
                    hits.append([at, at + 1, held])
                low = at
        hits.reverse()
        return [[(a, z) for a, z, bits in hits if bits >> i & 1] for i in range(len(self.rules))]

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes, ordered by start, then rule."""
        out = []
        for i, places in enumerate(self.starts(text)):
            rule, done = self.rules[i], 0
            for low, high in places:
                at = max(low, done)
                while at < high:
                    done = longest(self.whole[i], text, at)
                    head = longest(self.heads[i], text, at) if rule.head else at
                    if done - head >= rule.least:
                        out.append((i, at, done))
                    at = done
        return sorted(out, key=lambda s: (s[1], s[0]))


@cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row the id and ``found``: kind, start and end of every span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = scanner(rules)
        for batch in slices(batches, "text"):
            found = []
            for text in raw_texts(batch, "text"):
                spans = machine.spans(text) if text else []
                if spans and not text.isascii():
                    points = _code_points(text, spans)
                    spans = [(i, points[a], points[b]) for i, a, b in spans]
                found.append([{"kind": rules[i].kind, "start": a, "end": b} for i, a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, _SPANS)], names=[id_col, "found"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, narrow.schema["id"].dataType)]).add("found", SPANS)
    return narrow.mapInArrow(run, schema)


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> dict[int, int]:
    """Code point offsets of the spans' byte offsets."""
    out, done, count = {}, 0, 0
    for at in sorted({x for _, a, b in spans for x in (a, b)}):
        count += len(text[done:at].decode())
        out[at], done = count, at
    return out


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and the spans as text, from ``scan``."""

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    spans = F.col("found")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))
