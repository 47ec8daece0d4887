"""Secret scan with one deterministic automaton for all rules.

A rule is a prefix and a run of bytes of one class after it. All rules are compiled, reversed, to an NFA over bytes, then by
subset construction and minimisation to one table ``next_state[state, byte class]`` whose accepting states name the rules.
One pass over the bytes, from the right, runs every rule whole and tells for each byte which rules have a match that begins
there, so no start is ever tried in vain and the work is linear in the text. Bytes that send each state back to the start
(line ends, most punctuation, every byte over 0x7F) cut the text into pieces that no match can cross, so the pieces of many
texts advance together, one NumPy step for each byte place. Lengths are counted beside the state: how far a run goes on is
known for every byte from one vectorised step for each class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .scan import text_slices
from .work import spread


@dataclass(frozen=True)
class Rule:
    """``prefix``: literals, [classes], (a|b), ?, *, + and (?i:...) over ASCII; its longest match counts. ``run``: a class of which one
    or more bytes follow (none where it is empty); ``times`` of them exactly, or all there are. A match with a shorter run than
    ``least`` is consumed, then dropped, as is one that hasn't got ``times``."""

    kind: str
    prefix: str
    run: str = ""
    least: int = 0
    times: int = 0


#: The base rules, then those that the scan adds.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 8),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
)
ADDED = (
    Rule("hosting", "gh[opsu]_", "[A-Za-z0-9]", times=36),
    Rule("chat", "xox[abprs]-", "[0-9A-Za-z-]", 10),
    Rule("webtoken", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.]", "[A-Za-z0-9_-]"),
    Rule("private", "-----BEGIN[\\x20A-Z]*PRIVATE\\x20KEY-----"),
)
RULES = BASE + ADDED


class _Nfa:
    """Thompson construction; ``moves[s]`` is [(byte set, target)], ``free[s]`` the empty moves."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, pattern: str) -> tuple[int, int]:
        self.text, self.at, self.fold = pattern, 0, False
        start, end = self._either()
        if self.at != len(pattern):
            raise ValueError(f"can't read the rule {pattern!r} from place {self.at} on")
        return start, end

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self) -> tuple[int, int]:
        parts = [self._run()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._run())
        if len(parts) == 1:
            return parts[0]
        start, end = self.state(), self.state()
        for a, b in parts:
            self.free[start].append(a)
            self.free[b].append(end)
        return start, end

    def _run(self) -> tuple[int, int]:
        start = end = self.state()
        while self._peek() not in ("", "|", ")"):
            a, b = self._repeated()
            self.free[end].append(a)
            end = b
        return start, end

    def _repeated(self) -> tuple[int, int]:
        begin = self.at
        a, b = self._one()
        piece, mark = self.text[begin : self.at], self._peek()
        if mark == "{":
            close = self.text.index("}", self.at)
            times, self.at = int(self.text[self.at + 1 : close]), close + 1
            after = self.at
            for _ in range(times - 1):
                self.at = begin
                c, d = self._one()
                self.free[b].append(c)
                b = d
            self.at = after
        elif mark and mark in "?*+":
            self.at += 1
            start, end = self.state(), self.state()
            self.free[start].append(a)
            self.free[b].append(end)
            if mark in "?*":
                self.free[start].append(end)
            if mark in "*+":
                self.free[b].append(a)
            a, b = start, end
        assert piece
        return a, b

    def _one(self) -> tuple[int, int]:
        if self._peek() == "(":
            outer = self.fold
            self.at += 1
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            a, b = self._either()
            if self._peek() != ")":
                raise ValueError("a bracket is not closed")
            self.at, self.fold = self.at + 1, outer
            return a, b
        if self._peek() == "[":
            close = self.text.index("]", self.at + 2)
            body, self.at = self.text[self.at + 1 : close], close + 1
            some: set[int] = set()
            i = 0
            while i < len(body):
                if body.startswith("\\x", i):
                    some.add(int(body[i + 2 : i + 4], 16))
                    i += 4
                elif body[i + 1 : i + 2] == "-" and i + 2 < len(body):
                    some |= set(range(ord(body[i]), ord(body[i + 2]) + 1))
                    i += 3
                else:
                    some.add(ord(body[i]))
                    i += 1
        elif self.text.startswith("\\x", self.at):
            some, self.at = {int(self.text[self.at + 2 : self.at + 4], 16)}, self.at + 4
        else:
            some, self.at = {ord(self._peek())}, self.at + 1
        if self.fold:
            some |= {ord(chr(x).swapcase()) for x in some}
        a, b = self.state(), self.state()
        self.moves[a].append((frozenset(some), b))
        return a, b

    def reversed(self) -> _Nfa:
        """The automaton of the reversed language: every move the other way round."""
        other = _Nfa()
        other.moves, other.free = [[] for _ in self.moves], [[] for _ in self.free]
        for s, moves in enumerate(self.moves):
            for some, t in moves:
                other.moves[t].append((some, s))
        for s, targets in enumerate(self.free):
            for t in targets:
                other.free[t].append(s)
        return other

    def closed(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``step[state, classes[byte]]``; ``accepts[state]`` has a bit for each pattern. State 0 is the start;
    ``dead`` is the state that nothing leaves (-1 if none)."""

    classes: np.ndarray
    step: np.ndarray
    accepts: np.ndarray
    dead: int


def compile_automaton(patterns: list[str], anywhere: bool, backwards: bool = False) -> Automaton:
    """Subset construction, then minimisation by refining the partition of states. anywhere: a match may begin at each byte;
    backwards: texts are read from their ends, and an accepting state tells whose match begins at the byte just read."""
    nfa = _Nfa()
    ends, begin = {}, set()
    for k, p in enumerate(patterns):
        a, b = nfa.add(p)
        a, b = (b, a) if backwards else (a, b)
        begin.add(a)
        ends[b] = k
    if backwards:
        nfa = nfa.reversed()
    # Bytes that no rule tells apart are one class.
    sets = sorted({m for ms in nfa.moves for m, _ in ms}, key=sorted)
    signature = [tuple(x in s for s in sets) for x in range(256)]
    kinds = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    classes = np.array([kinds[s] for s in signature], np.uint8)
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(len(kinds))]
    start = nfa.closed(begin)
    states, rows, todo = {start: 0}, [], [start]
    while todo:
        now = todo.pop(0)
        row = []
        for x in sample:
            to = {t for s in now for m, t in nfa.moves[s] if x in m} | (begin if anywhere else set())
            to = nfa.closed(to)
            if to not in states:
                states[to] = len(states)
                todo.append(to)
            row.append(states[to])
        rows.append(row)
    step = np.array(rows)
    accepts = np.array([sum({1 << ends[s] for s in now if s in ends}) for now in states])
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    first = np.unique(block, return_index=True)[1]
    order = np.argsort(first)  # the start's block comes first
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    small = place[block[step[first[order]]]]
    accept = accepts[first[order]]
    dead = [s for s in range(len(small)) if (small[s] == s).all() and not accept[s]]
    return Automaton(classes, small.astype(np.uint16), accept.astype(np.int64), dead[0] if dead else -1)


class Scanner:
    """All rules in one automaton, and each rule's prefix to tell where its run begins."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.all = compile_automaton([r.prefix + r.run for r in rules], True, True)
        self.prefixes = [compile_automaton([r.prefix], False) if r.prefix else None for r in rules]
        self.lists = [(a.step.tolist(), a.classes.tolist(), (a.accepts != 0).tolist(), a.dead) if a else None for a in self.prefixes]
        self.cuts = (self.all.step == 0).all(axis=0)[self.all.classes]
        self.runs = {r.run: _table(r.run) for r in rules if r.run}
        #: No match that counts is shorter.
        self.shortest = min((_shortest(a) if a else 0) + max(r.least, r.times, bool(r.run)) for a, r in zip(self.prefixes, rules, strict=True))

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each byte a bit for every rule that has a match beginning there; the one pass over all bytes."""
        out = np.zeros(len(data), np.uint8 if len(self.rules) <= 8 else np.int64)
        if not len(data):
            return out
        cut = self.cuts[data]
        edge = np.unique(np.concatenate([offsets, np.flatnonzero(cut), np.flatnonzero(cut) + 1]))
        begin, end = edge[:-1], edge[1:]
        keep = ~cut[begin] & (end - begin >= self.shortest)
        begin, end = begin[keep], end[keep]
        size = end - begin
        order = np.argsort(-size, kind="stable")
        begin, end, size = begin[order], end[order], size[order]
        if not len(size):
            return out
        kinds, step, accepts = self.all.classes[data], self.all.step.ravel(), self.all.accepts.astype(out.dtype)
        width = self.all.step.shape[1]
        state = np.zeros(len(size), np.intp)
        # Pieces are sorted by size: those of more than k bytes come first.
        alive = np.searchsorted(-size, -np.arange(size[0]), "left")
        for k in range(size[0]):
            n = alive[k]
            if n < 4:  # few long pieces: their bytes one by one
                break
            at = end[:n] - 1 - k
            now = step[state[:n] * width + kinds[at]]
            state[:n] = now
            out[at] = accepts[now]
        else:
            n, k = 0, int(size[0])
        rows, says = self.all.step.tolist(), self.all.accepts.tolist()
        for i in range(n):
            s = int(state[i])
            last = int(end[i]) - 1 - k
            found = []
            for c in kinds[begin[i] : last + 1][::-1].tolist():
                s = rows[s][c]
                found.append(says[s])
            out[begin[i] : last + 1] = found[::-1]
        return out

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(begin, rule, end) in bytes of all matches that count: for each rule leftmost, longest, not overlapping."""
        starts = self.starts(data, offsets)
        if not starts.any():
            return []
        ends = {run: _run_ends(member[data], offsets) for run, member in self.runs.items()}
        out = []
        for k, rule in enumerate(self.rules):
            at = np.flatnonzero(starts & (1 << k))
            if not rule.prefix:  # a match is a whole run
                stop = ends[rule.run][at]
                whole = np.ones(len(at), bool)
                whole[1:] = stop[1:] != stop[:-1]
                at, stop = at[whole], stop[whole]
                long = stop - at >= max(rule.least, 1)
                out += [(a, k, b) for a, b in zip(at[long].tolist(), stop[long].tolist(), strict=True)]
                continue
            done = 0
            for a in at.tolist():
                if a < done:
                    continue
                value = self._value(data, a, k)
                stop = int(ends[rule.run][value]) if rule.run else value
                if rule.times:
                    if stop - value < rule.times:
                        continue
                    stop = value + rule.times
                done = stop
                if stop - value >= rule.least:
                    out.append((a, k, stop))
        return out

    def _value(self, data: np.ndarray, begin: int, k: int) -> int:
        """Where the longest match of the rule's prefix ends."""
        step, classes, accepts, dead = self.lists[k]
        s, best, i = 0, begin, begin
        while i < len(data):
            s = step[s][classes[data[i]]]
            if s == dead:
                break
            i += 1
            if accepts[s]:
                best = i
        return best


def _run_ends(member: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the end of the run of members that it is in (its own place if it is none); runs end with their text."""
    n = len(member)
    stop = np.where(member, n, np.arange(n))
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    # A text's first byte ends a run that came up to it.
    limit = np.full(n, n)
    limit[inner - 1] = inner
    stop = np.minimum(stop, limit)
    return np.minimum.accumulate(stop[::-1])[::-1]


def _table(run: str) -> np.ndarray:
    """The bytes of a class, as a mask."""
    nfa = _Nfa()
    a, _ = nfa.add(run)
    out = np.zeros(256, bool)
    out[[x for s in nfa.closed({a}) for m, _ in nfa.moves[s] for x in m]] = True
    return out


def _shortest(auto: Automaton) -> int:
    """Bytes of the shortest match."""
    states, n = {0}, 0
    while not auto.accepts[list(states)].any():
        states, n = set(auto.step[list(states)].ravel().tolist()), n + 1
    return n


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def find_spans(column: pa.Array, rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """For each text (begin, rule, end) in code points, sorted; null is empty."""
    scan = scanner(rules)
    out: list[list[tuple[int, int, int]]] = []
    for _, data, offsets in text_slices(column):
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
        spans = scan.spans(data, offsets)
        if spans:
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            rows = np.searchsorted(offsets, [a for a, _, _ in spans], "right") - 1
            for (a, k, b), row in zip(spans, rows.tolist(), strict=True):
                base = points[offsets[row]]
                found[row].append((int(points[a] - base), k, int(points[b] - base)))
        out += [sorted(x) for x in found]
    return out


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each row: the id, counts of the base rules, a digest of the base spans and all spans.

    Narrow: no shuffle; memory is bounded by the batch and the longest text. Null and empty texts have
    no spans. Spans are kind:begin:end in code points, end exclusive, by begin and then rule order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = len(BASE)
        for batch in batches:
            rows = find_spans(batch.column(1), rules)
            say = [[f"{rules[k].kind}:{a}:{b}" for a, k, b in r] for r in rows]
            only = [",".join(s for s, (_, k, _) in zip(x, r, strict=True) if k < base) for x, r in zip(say, rows, strict=True)]
            counts = [pa.array([sum(k == i for _, k, _ in r) for r in rows], pa.int64()) for i in range(base)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([hashlib.sha256(s.encode()).hexdigest() for s in only], pa.string()), pa.array([",".join(x) for x in say], pa.string())],
                names=[batch.schema.names[0], "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    source = docs.select(id_col, text_col)
    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, {RESULT}")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


QUERIES = {"op10_secret_scan": op10_secret_scan}
ORACLE: dict[str, str] = {}
