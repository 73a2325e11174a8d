"""Regular expressions over bytes to one minimal deterministic automaton.

Rules are parsed, joined into one nondeterministic automaton, made deterministic by
subset construction over classes of bytes that no rule tells apart, and minimised by
partition refinement.  The result is a transition array (states x byte classes) and, for
each state, a bit for each rule that accepts there.
"""

from __future__ import annotations

import re._constants as c
import re._parser as parser
from dataclasses import dataclass

#: Repeats are unrolled up to here; the rules in use need far less.
MAX_STATES = 20_000


@dataclass(frozen=True)
class Automaton:
    classes: bytes  # byte -> class, for bytes.translate
    rows: tuple[tuple[int, ...], ...]  # state, class -> state; -1 where no rule can go on
    accepts: tuple[int, ...]
    start: int

    def linked(self) -> list:
        """The start row of the transition arrays as rows that hold rows; the last entry of a row is its accept bits."""
        rows = [[] for _ in self.rows]
        dead: list = []
        for own, to, bits in zip(rows, self.rows, self.accepts):
            own.extend(rows[t] if t >= 0 else dead for t in to)
            own.append(bits)
        return rows[self.start]


class _Nfa:
    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def build(self, tree, at: int, backwards: bool) -> int:
        """Add a path for tree from state at; its end state. backwards: for the reversed language."""
        for op, arg in reversed(list(tree)) if backwards else tree:
            at = self._one(op, arg, at, backwards)
        return at

    def _one(self, op, arg, at: int, backwards: bool) -> int:
        if op in (c.LITERAL, c.NOT_LITERAL, c.IN, c.ANY):
            to = self.state()
            self.moves[at].append((_bytes(op, arg), to))
            return to
        if op is c.SUBPATTERN:
            return self.build(arg[3], at, backwards)
        if op is c.BRANCH:
            to = self.state()
            for tree in arg[1]:
                self.free[self.build(tree, at, backwards)].append(to)
            return to
        if op in (c.MAX_REPEAT, c.MIN_REPEAT):
            least, most, tree = arg
            for _ in range(least):
                at = self.build(tree, at, backwards)
            if most is c.MAXREPEAT:
                loop = self.state()
                self.free[at].append(loop)
                self.free[self.build(tree, loop, backwards)].append(loop)
                return loop
            ends = [at]
            for _ in range(most - least):
                at = self.build(tree, at, backwards)
                ends.append(at)
            to = self.state()
            for e in ends:
                self.free[e].append(to)
            return to
        raise ValueError(f"rules of this kind have no {op}")


def _bytes(op, arg) -> frozenset[int]:
    if op is c.ANY:
        return frozenset(range(256)) - {10}
    if op is c.LITERAL:
        return frozenset([arg])
    if op is c.NOT_LITERAL:
        return frozenset(range(256)) - {arg}
    out: set[int] = set()
    negated = False
    for kind, x in arg:
        if kind is c.NEGATE:
            negated = True
        elif kind is c.LITERAL:
            out.add(x)
        elif kind is c.RANGE:
            out.update(range(x[0], x[1] + 1))
        else:
            raise ValueError(f"rules of this kind have no {kind}")
    return frozenset(range(256)) - out if negated else frozenset(out)


def compile_rules(rules: list[str], backwards: bool = False, anywhere: bool = False) -> Automaton:
    """backwards: for reversed bytes; anywhere: a match may begin at any byte, else only at the first."""
    nfa = _Nfa()
    start = nfa.state()
    final: dict[int, int] = {}
    for k, rule in enumerate(rules):
        own = nfa.state()
        nfa.free[start].append(own)
        end = nfa.build(parser.parse(rule.encode()), own, backwards)
        final[end] = final.get(end, 0) | 1 << k
    if anywhere:
        nfa.moves[start].append((frozenset(range(256)), start))

    sets = {s for moves in nfa.moves for s, _ in moves}
    kinds: dict[tuple[bool, ...], int] = {}
    ordered = sorted(sets, key=sorted)
    classes = bytes(kinds.setdefault(tuple(b in s for s in ordered), len(kinds)) for b in range(256))
    one_of = {k: classes.index(k) for k in range(len(kinds))}

    def closed(states) -> frozenset[int]:
        todo = list(states)
        out = set(todo)
        while todo:
            for t in nfa.free[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(out)

    first = closed([start])
    number = {first: 0}
    rows: list[list[int]] = []
    todo = [first]
    for own in todo:  # grows while it is walked
        row = []
        for k in range(len(kinds)):
            b = one_of[k]
            to = closed(t for s in own for on, t in nfa.moves[s] if b in on)
            if not to:
                row.append(-1)
                continue
            if to not in number:
                if len(number) >= MAX_STATES:
                    raise ValueError("the rules make too many states")
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    accepts = [0] * len(number)
    for own, n in number.items():
        for s in own:
            accepts[n] |= final.get(s, 0)
    return _minimal(classes, rows, accepts)


def _minimal(classes: bytes, rows: list[list[int]], accepts: list[int]) -> Automaton:
    """States that no input tells apart are one: refine the partition by accept bits until it is stable."""
    block = [sorted(set(accepts)).index(a) for a in accepts]
    count = len(set(block))
    while True:
        keys: dict[tuple, int] = {}
        finer = [keys.setdefault((block[s], *(block[t] if t >= 0 else -1 for t in row)), len(keys)) for s, row in enumerate(rows)]
        block = finer
        if len(keys) == count:
            break
        count = len(keys)
    out_rows: dict[int, tuple[int, ...]] = {}
    out_accepts: dict[int, int] = {}
    for s, row in enumerate(rows):
        out_rows.setdefault(block[s], tuple(block[t] if t >= 0 else -1 for t in row))
        out_accepts.setdefault(block[s], accepts[s])
    n = len(out_rows)
    return Automaton(classes, tuple(out_rows[k] for k in range(n)), tuple(out_accepts[k] for k in range(n)), block[0])
