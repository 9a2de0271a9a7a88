"""One automaton for many rules: regular expressions over bytes compiled by subset construction and minimisation.

A rule's scanner is a deterministic automaton that reads a text once and, at every byte, says whether the rule's current
match reaches up to here. Its states are lists of thread sets, the earliest begun first, so matches are the leftmost ones,
as long as they get, and begin after the one before has ended. A rule must have two properties, which are checked while it
is compiled: a match that has become complete stays complete for each byte that it still takes (so it ends where the
automaton falls back to its start, and no byte is read twice), and no later match is complete before an earlier one that is
still open. Scanners of all rules are run as one: their product, minimised again, with a bit for each rule.

Texts are joined by byte 0xFF, which no UTF-8 text holds and which ends every match. The joined bytes are cut into equal
lanes that numpy advances together, one byte of each lane a step. A lane begins in the start state; where the lane before
it ends in another one, it is read again from that state until both readings agree.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

BREAK = 0xFF
ANY = (1 << BREAK) - 1  # every byte but the break
LANE = 512


@dataclass(frozen=True)
class Rule:
    """`pattern` as in `re` over bytes: literals, classes, groups, alternatives, greedy repeats. `fold`: ASCII letters in either case.

    Matches shorter than `least` bytes are dropped after they have taken their place; with `tail` only the bytes count
    from where the match first became complete, less one (the last repeated class of the pattern).
    """

    name: str
    pattern: str
    least: int = 0
    tail: bool = False
    fold: bool = False


class Nfa:
    """Thompson's construction: `edges[s]` as (bytes as a bit mask, target), `free[s]` targets without a byte."""

    def __init__(self, rule: Rule):
        parser, self.names = re._parser, re._constants
        self.edges: list[list[tuple[int, int]]] = []
        self.free: list[list[int]] = []
        self.fold, self.start = rule.fold, self._new()
        self.final = self._sequence(parser.parse(rule.pattern.encode("ascii")), self.start)

    def _new(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def _byte(self, mask: int, at: int) -> int:
        if self.fold:
            upper, lower = mask >> 0x41 & (1 << 26) - 1, mask >> 0x61 & (1 << 26) - 1
            mask |= upper << 0x61 | lower << 0x41
        to = self._new()
        self.edges[at].append((mask & ANY, to))
        return to

    def _set(self, items: list) -> int:
        n, mask, negated = self.names, 0, False
        for kind, value in items:
            if kind is n.NEGATE:
                negated = True
            elif kind is n.LITERAL:
                mask |= 1 << value
            elif kind is n.RANGE:
                mask |= (1 << value[1] + 1) - (1 << value[0])
            else:
                raise ValueError(f"A rule can't have {kind} in a class")
        return ANY & ~mask if negated else mask

    def _sequence(self, items, at: int) -> int:
        for kind, value in items:
            at = self._item(kind, value, at)
        return at

    def _item(self, kind, value, at: int) -> int:
        n = self.names
        if kind is n.LITERAL:
            return self._byte(1 << value, at)
        if kind is n.NOT_LITERAL:
            return self._byte(ANY & ~(1 << value), at)
        if kind is n.IN:
            return self._byte(self._set(value), at)
        if kind is n.SUBPATTERN and not value[1] and not value[2]:
            return self._sequence(value[3], at)
        if kind is n.BRANCH:
            end = self._new()
            for branch in value[1]:
                self.free[self._sequence(branch, at)].append(end)
            return end
        if kind is n.MAX_REPEAT:
            low, high, inner = value
            for _ in range(low):
                at = self._sequence(inner, at)
            if high is n.MAXREPEAT:
                loop, end = self._new(), self._new()
                self.free[at] += [loop, end]
                self.free[self._sequence(inner, loop)] += [loop, end]
                return end
            end = self._new()
            for _ in range(high - low):
                self.free[at].append(end)
                at = self._sequence(inner, at)
            self.free[at].append(end)
            return end
        raise ValueError(f"A rule can't have {kind}")

    def reversed(self) -> Nfa:
        other = object.__new__(Nfa)
        other.edges, other.free = [[] for _ in self.edges], [[] for _ in self.edges]
        for s, (edges, free) in enumerate(zip(self.edges, self.free, strict=True)):
            for mask, to in edges:
                other.edges[to].append((mask, s))
            for to in free:
                other.free[to].append(s)
        other.start, other.final = self.final, self.start
        return other

    def closure(self, states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            new = [s for s in self.free[todo.pop()] if s not in found]
            found.update(new)
            todo += new
        return frozenset(found)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({to for s in states for mask, to in self.edges[s] if mask >> byte & 1})

    def classes(self) -> np.ndarray:
        """The number of each byte's class: bytes of a class are in the same masks."""
        masks = sorted({mask for edges in self.edges for mask, _ in edges})
        signs = [tuple(mask >> b & 1 for mask in masks) for b in range(256)]
        number = {sign: k for k, sign in enumerate(dict.fromkeys(signs))}
        return np.array([number[s] for s in signs])


@dataclass
class Dfa:
    """`table[state, class]`, the class of each byte, and the marks of each state (a bit for each rule); state 0 is the start."""

    table: np.ndarray
    of_byte: np.ndarray
    marks: np.ndarray

    def minimal(self) -> Dfa:
        """Moore's refinement of the partition by marks, then classes of bytes that no state tells apart joined."""
        block = np.unique(self.marks, return_inverse=True)[1]
        while True:
            new = block
            for c in range(self.table.shape[1]):
                new = np.unique(new * (len(self.table) + 1) + block[self.table[:, c]], return_inverse=True)[1]
            if new.max() == block.max():
                break
            block = new
        first = np.unique(block, return_index=True)[1]
        order = first[np.lexsort((first, self.marks[first]))]  # unmarked states first, the start before all others
        number = np.empty(len(first), np.int64)
        number[block[order]] = np.arange(len(order))
        table = number[block[self.table[order]]]
        columns, back = np.unique(table, axis=1, return_inverse=True)
        return Dfa(columns, back.reshape(-1)[self.of_byte], self.marks[order])


def explored(start, step: Callable, marked: Callable, of_byte: np.ndarray) -> Dfa:
    """Subset construction: the automaton of all states that `step(state, byte)` reaches from `start`."""
    samples = [int(np.flatnonzero(of_byte == c)[0]) for c in range(of_byte.max() + 1)]
    number, order, table = {start: 0}, [start], []
    for state in order:  # grows while it is read
        row = []
        for byte in samples:
            to = step(state, byte)
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    return Dfa(np.array(table, np.int64), of_byte, np.array([int(marked(s)) for s in order], np.int64)).minimal()


def scanner(rule: Rule) -> Dfa:
    """The automaton of one rule; states are (thread sets, earliest begun first; whether the first is complete)."""
    nfa = Nfa(rule)
    begin = nfa.closure({nfa.start})
    if nfa.final in begin:
        raise ValueError(f"Rule {rule.name} matches nothing at all")

    def fresh(groups: list[frozenset[int]], byte: int, restarted: bool) -> tuple:
        seen: set[int] = set()
        out = []
        for group in [*groups, nfa.step(begin, byte)]:
            group = group - seen
            seen |= group
            if group:
                out.append(group)
        if any(nfa.final in g for g in out[1:]) and nfa.final not in out[0]:
            raise ValueError(f"Rule {rule.name}: a later match is complete before an earlier one")
        if out and nfa.final in out[0]:
            if restarted:
                raise ValueError(f"Rule {rule.name} has matches of one byte")
            return (out[0],), True
        return tuple(out), False

    def step(state: tuple, byte: int) -> tuple:
        groups, complete = state
        if not complete:
            return fresh([nfa.step(g, byte) for g in groups], byte, not groups)
        rest = nfa.step(groups[0], byte)
        if rest and nfa.final not in rest:
            raise ValueError(f"Rule {rule.name}: a complete match becomes incomplete")
        return ((rest,), True) if rest else fresh([], byte, True)

    return explored(((), False), step, lambda s: s[1], nfa.classes())


def backward(rule: Rule) -> Dfa:
    """The automaton that reads a match from its end to its start; the last state is where nothing can follow."""
    nfa = Nfa(rule).reversed()
    return explored(nfa.closure({nfa.start}), nfa.step, lambda s: nfa.final in s, nfa.classes())


def combined(parts: list[Dfa]) -> Dfa:
    """The product of the scanners, a bit for each, minimised."""
    signs = np.stack([p.of_byte for p in parts], axis=1)
    unique, of_byte = np.unique(signs, axis=0, return_inverse=True)
    sizes = np.array([len(p.table) for p in parts], np.int64)
    if np.prod(sizes.astype(float)) > 2**62:
        raise ValueError("Too many rules for one automaton")
    base = np.r_[1, np.cumprod(sizes[:-1])]
    known, front, table = np.zeros(1, np.int64), np.zeros((1, len(parts)), np.int64), []
    keys: list[np.ndarray] = []
    while len(front):
        to = np.stack([p.table[front[:, k]][:, unique[:, k]] for k, p in enumerate(parts)])
        key = np.tensordot(base, to, axes=1)
        keys.append(front @ base)
        table.append(key)
        new = np.setdiff1d(np.unique(key), known)
        known = np.union1d(known, new)
        front = new[:, None] // base % sizes
    key, rows = np.concatenate(keys), np.concatenate(table)
    order = np.argsort(key)
    number = np.empty(len(key), np.int64)
    number[order] = np.arange(len(key))
    at = order[np.searchsorted(key[order], rows)]  # positions in `key`, whose first is the start
    marks = sum(p.marks[key // b % s] << k for k, (p, b, s) in enumerate(zip(parts, base, sizes, strict=True)))
    return Dfa(at, of_byte.reshape(-1), marks).minimal()


class Scanner:
    """Matches of all rules in joined texts."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        whole = combined([scanner(r) for r in rules])
        self.width = whole.table.shape[1]
        self.table = (whole.table * self.width).astype(np.int32).ravel()  # entries are places of rows
        self.of_byte = whole.of_byte.astype(np.int32)
        self.marks = whole.marks
        self.marked_from = int(np.flatnonzero(whole.marks)[0]) * self.width
        self.back = [backward(r) for r in rules]

    def states(self, data: np.ndarray) -> np.ndarray:
        """The automaton's state after each byte of the joined texts."""
        lanes = max(1, -(-len(data) // LANE))
        padded = np.full(lanes * LANE, BREAK, np.uint8)
        padded[: len(data)] = data
        kinds = np.ascontiguousarray(self.of_byte[padded].reshape(lanes, LANE).T)
        out, state = np.empty((LANE, lanes), np.int32), np.zeros(lanes, np.int32)
        for k in range(LANE):
            state = np.take(self.table, state + kinds[k], out=out[k], mode="clip")
        begun = np.zeros(lanes, np.int32)
        while True:
            entry = np.r_[np.int32(0), out[-1, :-1]]
            lane = np.flatnonzero(entry != begun)
            if not len(lane):
                return out.T.ravel()[: len(data)]
            begun[lane] = state = entry[lane]
            for k in range(LANE):
                state = self.table[state + kinds[k, lane]]
                other = state != out[k, lane]
                lane, state = lane[other], state[other]
                if not len(lane):
                    break
                out[k, lane] = state

    def starts(self, data: np.ndarray, rule: int, complete: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Where the matches begin that are first complete at these bytes, each not before its bound: read backwards, the longest."""
        back = self.back[rule]
        dead = (back.table == np.arange(len(back.table))[:, None]).all(axis=1) & (back.marks == 0)
        found, state, at, todo = complete.copy(), np.zeros(len(complete), np.int64), complete.copy(), np.arange(len(complete))
        while len(todo):
            state = back.table[state, back.of_byte[data[at]]]
            hit = back.marks[state] > 0
            found[todo[hit]] = at[hit]
            live = ~dead[state] & (at > bound[todo])
            todo, state, at = todo[live], state[live], at[live] - 1
        return found

    def matches(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rule, start, end) of all matches in the joined texts that are long enough, by start and rule."""
        states = self.states(data)
        place = np.flatnonzero(states >= self.marked_from)
        marks = self.marks[states[place] // self.width]
        out = []
        for k, rule in enumerate(self.rules):
            at = place[marks >> k & 1 == 1]
            first = np.flatnonzero(np.r_[True, np.diff(at) > 1]) if len(at) else at
            complete = at[first]
            end = at[np.r_[first[1:], len(at)] - 1] + 1 if len(at) else at
            start = self.starts(data, k, complete, np.r_[0, end[:-1]] if len(at) else at)
            long = end - (complete if rule.tail else start) >= rule.least
            out.append((np.full(long.sum(), k), start[long], end[long]))
        rule, start, end = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((rule, start))
        return rule[order], start[order], end[order]
