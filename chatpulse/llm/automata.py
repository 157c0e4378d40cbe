"""Regular expressions over bytes as minimal deterministic automata.

The syntax is literals, escapes (``\\xHH`` and escaped punctuation), classes,
groups, ``|``, ``?``, ``*``, ``+`` and ``{m}``, ``{m,}``, ``{m,n}``. A match is
the leftmost and there the longest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _parse(pattern: str, ignore_case: bool):
    """The pattern as nested tuples: ("set", bytes), ("cat", ...), ("alt", ...), ("rep", x, m, n)."""
    at = 0

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c != "\\":
            return ord(c)
        at += 1
        if pattern[at - 1] == "x":
            at += 2
            return int(pattern[at - 2 : at], 16)
        return ord(pattern[at - 1])

    def bytes_of(low: int, high: int) -> frozenset[int]:
        some = set(range(low, high + 1))
        if ignore_case:
            some |= {ord(chr(b).swapcase()) for b in some if b < 128 and chr(b).isalpha()}
        return frozenset(some)

    def one():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            inner = any_of()
            at += 1
            return inner
        if pattern[at] != "[":
            c = char()
            return ("set", bytes_of(c, c))
        at += 1
        members: frozenset[int] = frozenset()
        while pattern[at] != "]":
            low = high = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                high = char()
            members |= bytes_of(low, high)
        at += 1
        return ("set", members)

    def repeated():
        nonlocal at
        item = one()
        while at < len(pattern) and pattern[at] in "?*+{":
            mark = pattern[at]
            at += 1
            if mark == "{":
                close = pattern.index("}", at)
                low, comma, high = pattern[at:close].partition(",")
                at = close + 1
                item = ("rep", item, int(low), int(high) if high else None if comma else int(low))
            else:
                item = ("rep", item, int(mark == "+"), 1 if mark == "?" else None)
        return item

    def sequence():
        parts = []
        while at < len(pattern) and pattern[at] not in "|)":
            parts.append(repeated())
        return ("cat", parts)

    def any_of():
        nonlocal at
        parts = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            parts.append(sequence())
        return ("alt", parts)

    return any_of()


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def build(self, tree, begin: int) -> int:
        """Adds the tree after ``begin``; the state in which it is matched."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[begin] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                step = self.state()
                self.free[begin].append(step)
                begin = self.build(part, step)
            return begin
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                branch = self.state()
                self.free[begin].append(branch)
                self.free[self.build(part, branch)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            step = self.state()
            self.free[begin].append(step)
            begin = self.build(part, step)
        if most is None:
            loop = self.state()
            self.free[begin].append(loop)
            inner = self.state()
            self.free[loop].append(inner)
            self.free[self.build(part, inner)].append(loop)
            begin = loop
        else:
            end = self.state()
            self.free[begin].append(end)
            for _ in range(most - least):
                step = self.state()
                self.free[begin].append(step)
                begin = self.build(part, step)
                self.free[begin].append(end)
            begin = end
        last = self.state()
        self.free[begin].append(last)
        return last

    def closed(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for target in self.free[todo.pop()]:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return frozenset(seen)


@dataclass
class Automaton:
    """An automaton in transition arrays.

    ``steps[state + classes[byte]]`` is the next state; states are multiples of
    the number of byte classes, 0 is the first and those from ``edge`` on
    accept the patterns in the bits of ``accepts[state]``.
    """

    classes: bytes
    steps: list[int]
    edge: int
    accepts: dict[int, int]
    dead: int


def compile_patterns(patterns: list[tuple[str, bool]], anywhere: bool, minimal: bool = True) -> Automaton:
    """Subset construction and minimisation of all ``(pattern, ignore_case)`` together.

    With ``anywhere`` a match may begin at any byte, else only at the first. Not
    minimal, an automaton is in its first state only where no match is under way.
    """
    nfa = _Nfa()
    first = nfa.state()
    ends = {}
    for bit, (pattern, ignore_case) in enumerate(patterns):
        begin = nfa.state()
        nfa.free[first].append(begin)
        ends[nfa.build(_parse(pattern, ignore_case), begin)] = 1 << bit
    sets = list(dict.fromkeys(move[0] for move in nfa.moves if move))
    kinds: dict[tuple[bool, ...], int] = {}
    classes = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
    by_class = {s: [k for member, k in kinds.items() if member[i]] for i, s in enumerate(sets)}
    width = len(kinds)

    start = nfa.closed({first})
    numbers, rows, order = {start: 0}, [], [start]
    for subset in order:
        targets: list[set[int]] = [set() for _ in range(width)]
        for state in subset:
            if nfa.moves[state]:
                for k in by_class[nfa.moves[state][0]]:
                    targets[k].add(nfa.moves[state][1])
        row = []
        for reached in targets:
            full = nfa.closed(reached) | (start if anywhere else frozenset())
            if full not in numbers:
                numbers[full] = len(numbers)
                order.append(full)
            row.append(numbers[full])
        rows.append(row)
    table = np.array(rows, np.int64)
    accepted = np.array([sum(bits for end, bits in ends.items() if end in subset) for subset in order])

    labels = np.unique(accepted, return_inverse=True)[1].ravel() if minimal else np.arange(len(table))
    while minimal:
        finer = np.unique(np.column_stack([labels, labels[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == labels.max():
            break
        labels = finer
    chosen = np.unique(labels, return_index=True)[1]
    rank = sorted(range(len(chosen)), key=lambda g: (g != labels[0], accepted[chosen[g]] > 0, g))
    place = np.empty(len(chosen), np.int64)
    place[rank] = np.arange(len(chosen)) * width
    steps = place[labels[table[chosen[rank]]]]
    marks = accepted[chosen[rank]]
    edge = int((marks == 0).sum()) * width
    dead = next((i * width for i, row in enumerate(steps) if marks[i] == 0 and (row == i * width).all()), -1)
    return Automaton(
        classes, steps.ravel().tolist(), edge, {i * width: int(m) for i, m in enumerate(marks) if m}, dead
    )


def patterns_in(automaton: Automaton, data: bytes) -> int:
    """The bits of all patterns that match anywhere, from one pass over the bytes."""
    steps, edge, state, found = automaton.steps, automaton.edge, 0, 0
    for kind in data.translate(automaton.classes):
        state = steps[state + kind]
        if state >= edge:
            found |= automaton.accepts[state]
    return found


def matches(floating: Automaton, anchored: Automaton, data: bytes) -> list[tuple[int, int]]:
    """Leftmost-longest matches that don't overlap, of one pattern compiled both ways.

    The floating automaton, which must not be minimised, runs to the first end
    of a match. Whatever began before it was last in its first state came to
    nothing, so the match begins after that; the anchored one tells where and
    how far it goes.
    """
    kinds, fixed = data.translate(floating.classes), data.translate(anchored.classes)
    found, begin, size = [], 0, len(data)
    while begin < size:
        state, fresh, at = 0, begin, begin
        while at < size:
            state = floating.steps[state + kinds[at]]
            at += 1
            if state >= floating.edge:
                break
            if state == 0:
                fresh = at
        else:
            break
        for start in range(fresh, at):
            state, end = 0, 0
            for stop in range(start, size):
                state = anchored.steps[state + fixed[stop]]
                if state >= anchored.edge:
                    end = stop + 1
                elif state == anchored.dead:
                    break
            if end:
                break
        found.append((start, end))
        begin = end
    return found
