"""Regular expressions compiled to one deterministic automaton over bytes.

Rules become one nondeterministic automaton; subset construction makes it deterministic and
minimisation merges states that nothing distinguishes. The result is a table of transitions:
one row per state, one column per byte. A scan looks up one entry per byte for all rules.
"""

from __future__ import annotations

import numpy as np

LINKED: dict[tuple, tuple] = {}


class Nfa:
    """States are numbers; ``moves`` are (state, bytes, state) and ``jumps`` need no byte."""

    def __init__(self):
        self.size = 0
        self.moves: list[tuple[int, frozenset, int]] = []
        self.jumps: list[tuple[int, int]] = []

    def state(self) -> int:
        self.size += 1
        return self.size - 1

    def add(self, pattern: str) -> tuple[int, int]:
        """The first and last state of ``pattern``: literals, ``[...]``, ``(...)``, ``|``,
        ``? * + {n} {n,}``, ``\\xNN`` and ``\\`` before a sign. ASCII only."""
        first, last, at = self._choice(pattern, 0)
        if at != len(pattern):
            raise ValueError(f"unexpected {pattern[at]!r} at {at} in {pattern!r}")
        return first, last

    def _choice(self, p, at):
        first, last = self.state(), self.state()
        while True:
            a, b, at = self._sequence(p, at)
            self.jumps += [(first, a), (b, last)]
            if at >= len(p) or p[at] != "|":
                return first, last, at
            at += 1

    def _sequence(self, p, at):
        first = last = self.state()
        while at < len(p) and p[at] not in "|)":
            begin = at
            a, b, at = self._atom(p, at)
            least, more = 1, False
            if at < len(p) and p[at] in "?*+":
                least, more = (1 if p[at] == "+" else 0), p[at] != "?"
                optional = p[at] == "?"
                at += 1
            elif at < len(p) and p[at] == "{":
                end = p.index("}", at)
                number = p[at + 1 : end]
                least, more, optional = int(number.rstrip(",")), number.endswith(","), False
                at = end + 1
            else:
                optional = False
            for k in range(least):
                if k:
                    a, b, _ = self._atom(p, begin)
                self.jumps.append((last, a))
                last = b
            if optional or (more and not least):
                out = self.state()
                self.jumps += [(last, a), (last, out), (b, out)]
                if more:
                    self.jumps.append((b, a))
                last = out
            elif more:
                self.jumps.append((b, a))
        return first, last, at

    def _atom(self, p, at):
        if p[at] == "(":
            first, last, at = self._choice(p, at + 1)
            return first, last, at + 1
        if p[at] == "[":
            end = p.index("]", at + 2)
            chars, k = set(), at + 1
            while k < end:
                low, k = self._char(p, k)
                if k + 1 < end and p[k] == "-":
                    high, k = self._char(p, k + 1)
                    chars.update(range(low, high + 1))
                else:
                    chars.add(low)
            at = end + 1
        else:
            low, at = self._char(p, at)
            chars = {low}
        first, last = self.state(), self.state()
        self.moves.append((first, frozenset(chars), last))
        return first, last, at

    @staticmethod
    def _char(p, at):
        if p[at] != "\\":
            return ord(p[at]), at + 1
        if p[at + 1] == "x":
            return int(p[at + 2 : at + 4], 16), at + 4
        return ord(p[at + 1]), at + 2


class Dfa:
    """``table[state, columns[byte]]`` is the next state, ``accepts[state]`` the rules that end there.

    ``starts`` are NFA states; ``ends`` maps an NFA state to its rule. A searching automaton
    may begin a match at every byte.
    """

    def __init__(self, nfa: Nfa, starts, ends: dict[int, int], searching=False, backward=False):
        jumps, moves = {}, {}
        for a, b in nfa.jumps:
            jumps.setdefault(b if backward else a, []).append(a if backward else b)
        for a, chars, b in nfa.moves:
            moves.setdefault(b if backward else a, []).append((chars, a if backward else b))
        # Bytes that no move tells apart share a column while the table is built.
        kinds: dict[tuple, int] = {}
        sets = sorted({chars for _, chars, _ in nfa.moves}, key=sorted)
        column = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)])
        sample = [int(np.argmax(column == k)) for k in range(len(kinds))]

        def closed(states):
            found, todo = set(states), list(states)
            while todo:
                for b in jumps.get(todo.pop(), ()):
                    if b not in found:
                        found.add(b)
                        todo.append(b)
            return frozenset(s for s in found if s in moves or s in ends)

        begin = closed(starts)
        numbers, order, rows = {begin: 0}, [begin], []
        for states in order:
            row = []
            for byte in sample:
                to = {b for s in states for chars, b in moves.get(s, ()) if byte in chars}
                target = closed(to | set(starts) if searching else to)
                if target not in numbers:
                    numbers[target] = len(order)
                    order.append(target)
                row.append(numbers[target])
            rows.append(row)
        rows = np.array(rows)
        accepts = [tuple(sorted({ends[s] for s in states if s in ends})) for states in order]

        # Blocks of states with the same rules, split until all moves of a block agree.
        labels = {a: k for k, a in enumerate(dict.fromkeys(accepts))}
        block = np.array([labels[a] for a in accepts])
        while True:
            _, finer = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)
            finer = finer.reshape(-1)
            if finer.max() == block.max():
                break
            block = finer
        chosen = np.array([int(np.argmax(block == k)) for k in range(block.max() + 1)])
        self.start = int(block[0])
        self.columns = column
        self.table = block[rows[chosen]].astype(np.int32)
        self.accepts = [accepts[k] for k in chosen]

    def linked(self) -> list:
        """The table as linked rows: ``row[byte]`` is the next row, ``row[256]`` its rules."""
        rows = [[] for _ in self.accepts]
        columns = self.columns.tolist()
        for row, targets, rules in zip(rows, self.table.tolist(), self.accepts):
            to = [rows[t] for t in targets]
            row.extend([to[c] for c in columns])
            row.append(rules)
        return rows[self.start]


def longest(row: list, data, at: int, stop: int, step: int) -> int:
    """The farthest place between ``at`` and ``stop`` where the automaton accepts; -1 for none.

    ``row`` is the linked start of an automaton that begins at ``at``; with ``step`` -1 it
    reads the bytes before ``at`` backwards.
    """
    best, place = -1, at
    while place != stop:
        row = row[data[place if step > 0 else place - 1]]
        place += step
        if row[256]:
            best = place
        elif all(r is row for r in row[:256]):
            break
    return best


class Scanner:
    """All rules in one pass; per rule leftmost, longest, not overlapping.

    The searching automaton tells where a match of a rule can end first; the rule read backward
    from there gives its leftmost start, the rule read forward its last end. Rules must not let
    a match begin inside another of the same rule before that one can end, which holds for
    rules that start with a fixed word and for runs of one class.
    """

    def __init__(self, patterns: list[str]):
        nfa = Nfa()
        ends = [nfa.add(p) for p in patterns]
        self.search = Dfa(nfa, [a for a, _ in ends], {b: k for k, (_, b) in enumerate(ends)}, searching=True)
        self.forward = [Dfa(nfa, [a], {b: 0}) for a, b in ends]
        self.backward = [Dfa(nfa, [b], {a: 0}, backward=True) for a, b in ends]
        self.patterns = tuple(patterns)

    def linked(self) -> tuple:
        """Linked rows of all automata, made once per process."""
        if self.patterns not in LINKED:
            LINKED[self.patterns] = (
                self.search.linked(),
                [d.linked() for d in self.forward],
                [d.linked() for d in self.backward],
            )
        return LINKED[self.patterns]

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        row, forward, backward = self.linked()
        busy, found = [0] * len(forward), []
        for place, byte in enumerate(data):
            row = row[byte]
            if row[256]:
                for rule in row[256]:
                    if place >= busy[rule]:
                        start = longest(backward[rule], data, place + 1, busy[rule], -1)
                        if start >= 0:
                            end = longest(forward[rule], data, start, len(data), 1)
                            busy[rule] = end
                            found.append((rule, start, end))
        return found
