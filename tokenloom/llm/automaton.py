"""Regular expressions compiled into one deterministic automaton over bytes.

Every rule is parsed into a nondeterministic automaton, subset construction runs all rules side
by side, and equal states are merged. A rule keeps its threads in the order in which they began
and drops the later ones as soon as an earlier one matches, so that a rule's matches are its
leftmost, longest ones and do not overlap, while matches of different rules may.

The pattern language holds what byte rules need: literals, `\\xNN`, classes with ranges, groups,
`|`, `?`, `*`, `+`, `{m}`, `{m,}` and `{m,n}`. All bytes are ASCII, so UTF-8 text is scanned as it is.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import length_hint

@dataclass(frozen=True)
class Rule:
    """`prefix` then `body`, one class repeated; a match with fewer than `least` bytes of body is consumed and dropped.

    `any_case` folds the letters of the prefix.
    """

    kind: str
    prefix: str
    body: str
    least: int
    any_case: bool = False


class _Parser:
    """Builds Thompson fragments; a node is a list of (set of bytes, target) and epsilon targets."""

    def __init__(self, nfa: Nfa, pattern: str, any_case: bool):
        self.nfa, self.pattern, self.at, self.any_case = nfa, pattern, 0, any_case

    def peek(self) -> str:
        return self.pattern[self.at] if self.at < len(self.pattern) else ""

    def take(self) -> str:
        self.at += 1
        return self.pattern[self.at - 1]

    def alternatives(self, start: int) -> int:
        end = self.nfa.node()
        while True:
            entry = self.nfa.node()
            self.nfa.empty[start].append(entry)
            self.nfa.empty[self.sequence(entry)].append(end)
            if self.peek() != "|":
                return end
            self.take()

    def sequence(self, start: int) -> int:
        while self.peek() not in ("", "|", ")"):
            begin = self.at
            self.skip_atom()
            atom = self.pattern[begin : self.at]
            least, most = self.repeats()
            for _ in range(least):
                start = self.copy(atom, start)
            if most is None:
                loop, out = self.nfa.node(), self.nfa.node()
                self.nfa.empty[start].append(loop)
                self.nfa.empty[self.copy(atom, loop)].append(loop)
                self.nfa.empty[loop].append(out)
                start = out
            elif most > least:
                out = self.nfa.node()
                for _ in range(most - least):
                    entry = self.nfa.node()
                    self.nfa.empty[start] += [entry, out]
                    start = self.copy(atom, entry)
                self.nfa.empty[start].append(out)
                start = out
        return start

    def skip_atom(self) -> None:
        first = self.take()
        if first == "\\":
            self.at += 3 if self.peek() == "x" else 1
        elif first == "[":
            while self.take() != "]":
                if self.pattern[self.at - 1] == "\\":
                    self.at += 1
        elif first == "(":
            depth = 1
            while depth:
                c = self.take()
                if c == "\\":
                    self.at += 1
                elif c == "[":
                    while self.take() != "]":
                        pass
                depth += (c == "(") - (c == ")")

    def repeats(self) -> tuple[int, int | None]:
        mark = self.peek()
        if mark and mark in "?*+":
            self.take()
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
        if mark == "{":
            end = self.pattern.index("}", self.at)
            low, comma, high = self.pattern[self.at + 1 : end].partition(",")
            self.at = end + 1
            return int(low), (int(high) if high else None) if comma else int(low)
        return 1, 1

    def copy(self, atom: str, start: int) -> int:
        if atom[0] == "(":
            return _Parser(self.nfa, atom[1:-1], self.any_case).alternatives(start)
        end = self.nfa.node()
        self.nfa.steps[start].append((byte_class(atom, self.any_case), end))
        return end


def byte_class(atom: str, any_case: bool = False) -> frozenset[int]:
    """The bytes of a literal, an escape or a class."""
    inside = atom[1:-1] if atom[0] == "[" else atom
    found, at = [], 0
    while at < len(inside):
        if inside[at] == "\\" and inside[at + 1] == "x":
            found.append(int(inside[at + 2 : at + 4], 16))
            at += 4
        elif inside[at] == "\\":
            found.append(ord(inside[at + 1]))
            at += 2
        elif atom[0] == "[" and inside[at] == "-" and found and at + 1 < len(inside):
            found += range(found[-1] + 1, ord(inside[at + 1]) + 1)
            at += 2
        else:
            found.append(ord(inside[at]))
            at += 1
    if max(found) > 127:
        raise ValueError("rules are made of ASCII bytes")
    if any_case:
        found += [ord(s) for b in found for s in (chr(b).lower(), chr(b).upper())]
    return frozenset(found)


@dataclass
class Nfa:
    steps: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)
    final: list[bool] = field(default_factory=list)

    def node(self) -> int:
        self.steps.append([])
        self.empty.append([])
        self.final.append(False)
        return len(self.steps) - 1

    def closure(self, nodes: list[int]) -> tuple[int, ...]:
        """Nodes that consume a byte or match, reached without one, in the order of their threads."""
        seen: dict[int, None] = {}
        visited: set[int] = set()
        for node in nodes:
            stack = [node]
            while stack:
                n = stack.pop()
                if n in visited:
                    continue
                visited.add(n)
                if self.steps[n] or self.final[n]:
                    seen[n] = None
                stack.extend(reversed(self.empty[n]))
        return tuple(seen)


def _compile_rule(rule: Rule) -> tuple[Nfa, int]:
    """A rule with a prefix matches from its first body byte on, and its length is checked when the match has ended.

    Without a prefix such matches would be as frequent as letters, so the least length is counted by states.
    """
    nfa = Nfa()
    start = nfa.node()
    at = _Parser(nfa, rule.prefix, rule.any_case).alternatives(start) if rule.prefix else start
    body = byte_class(rule.body)
    for _ in range(1 if rule.prefix else rule.least):
        after = nfa.node()
        nfa.steps[at].append((body, after))
        at = after
    nfa.final[at] = True
    nfa.steps[at].append((body, at))
    return nfa, start


class _RuleStates:
    """Subset construction of one rule: a state is the ordered tuple of its threads' nodes."""

    def __init__(self, rule: Rule):
        self.nfa, start = _compile_rule(rule)
        self.fresh = self.nfa.closure([start])

    def step(self, state: tuple[int, ...], byte: int) -> tuple[int, ...]:
        moved = self._moved(state, byte)
        if self.matched(state):
            # The match either goes on, or has ended and the search starts anew at this byte.
            return self._cut(moved) if self.matched(moved) else self.step((), byte)
        return self._cut(self.nfa.closure([*moved, *self._moved(self.fresh, byte)]))

    def _moved(self, state: tuple[int, ...], byte: int) -> tuple[int, ...]:
        return self.nfa.closure([to for n in state for bytes_, to in self.nfa.steps[n] if byte in bytes_])

    def _cut(self, state: tuple[int, ...]) -> tuple[int, ...]:
        """Without the threads that began after one that has matched."""
        for i, n in enumerate(state):
            if self.nfa.final[n]:
                return state[: i + 1]
        return state

    def matched(self, state: tuple[int, ...]) -> bool:
        return any(self.nfa.final[n] for n in state)


@dataclass(frozen=True)
class Automaton:
    """`moves[state][byte]` is the next state; `marks[state]` has a bit for every rule that is inside a match."""

    kinds: tuple[str, ...]
    moves: list[list[int]]
    marks: list[int]


def compile_rules(rules: list[Rule]) -> Automaton:
    """One minimal automaton for all rules."""
    parts = [_RuleStates(r) for r in rules]
    classes = _byte_classes(parts)
    start = tuple(() for _ in rules)
    numbers, queue, moves = {start: 0}, [start], []
    for state in queue:
        row = []
        for members in classes:
            to = tuple(p.step(s, members[0]) for p, s in zip(parts, state))
            if to not in numbers:
                numbers[to] = len(numbers)
                queue.append(to)
            row.append(numbers[to])
        moves.append(row)
    marks = [sum(p.matched(s) << i for i, (p, s) in enumerate(zip(parts, state))) for state in queue]
    return _minimised(tuple(r.kind for r in rules), classes, moves, marks)


def _byte_classes(parts: list[_RuleStates]) -> list[list[int]]:
    """Bytes that no rule tells apart."""
    sets = {bytes_ for p in parts for steps in p.nfa.steps for bytes_, _ in steps}
    found: dict[tuple[bool, ...], list[int]] = {}
    for byte in range(256):
        found.setdefault(tuple(byte in s for s in sets), []).append(byte)
    return list(found.values())


def _minimised(kinds: tuple[str, ...], classes: list[list[int]], moves: list[list[int]], marks: list[int]) -> Automaton:
    """Partition refinement: states are equal while their marks and their next states' groups are."""
    group = {m: i for i, m in enumerate(dict.fromkeys(marks))}
    groups = [group[m] for m in marks]
    while True:
        keys = [(groups[s], *(groups[t] for t in moves[s])) for s in range(len(moves))]
        number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        refined = [number[k] for k in keys]
        if len(number) == len(set(groups)):
            break
        groups = refined
    # The start state comes first, so its group has number 0.
    first: dict[int, int] = {}
    for s, g in enumerate(refined):
        first.setdefault(g, s)
    rows, graded = [], []
    for g in range(len(first)):
        row = [0] * 256
        for c, members in enumerate(classes):
            for byte in members:
                row[byte] = refined[moves[first[g]][c]]
        rows.append(row)
        graded.append(marks[first[g]])
    return Automaton(kinds, rows, graded)


def matches(automaton: Automaton, rules: list[Rule], data: bytes) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes of every kept match, from one pass; a found end is traced back to its start."""
    rows, found = _linked(automaton), []
    begun, ended = [0] * len(rules), [0] * len(rules)
    row, live, left = rows[0], 0, iter(data)
    for byte in left:
        row = row[byte]
        if row[256] != live:
            at = len(data) - length_hint(left) - 1
            live = _turn(rules, data, at, live, row[256], begun, ended, found)
    _turn(rules, data, len(data), live, 0, begun, ended, found)
    return sorted(found)


def _linked(automaton: Automaton) -> list[list]:
    """The transition arrays with rows in place of state numbers, and a row's marks behind its 256 bytes."""
    cached = _LINKED.get(id(automaton))
    if cached is None:
        cached = [[None] * 257 for _ in automaton.moves]
        for row, to, mark in zip(cached, automaton.moves, automaton.marks):
            row[:256] = [cached[s] for s in to]
            row[256] = mark
        _LINKED[id(automaton)] = cached
    return cached


_LINKED: dict[int, list[list]] = {}


def _turn(rules: list[Rule], data: bytes, at: int, was: int, now: int, begun: list, ended: list, found: list) -> int:
    """Notes where bodies begin and where matches end as the marks change before byte `at + 1`."""
    for i, rule in enumerate(rules):
        old, new = was >> i & 1, now >> i & 1
        if old and not new:
            if at - begun[i] >= rule.least:
                found.append((_start(rule, data, begun[i], ended[i]), i, at))
            ended[i] = at
        elif new and not old:
            begun[i] = at if rule.prefix else at - rule.least + 1
    return now


def _start(rule: Rule, data: bytes, body: int, floor: int) -> int:
    """The first byte of the match whose body starts at `body`: the reversed prefix run backwards."""
    if not rule.prefix:
        return body
    reverse, start = _reversed_prefix(rule)
    state, best, at = reverse.closure([start]), body, body
    while state and at > floor:
        at -= 1
        state = reverse.closure([to for n in state for bytes_, to in reverse.steps[n] if data[at] in bytes_])
        if any(reverse.final[n] for n in state):
            best = at
    return best


def _reversed_prefix(rule: Rule) -> tuple[Nfa, int]:
    if rule not in _REVERSED:
        forward = Nfa()
        start = forward.node()
        end = _Parser(forward, rule.prefix, rule.any_case).alternatives(start)
        back = Nfa()
        for _ in forward.steps:
            back.node()
        for n, steps in enumerate(forward.steps):
            for bytes_, to in steps:
                back.steps[to].append((bytes_, n))
            for to in forward.empty[n]:
                back.empty[to].append(n)
        back.final[start] = True
        _REVERSED[rule] = back, end
    return _REVERSED[rule]


_REVERSED: dict[Rule, tuple[Nfa, int]] = {}
