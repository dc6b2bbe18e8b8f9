"""Small regular expressions to minimal deterministic automata over bytes.

Syntax: literals, ``\\`` escapes and ``\\xHH``, ``[...]`` with ranges and ``^``,
``( )``, ``(?i: )`` for ASCII letters in either case, ``|``, ``* + ?`` and
``{m}``, ``{m,}``, ``{m,n}``. Several expressions compile to one automaton whose
states tell which of them end there.
"""

from __future__ import annotations

import numpy as np

#: A byte that UTF-8 never holds: sends every automaton back to its start.
RESET = 0xFF


class _Parser:
    """Recursive descent to trees: ('set', bytes), ('cat', [..]), ('alt', [..]), ('rep', x, m, n)."""

    def __init__(self, text: str):
        self.s, self.i, self.fold = text, 0, False

    def parse(self):
        tree = self.alt()
        if self.i != len(self.s):
            raise ValueError(f"unexpected {self.s[self.i]!r} at {self.i} in {self.s!r}")
        return tree

    def more(self) -> bool:
        return self.i < len(self.s)

    def alt(self):
        parts = [self.cat()]
        while self.more() and self.s[self.i] == "|":
            self.i += 1
            parts.append(self.cat())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def cat(self):
        parts = []
        while self.more() and self.s[self.i] not in "|)":
            parts.append(self.repeat())
        return ("cat", parts)

    def repeat(self):
        x = self.atom()
        while self.more() and self.s[self.i] in "*+?{":
            c = self.s[self.i]
            self.i += 1
            if c == "{":
                end = self.s.index("}", self.i)
                lo, comma, hi = self.s[self.i:end].partition(",")
                self.i = end + 1
                x = ("rep", x, int(lo), (int(hi) if hi else None) if comma else int(lo))
            else:
                x = ("rep", x, *{"*": (0, None), "+": (1, None), "?": (0, 1)}[c])
        return x

    def char(self) -> int:
        c = self.s[self.i]
        self.i += 1
        if c == "\\":
            c = self.s[self.i]
            self.i += 1
            if c == "x":
                self.i += 2
                return int(self.s[self.i - 2:self.i], 16)
            if c.isalnum():
                raise ValueError(f"escape \\{c} is not supported")
        return ord(c)

    def folded(self, chars: set[int]) -> tuple:
        if self.fold:
            chars = {b for c in chars for b in (ord(chr(c).lower()), ord(chr(c).upper()))} if all(c < 128 for c in chars) else chars
        return ("set", frozenset(chars))

    def atom(self):
        c = self.s[self.i]
        if c == "(":
            self.i += 1
            was = self.fold
            if self.s.startswith("?i:", self.i):
                self.i, self.fold = self.i + 3, True
            elif self.s.startswith("?:", self.i):
                self.i += 2
            x = self.alt()
            if not self.more():
                raise ValueError("missing )")
            self.i += 1
            self.fold = was
            return x
        if c == "[":
            self.i += 1
            negate = self.s[self.i] == "^"
            self.i += negate
            chars: set[int] = set()
            while self.s[self.i] != "]":
                lo = hi = self.char()
                if self.s[self.i] == "-" and self.s[self.i + 1] != "]":
                    self.i += 1
                    hi = self.char()
                chars.update(range(lo, hi + 1))
            self.i += 1
            return self.folded(set(range(RESET)) - chars if negate else chars)
        if c == ".":
            self.i += 1
            return ("set", frozenset(set(range(RESET)) - {10}))
        return self.folded({self.char()})


def reverse(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [reverse(x) for x in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [reverse(x) for x in tree[1]])
    return ("rep", reverse(tree[1]), *tree[2:]) if kind == "rep" else tree


def parse(text: str):
    return _Parser(text).parse()


def shortest(tree):
    """Without the open end: matches somewhere in a text exactly when ``tree``
    does, but leaves no states behind for the rest of a long match."""
    kind = tree[0]
    if kind == "cat" and tree[1]:
        return ("cat", [*tree[1][:-1], shortest(tree[1][-1])])
    if kind == "alt":
        return ("alt", [shortest(x) for x in tree[1]])
    return ("rep", tree[1], tree[2], tree[2]) if kind == "rep" and tree[2] else tree


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, tree, start: int) -> int:
        """Add the tree's states behind ``start``; the state where it ends."""
        kind = tree[0]
        if kind == "set":
            a, b = self.state(), self.state()
            self.empty[start].append(a)
            self.step[a] = (tree[1], b)
            return b
        if kind == "cat":
            for x in tree[1]:
                start = self.add(x, start)
            return start
        if kind == "alt":
            end = self.state()
            for x in tree[1]:
                self.empty[self.add(x, start)].append(end)
            return end
        _, x, lo, hi = tree
        for _ in range(lo):
            start = self.add(x, start)
        if hi is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(x, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(hi - lo):
            start = self.add(x, start)
            self.empty[start].append(end)
        return end


class Automaton:
    """Minimal automaton of several trees.

    ``next[state * 256 + byte]``, ``ends[state]`` (bit r: tree r ends here).
    State 0 starts. Unanchored: a match may begin at every byte. Anchored: state
    ``dead`` can never end again.
    """

    def __init__(self, trees: list, anchored: bool):
        nfa, first = _Nfa(), []
        final: dict[int, int] = {}
        for r, tree in enumerate(trees):
            s = nfa.state()
            first.append(s)
            e = nfa.add(tree, s)
            final[e] = final.get(e, 0) | 1 << r

        def close(states) -> frozenset:
            seen, todo = set(states), list(states)
            while todo:
                for x in nfa.empty[todo.pop()]:
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            return frozenset(x for x in seen if nfa.step[x] is not None or x in final)

        groups: dict[tuple, list[int]] = {}
        sets = [x for x in dict.fromkeys(s[0] for s in nfa.step if s)]
        for b in range(256):
            groups.setdefault(tuple(b in s for s in sets), []).append(b)
        letters = list(groups.values())
        start = close(first)
        index, table, todo = {start: 0}, [], [start]
        for states in todo:                                  # subset construction
            row = []
            for bs in letters:
                reach = {nfa.step[x][1] for x in states if nfa.step[x] and bs[0] in nfa.step[x][0]} if bs[0] != RESET or len(bs) > 1 else set()
                to = close(reach if anchored else reach | set(first))
                if to not in index:
                    index[to] = len(index)
                    todo.append(to)
                row.append(index[to])
            table.append(row)
        ends = np.array([sum({final[x] for x in s if x in final}) for s in todo], np.int64)
        table = np.array(table, np.int64)
        block = np.unique(ends, return_inverse=True)[1]
        while True:                                          # minimisation by refinement
            _, new = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
            if new.max() == block.max():
                break
            block = new
        relabel = np.full(block.max() + 1, -1)
        order = []
        for s, b in enumerate(block.tolist()):               # state 0 stays 0
            if relabel[b] < 0:
                relabel[b] = len(order)
                order.append(s)
        small = relabel[block[table[order]]]
        wide = np.empty((len(order), 256), np.int32)
        for k, bs in enumerate(letters):
            wide[:, bs] = small[:, [k]]
        if not anchored:
            wide[:, RESET] = 0
        self.size, self.next, self.ends = len(order), wide.reshape(-1), ends[order]
        same = (wide == np.arange(len(order))[:, None]).all(1) & (self.ends == 0)
        self.dead = int(np.flatnonzero(same)[0]) if anchored and same.any() else -1
        self.rows = wide.tolist()

    def scan(self, data: np.ndarray, width: int = 0) -> np.ndarray:
        """State after each byte. All pieces of ``width`` bytes advance together
        from the start state; then each piece whose true first state differs is
        walked until it meets what was recorded."""
        n = len(data)
        if not n:
            return np.empty(0, np.int32)
        width = width or min(512, max(16, int(n ** 0.5)))
        lanes = -(-n // width)
        block = np.full(lanes * width, RESET, np.uint8)
        block[:n] = data
        steps = np.ascontiguousarray(block.reshape(lanes, width).T)
        out = np.empty((width, lanes), np.int32)
        state = np.zeros(lanes, np.int32)
        for k in range(width):
            state = self.next[(state << 8) + steps[k]]
            out[k] = state
        states = np.ascontiguousarray(out.T).reshape(-1)
        rows, stop = self.rows, 0
        for lane in np.flatnonzero(states[width - 1:-1:width]).tolist():
            i = (lane + 1) * width
            if i < stop:
                continue
            s = int(states[i - 1])
            while i < n and (s := rows[s][block[i]]) != states[i]:
                states[i] = s
                i += 1
            stop = i
        return states[:n]

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at ``start``, or -1 (anchored)."""
        s, best = 0, 0 if self.ends[0] else -1
        end = start if best == 0 else -1
        rows, ends, dead = self.rows, self.ends, self.dead
        for i in range(start, len(data)):
            s = rows[s][data[i]]
            if s == dead:
                break
            if ends[s]:
                end = i + 1
        return end
