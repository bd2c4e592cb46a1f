"""Cheapest edits of a conversation's roles, by tables over blocks of rows.

A conversation is read as a string of row symbols, and the wanted role initials are those of `(s?(ua)+)?`. Four states are
enough: nothing yet, after s, after u, after a. Before each row stands a vector of four costs, the cheapest edits so far that
end in each state, taken less its least entry. Entries of FAR and more are cut to FAR: from any state, insertions (10 at
most) and one deletion instead of a kept s (2) do all that another state can, so a state that is 13 behind is on no
cheapest path, nor on one as cheap. That leaves a few dozen vectors, and a table gives, for each vector and each block of
four symbols, the vector behind the block and what the least entry grew by. A string is then read a block at a time. For
the edits, blocks are opened again from the last to the first, to mark the states on cheapest paths, and the ASCII-least
letters among marked states are taken from the first row on.

What a piece of a string does can be told without knowing what stands before it (reach, shape), so a long string can be
cut into pieces that different tasks read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BLOCK = 4
FAR = 13
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Symbols: 2 * kind + (1 if truncated) for the kinds s, u, a and other; a row to delete; nothing, which fills up a block.
KINDS = "sua"
OTHER, GONE, NOTHING = 3, 8, 9
SYMBOLS = 10
NONE, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTED = (NONE, AFTER_A)
START = 0
Edit = tuple[str, int, int]


def symbol(role: str, truncated: bool) -> int:
    at = KINDS.find(role[:1]) if role else -1
    return 2 * (at if at >= 0 else OTHER) + truncated


def turned(state: int) -> int:
    """The state behind a user or assistant row, whichever is the only one that may follow here."""
    return AFTER_A if state == AFTER_U else AFTER_U


def edits(state: int, one: int) -> list[Edit]:
    """Edits of a row in a state, ASCII order: letter, state behind it, cost."""
    if one == NOTHING:
        return [("", state, 0)]
    found = [("D", state, DELETE)]
    if one == GONE:
        return found
    kind, extra = one // 2, TRUNCATED * (one % 2)
    if (kind == 0 and state == NONE) or (kind in (1, 2) and turned(state) == kind + 1):
        found.append(("K", kind + 1, extra))
    return [*found, ("R", turned(state), REROLE + extra)]


def _inserted(costs: list[int]) -> list[int]:
    for _ in range(2):
        for state in range(4):
            costs[turned(state)] = min(costs[turned(state)], costs[state] + INSERT)
    return costs


def _after(costs: tuple[int, ...], one: int) -> tuple[tuple[int, ...], int]:
    """The normalised vector behind a symbol and what was taken off."""
    behind = [4 * FAR] * 4
    for state, cost in enumerate(costs):
        for _, to, price in edits(state, one):
            behind[to] = min(behind[to], cost + price)
    behind = _inserted(behind)
    least = min(behind)
    return tuple(min(cost - least, FAR) for cost in behind), least


class Tables:
    """All vectors that occur, the first being that of an empty string, and the tables over symbols and blocks."""

    def __init__(self) -> None:
        self.vectors = [tuple(_inserted([0, FAR, FAR, FAR]))]
        known, after, grown = {self.vectors[0]: 0}, [], []
        for vector in self.vectors:  # grows while it is read
            steps = [_after(vector, one) for one in range(SYMBOLS)]
            for found, _ in steps:
                if found not in known:
                    known[found] = len(self.vectors)
                    self.vectors.append(found)
            after.append([known[found] for found, _ in steps])
            grown.append([least for _, least in steps])
        one, more = np.array(after), np.array(grown)
        self.after, self.grown = after, grown
        while one.shape[1] < SYMBOLS**BLOCK:
            more = (more[:, :, None] + more[one]).reshape(len(one), -1)
            one = one[one].reshape(len(one), -1)
        self.block_after, self.block_grown = one.astype(np.uint8), more.astype(np.uint8)
        self.block_after_rows, self.block_grown_rows = ([bytes(row) for row in table] for table in (self.block_after, self.block_grown))


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def _blocks(symbols: bytes) -> list[int]:
    filled = symbols + bytes([NOTHING]) * (-len(symbols) % BLOCK)
    return (np.frombuffer(filled, np.uint8).reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()


def reach(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For every vector before a piece: the vector behind it, and the growth of the least cost."""
    table = tables()
    at, cost = np.arange(len(table.vectors)), np.zeros(len(table.vectors), np.int64)
    for block in _blocks(symbols):
        cost += table.block_grown[at, block]
        at = table.block_after[at, block].astype(np.int64)
    return at, cost


def _closed(vector: int, mask: int) -> int:
    """Marked states of a place and those from which insertions lead there at the cheapest."""
    costs = tables().vectors[vector]
    for _ in range(2):
        for state in range(4):
            to = turned(state)
            if mask >> to & 1 and costs[state] < FAR and costs[state] + INSERT == costs[to]:
                mask |= 1 << state
    return mask


@lru_cache(maxsize=None)
def accepted(vector: int) -> tuple[int, int]:
    """At the end of a string: the marked states and the cost above the least entry."""
    costs = tables().vectors[vector]
    best = min(costs[state] for state in ACCEPTED)
    return _closed(vector, sum(1 << state for state in ACCEPTED if costs[state] == best)), best


@lru_cache(maxsize=None)
def _tight(vector: int, one: int) -> tuple[tuple[Edit, ...], ...]:
    """Per state the edits of a symbol that reach the next vector's cost."""
    table = tables()
    costs, behind, grown = table.vectors[vector], table.vectors[table.after[vector][one]], table.grown[vector][one]
    return tuple(
        tuple(edit for edit in edits(state, one) if cost < FAR and cost + edit[2] == behind[edit[1]] + grown) for state, cost in enumerate(costs)
    )


@lru_cache(maxsize=None)
def _marked_before(vector: int, one: int, mask: int) -> int:
    found = sum(1 << state for state, steps in enumerate(_tight(vector, one)) if any(mask >> to & 1 for _, to, _ in steps))
    return _closed(vector, found)


@lru_cache(maxsize=None)
def _step(vector: int, one: int, before: int, after: int, state: int) -> tuple[str, int]:
    """ASCII-least letters from a marked state up to and with the edit of a symbol, and the state behind it."""
    costs, letters = tables().vectors[vector], ""
    while True:
        onward = [(letter, to) for letter, to, _ in _tight(vector, one)[state] if after >> to & 1]
        if onward and onward[0][0] in ("D", ""):
            return letters + onward[0][0], onward[0][1]
        to = turned(state)
        if before >> to & 1 and costs[state] + INSERT == costs[to]:
            letters, state = letters + "I", to
        else:
            return letters + onward[0][0], onward[0][1]


@lru_cache(maxsize=None)
def _finish(vector: int, state: int) -> str:
    """Insertions behind the last row."""
    costs, letters = tables().vectors[vector], ""
    while state not in ACCEPTED or costs[state] != accepted(vector)[1]:
        letters, state = letters + "I", turned(state)
    return letters


class Path:
    """The vectors before each symbol of a piece, read from a vector on: block by block, then opened from the last."""

    def __init__(self, symbols: bytes, vector: int = START):
        table, self.symbols, bounds, self.cost = tables(), symbols, [vector], 0
        for block in _blocks(symbols):
            self.cost += table.block_grown_rows[vector][block]
            vector = table.block_after_rows[vector][block]
            bounds.append(vector)
        self.bounds, self.end = bounds, vector

    def _opened(self, block: int) -> list[int]:
        found, after = [self.bounds[block]], tables().after
        for one in self.symbols[BLOCK * block : BLOCK * block + BLOCK - 1]:
            found.append(after[found[-1]][one])
        return found

    def marks(self, mask: int) -> tuple[bytearray, bytearray]:
        """Vectors before each symbol, and the marked states before each symbol and at the end."""
        size = len(self.symbols)
        vectors, masks = bytearray(size), bytearray(size + 1)
        masks[size] = mask
        for block in range((size - 1) // BLOCK, -1, -1):
            opened = self._opened(block)
            for inside in range(min(BLOCK, size - BLOCK * block) - 1, -1, -1):
                at = BLOCK * block + inside
                vectors[at] = opened[inside]
                masks[at] = mask = _marked_before(opened[inside], self.symbols[at], mask)
        return vectors, masks

    def letters(self, mask: int, state: int = NONE, last: bool = True) -> tuple[list[str], int]:
        """Per symbol the inserted rows before it and its own edit; behind the last symbol of a string also its
        insertions, as one more entry. And the state at the end of the piece."""
        vectors, masks = self.marks(mask)
        found = []
        for at, one in enumerate(self.symbols):
            text, state = _step(vectors[at], one, masks[at], masks[at + 1], state)
            found.append(text)
        return [*found, _finish(self.end, state)] if last else found, state


def shape(path: Path, masks: list[int]) -> dict[int, tuple[int, list[int]]]:
    """For each set of states marked behind a piece: those marked before it, and for each such state the one behind the
    piece that the letters lead to (NONE for the others)."""
    out = {}
    for mask in masks:
        before = path.marks(mask)[1][0]
        out[mask] = before, [path.letters(mask, state, last=False)[1] if before >> state & 1 else NONE for state in range(4)]
    return out


def solve(symbols: bytes) -> tuple[int, list[str]]:
    """Cost and letters of a whole string."""
    path = Path(symbols)
    mask, more = accepted(path.end)
    return path.cost + more, path.letters(mask)[0]
