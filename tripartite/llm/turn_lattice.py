"""Cheapest edits of a conversation by the auction algorithm for shortest paths.

The lattice has a layer for each row and one for the end, and in each layer a node for each
state of the repaired roles so far: none, system, user, assistant. Arcs are edits: keep,
re-role and delete go to the next layer, an insertion stays in its own.

A node has a price, never more than the length of an arc from it plus the price behind the
arc. A path is extended from an origin along the arc that meets its node's price, or
contracted after the price has been raised to the best arc where none does; it is done when
it comes to a node whose price is known to be the distance to the end, and then all prices
on it are distances too. Origins are taken from the last layer to the first, so that a path
rarely leaves its layer. Costs are whole numbers, so prices are exact, and every arc that
meets its node's price lies on a cheapest path: the least of their letters in ASCII order
leads along the least audit.

What a layer does depends on its row's kind and on the differences of the prices behind it,
of which there are few, so each combination is solved once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5  # for a truncated row that stays

# States by the role that came last, and where each role may follow.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NONE, SYSTEM, USER, ASSISTANT)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FOLLOWS = {NONE: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
WRITTEN = {USER: "user", ASSISTANT: "assistant"}  # roles that edits can write
MAY_END = (NONE, ASSISTANT)

# Kinds of rows: one that has to go; else its role's initial, and whether it is truncated.
GONE, END = 0, -1
OTHER = 4
KINDS = range(9)


def kind_of(initial: str, gone: bool, truncated: bool) -> int:
    return GONE if gone else 2 * INITIALS.get(initial, OTHER) - 1 + truncated


Node = tuple[int, int]  # layer (0 here, 1 behind), state
Arc = tuple[str, int, Node]


def _arcs(kind: int, state: int) -> list[Arc]:
    """Edits from a state of a row's layer, in the order of their letters."""
    wanted = [to for to in FOLLOWS[state] if to in WRITTEN]
    inserted = [(INSERT, COST[INSERT], (0, to)) for to in wanted]
    if kind == END:
        return [*inserted, *([("", 0, (1, state))] if state in MAY_END else [])]
    arcs = [(DELETE, COST[DELETE], (1, state)), *inserted]
    if kind != GONE:
        role, extra = (kind + 1) // 2, TRUNCATED * ((kind + 1) % 2)
        arcs += [(KEEP, COST[KEEP] + extra, (1, to)) for to in FOLLOWS[state] if to == role]
        arcs += [(REROLE, COST[REROLE] + extra, (1, to)) for to in wanted]
    return arcs


def auction(arcs: dict[Node, list[Arc]], prices: dict[Node, int], settled: set[Node], origin: Node) -> None:
    """Settle ``origin`` and the nodes on its shortest path to a settled node."""
    path = [origin]
    while path[-1] not in settled:
        node = path[-1]
        best, ahead = min((cost + prices[to], to) for _, cost, to in arcs[node])
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(ahead)
    settled.update(path)


@dataclass(frozen=True)
class Layer:
    """A row's layer with given prices behind it: ``base`` and ``prices`` add up to its own
    prices, and from each state go ``inserts``, then ``letter`` to the state ``to`` behind."""

    base: int
    prices: tuple[int, ...]
    inserts: tuple[tuple[int, ...], ...]
    letter: tuple[str, ...]
    to: tuple[int, ...]


@cache
def layer(kind: int, behind: tuple[int, ...]) -> Layer:
    arcs = {(0, state): _arcs(kind, state) for state in STATES}
    prices: dict[Node, int] = {(1, state): price for state, price in zip(STATES, behind, strict=True)}
    settled = set(prices)
    # No arc is shorter than nothing, so the least price behind is a lawful start.
    prices |= dict.fromkeys(arcs, min(behind))
    for origin in arcs:
        auction(arcs, prices, settled, origin)
    inserts, letters, ends = [], [], []
    for state in STATES:
        node, put = (0, state), []
        while True:
            letter, _, ahead = min(a for a in arcs[node] if prices[node] == a[1] + prices[a[2]])
            if ahead[0] == 1:
                break
            put.append(ahead[1])
            node = ahead
        inserts.append(tuple(put))
        letters.append(letter)
        ends.append(ahead[1])
    own = [prices[0, state] for state in STATES]
    base = min(own)
    return Layer(base, tuple(p - base for p in own), tuple(inserts), tuple(letters), tuple(ends))


AFTER_END = (0, 0, 0, 0)


def solve(kinds: list[int], behind: tuple[int, ...] | None = None) -> tuple[int, tuple[int, ...], list[Layer]]:
    """Layers of rows from the first to the last, and the first layer's prices as a base
    and what is above it. ``behind``: prices behind the last row; None where it is the end,
    which then is a layer of its own."""
    found, total = [], 0
    if behind is None:
        kinds, behind = [*kinds, END], AFTER_END
    for kind in reversed(kinds):
        made = layer(kind, behind)
        found.append(made)
        total += made.base
        behind = made.prices
    return total, behind, found[::-1]


# ---- pieces of long conversations --------------------------------------------------------


@dataclass(frozen=True)
class Tables:
    """All layers that can occur: price vectors from ``vectors`` in, and by kind and vector
    the vector that comes out, the base, and the state behind for each state."""

    vectors: list[tuple[int, ...]]
    out: np.ndarray
    base: np.ndarray
    to: np.ndarray


@cache
def tables() -> Tables:
    known = [layer(END, AFTER_END).prices]
    places = {known[0]: 0}
    for vector in known:  # grows while it is read
        for kind in KINDS:
            prices = layer(kind, vector).prices
            if prices not in places:
                places[prices] = len(known)
                known.append(prices)
    layers = [[layer(kind, vector) for vector in known] for kind in KINDS]
    return Tables(
        known,
        np.array([[places[x.prices] for x in row] for row in layers]),
        np.array([[x.base for x in row] for row in layers]),
        np.array([[x.to for x in row] for row in layers]),
    )


def piece(kinds: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a run of rows does for each price vector behind it: the vector before it, the
    base that it adds, and the state behind it for each state before it."""
    made = tables()
    at = np.arange(len(made.vectors))
    total = np.zeros(len(at), np.int64)
    leaves = np.tile(np.array(STATES), (len(at), 1))
    for kind in reversed(kinds):
        total += made.base[kind, at]
        leaves = np.take_along_axis(leaves, made.to[kind, at], 1)
        at = made.out[kind, at]
    return at, total, leaves
