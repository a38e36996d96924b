"""Which lengths fill a sequence together: a cutting-stock problem solved by column generation.

A column is a pattern (how many pieces of each length class share a sequence) or one piece of a class sent
to the stream, where pieces are cut wherever a sequence ends. The linear program finds how often each is
used so that every piece is taken once and the cost is least; a knapsack program over the dual prices
finds the patterns worth adding. The size of both depends on the length classes, not on the number of pieces.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

CLASSES = 640
CUT_COST = 0.01  # a streamed sequence costs this much more than a full one, so fuller patterns are preferred
GAP = 0.0002
PRICINGS = 60  # of the knapsack; what is found by then is used
_AT_ONCE = 32  # patterns entered before rounding errors are looked at


class Pattern(NamedTuple):
    pieces: dict[int, int]  # class -> pieces of it in a sequence
    copies: int


def length_classes(lengths: np.ndarray, most: int = CLASSES) -> np.ndarray:
    """The longest length of each class, ascending. With at most `most` lengths each is its own class; else
    short lengths still are and longer ones share classes of equal relative width."""
    lengths = np.unique(lengths)
    if len(lengths) <= most:
        return lengths

    def tops(ratio: float) -> np.ndarray:
        out, at = [], len(lengths) - 1
        while at >= 0:  # from the longest down, so that a class is as long as its longest piece
            out.append(lengths[at])
            at = int(np.searchsorted(lengths, lengths[at] * (1 - ratio), "right")) - 1 if ratio else at - 1
            at = min(at, int(np.searchsorted(lengths, out[-1], "left")) - 1)
        return np.array(out[::-1])

    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (low, middle) if len(tops(middle)) <= most else (middle, high)
    return tops(high)


def knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every capacity the best total price of pieces that fit, and the class taken last (-1: none)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    worth = np.flatnonzero(prices > 0)
    lengths_, prices_ = lengths[worth], prices[worth]
    for room in range(1, capacity + 1):
        best[room], last[room] = best[room - 1], -2  # -2: the same as with one place less
        fits = int(np.searchsorted(lengths_, room, "right"))
        if fits:
            totals = best[room - lengths_[:fits]] + prices_[:fits]
            k = int(totals.argmax())
            if totals[k] > best[room]:
                best[room], last[room] = totals[k], worth[k]
    return best, last


def _pattern(last: np.ndarray, lengths: np.ndarray, room: int, first: int) -> np.ndarray:
    """The best pattern that holds a piece of class `first`."""
    column = np.zeros(len(lengths))
    column[first] += 1
    room -= lengths[first]
    while room > 0:
        k = last[room]
        if k == -2 or k == -1:
            room -= 1
            continue
        column[k] += 1
        room -= lengths[k]
    return column


def filled(lengths: np.ndarray, demand: np.ndarray, capacity: int, cut_cost: float = CUT_COST) -> tuple[list[tuple[np.ndarray, int]], np.ndarray]:
    """Patterns in whole copies made by hand, and the pieces left over.

    The longest piece left takes the longest that still fit beside it, and the pattern is repeated while its
    pieces last. Where it is not full enough its longest class is left over.
    """
    left, open_ = demand.astype(np.int64), demand > 0
    out = []
    while open_.any():
        column, room = np.zeros(len(lengths), np.int64), capacity
        for k in np.flatnonzero(open_)[::-1]:
            column[k] = min(room // lengths[k], left[k])
            room -= column[k] * lengths[k]
        used = np.flatnonzero(column)
        if (lengths @ column) * (1 + cut_cost) >= capacity:
            copies = int((left[used] // column[used]).min())
            left[used] -= copies * column[used]
            out.append((column, copies))
            open_ &= left > 0
        else:
            open_[used[-1]] = False
    return out, left


class _Basis:
    """Columns in use (None: the stream's), their costs and amounts, and the inverse of their matrix.

    Products are written as sums over the few entries of a column, or with einsum: neither needs the threads of a
    linear algebra library, which may not survive the start of a Spark session in the same process.
    """

    def __init__(self, demand: np.ndarray, stream: np.ndarray):
        self.demand, self.stream = demand.astype(float), stream
        self.columns: list[np.ndarray | None] = [None] * len(demand)
        self.costs, self.amounts, self.inverse = stream.copy(), self.demand.copy(), np.eye(len(demand))

    @property
    def total(self) -> float:
        return float((self.costs * self.amounts).sum())

    def prices(self) -> np.ndarray:
        return np.einsum("i,ij->j", self.costs, self.inverse)

    def enter(self, column: np.ndarray) -> bool:
        """Take a pattern in, if it is worth more than its cost, and the column out that it replaces first."""
        some = np.flatnonzero(column)
        direction = (self.inverse[:, some] * column[some]).sum(1)
        if (self.costs * direction).sum() <= 1 + 1e-9:
            return False
        rows = np.flatnonzero(direction > 1e-6)
        if not len(rows):
            return False
        ratios = self.amounts[rows] / direction[rows]
        rows = rows[ratios <= ratios.min() * (1 + 1e-9) + 1e-9]
        out = rows[direction[rows].argmax()]
        step = self.amounts[out] / direction[out]
        self.amounts -= step * direction
        self.amounts[out] = step
        self.inverse[out] /= direction[out]
        direction[out] = 0.0
        changed = np.flatnonzero(direction)
        self.inverse[changed] -= direction[changed, None] * self.inverse[out]
        self.columns[out], self.costs[out] = column, 1.0
        return True

    def _applied(self, amounts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(amounts))
        for i, column in enumerate(self.columns):
            if column is None:
                out[i] += amounts[i]
            else:
                out += amounts[i] * column
        return out

    def sound(self) -> bool:
        """Whether rounding errors are still small: the amounts meet the demand, and the inverse undoes the columns."""
        most = self.demand.max()
        probe = np.cos(np.arange(len(self.demand)))
        back = np.einsum("ij,j->i", self.inverse, self._applied(probe))
        return bool(
            self.amounts.min() >= -1e-6 * most and np.abs(self._applied(self.amounts) - self.demand).max() <= 1e-6 * most
            and np.abs(back - probe).max() <= 1e-5
        )

    def take(self, columns: list[np.ndarray]) -> bool:
        """Enter several patterns; all are given up again if the numbers do not stay sound."""
        before = self.columns.copy(), self.costs.copy(), self.amounts.copy(), self.inverse.copy()
        total = self.total
        entered = sum(self.enter(c) for c in columns)
        if entered and (not self.sound() or self.total > total * (1 + 1e-9)):
            self.columns, self.costs, self.amounts, self.inverse = before
            return False
        np.maximum(self.amounts, 0.0, out=self.amounts)
        return entered > 0


def relaxed(lengths: np.ndarray, demand: np.ndarray, capacity: int, cut_cost: float = CUT_COST, gap: float = GAP) -> tuple[np.ndarray, np.ndarray, float, float]:
    """The patterns in use as columns, how often each is used, the cost, and a lower bound of any cost.

    Revised simplex with a dense inverse. It starts with everything in the stream and is offered the patterns of
    `filled`; then the knapsack prices new ones until none is worth more than its cost or the gap is small. The bound takes the dual
    prices, cut to the stream's and divided by the best pattern's price: at these no column is worth more than it costs.
    """
    stream = lengths / capacity * (1 + cut_cost)
    basis = _Basis(demand, stream)
    start = [c for c, _ in filled(lengths, demand, capacity, cut_cost)[0]]
    for at in range(0, len(start), _AT_ONCE):
        basis.take(start[at : at + _AT_ONCE])
    bound = float(lengths @ demand) / capacity
    for _ in range(PRICINGS):
        prices = basis.prices()
        best, last = knapsack(prices, lengths, capacity)
        bound = max(bound, float((np.minimum(prices, stream) * demand).sum()) / max(best[capacity], 1.0))
        if best[capacity] <= 1 + 1e-9 or basis.total - bound <= gap * basis.total:
            break
        with_first = prices + best[capacity - lengths]
        worth = [k for k in np.argsort(-with_first, kind="stable")[:_AT_ONCE] if with_first[k] > 1 + 1e-9]
        if not basis.take([_pattern(last, lengths, capacity, k) for k in worth]):
            break
    used = [i for i, c in enumerate(basis.columns) if c is not None]
    columns = np.array([basis.columns[i] for i in used]).reshape(len(used), len(lengths))
    return columns, basis.amounts[used], basis.total, bound


def patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, cut_cost: float = CUT_COST) -> list[Pattern]:
    """Whole numbers of patterns that ask for no more pieces of a class than there are.

    The relaxed amounts are rounded down; then the patterns with the largest parts cut off get one
    more while the pieces last, and `filled` makes patterns of what is left. The rest goes to the stream.
    """
    if not len(lengths):
        return []
    columns, amounts, _, _ = relaxed(lengths, demand, capacity, cut_cost)
    columns = columns.astype(np.int64)
    copies = np.floor(amounts + 1e-6).astype(np.int64)
    left = demand - copies @ columns
    for i in np.flatnonzero(copies > 0):  # an amount a little above what rounding errors allow
        while copies[i] and (left[columns[i] > 0] < 0).any():
            copies[i] -= 1
            left = left + columns[i]
    for i in np.argsort(-(amounts - copies), kind="stable"):
        if amounts[i] > copies[i] and (columns[i] <= left).all():
            copies[i] += 1
            left = left - columns[i]
    rest, _ = filled(lengths, left, capacity, cut_cost)
    both = [*zip(columns, copies), *rest]
    return [Pattern({int(k): int(c[k]) for k in np.flatnonzero(c)}, int(n)) for c, n in both if n]
