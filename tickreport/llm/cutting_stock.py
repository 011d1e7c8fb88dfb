"""Cutting stock by column generation over a length histogram.

The input is a histogram (how many items of each length 1..capacity), so the
problem's size is bounded by the capacity and not by the data.  A linear program
over packing patterns is solved by the revised simplex method; a knapsack
dynamic programme prices new patterns at the duals, many at a time, until the
program is proved to be within a gap of its lower bound.  The solution is rounded
down, and what the rounding leaves (less than one item per pattern and slot) is
cut by the same programme at the prices that make every length worth itself.
"""

from __future__ import annotations

import math

import numpy as np

Pattern = list[tuple[int, int]]  # (length, times), longest first

#: Patterns entered from one pricing at most; the next pricing goes on with the rest.
BATCH = 60
#: Share of the best known duals in the prices: pure duals jump from one pricing to the next.
SMOOTH = 0.3
#: Simplex steps after which the inverse is computed anew.
FRESH = 300
#: The least pivot of a step, and what is no more than an error of rounding.
PIVOT, TINY = 1e-6, 1e-9
#: Orders of ``cut`` (around scarce lengths, power): which one wastes least depends on the histogram.
WAYS = [(False, 1.0), (False, math.inf), (True, 2.0), (True, math.inf)]


def price(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the highest total price within every room 0..capacity,
    and the length taken there last (-1: none, the room less one is as good)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, np.int64)
    useful = prices > 1e-12
    items, worth = lengths[useful], prices[useful]
    ends = np.searchsorted(items, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if ends[c]:
            got = best[c - items[:ends[c]]] + worth[:ends[c]]
            j = got.argmax()
            if got[j] > best[c] + 1e-15:
                best[c], choice[c] = got[j], items[j]
    return best, choice


def taken(choice: np.ndarray, room: int) -> dict[int, int]:
    """The pattern behind a room's best price."""
    pattern: dict[int, int] = {}
    while room > 0:
        n = int(choice[room])
        if n < 0:
            room -= 1
        else:
            pattern[n] = pattern.get(n, 0) + 1
            room -= n
    return pattern


def knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """The pattern of the highest total price."""
    best, choice = price(prices, lengths, capacity)
    return float(best[capacity]), taken(choice, capacity)


def fullest(left: dict[int, float], first: int, others: list[int], capacity: int) -> Pattern:
    """The fullest pattern with an item of length ``first`` and no more items than
    are left: a bounded knapsack whose prices are the lengths.  Reachable sums are
    the bits of an integer; of full patterns it takes one from as few of the first
    lengths in ``others`` as reach the capacity."""
    room = capacity - first
    reach, used, within = [1], [], (1 << room + 1) - 1
    for n in others:
        sums = grown = reach[-1]
        for _ in range(min(math.ceil(left[n]) - (n == first), room // n)):
            grown = grown << n & within
            sums |= grown
        if sums != reach[-1]:
            reach.append(sums)
            used.append(n)
            if sums >> room & 1:
                break
    at = reach[-1].bit_length() - 1
    pattern = {first: 1}
    for i in range(len(used) - 1, -1, -1):
        while not reach[i] >> at & 1:
            pattern[used[i]] = pattern.get(used[i], 0) + 1
            at -= used[i]
    return sorted(pattern.items(), reverse=True)


def cut(counts: dict[int, float], capacity: int, scarce: bool, power: float,
        whole: bool = True) -> list[tuple[Pattern, float]]:
    """(pattern, times) that use up the counted items; a pattern is repeated while
    its items last.  Each pattern is the fullest around the longest length or, with
    ``scarce``, around the rarest of those over half the capacity and then of the
    others; the lengths that fill it are tried by length ** power times count left
    (infinite: by length), largest first.  With ``whole`` false the times may be
    fractions, and each pattern uses up the length that limits it."""
    left = {n: c for n, c in counts.items() if c > 0}
    out: list[tuple[Pattern, float]] = []
    while left:
        first = min(left, key=lambda n: (2 * n <= capacity, left[n], -n)) if scarce else max(left)
        others = sorted(left, key=lambda n: (n if math.isinf(power) else left[n] * n ** power, n), reverse=True)
        pattern = fullest(left, first, others, capacity)
        limit = min(pattern, key=lambda p: left[p[0]] / p[1])[0]
        times = min(left[n] // k if whole else left[n] / k for n, k in pattern)
        for n, k in pattern:
            left[n] -= k * times
            if left[n] <= 0 or not whole and n == limit:
                del left[n]
        out.append((pattern, times))
    return out


def cuts(counts: dict[int, float], capacity: int, whole: bool = True) -> list[list[tuple[Pattern, float]]]:
    """``cut`` in every one of ``WAYS``, the one of the fewest patterns first."""
    return sorted((cut(counts, capacity, scarce, power, whole) for scarce, power in WAYS),
                  key=lambda way: sum(times for _, times in way))


class Master:
    """The linear program over the patterns found so far: its basis, the inverse of
    the basis and the times of each basic pattern."""

    def __init__(self, demand: dict[int, float], capacity: int, spare: list[dict[int, int]] = ()):
        """The first basis has each length by itself; ``spare`` are columns to enter
        next.  (Greedy patterns as a first basis would have an inverse of any size.)"""
        self.lengths = np.array(sorted(demand), np.int64)
        self.at = {int(n): i for i, n in enumerate(self.lengths)}
        m = len(self.lengths)
        self.demand = np.array([demand[int(n)] for n in self.lengths])
        self.patterns: list[dict[int, int]] = [{int(n): int(capacity // n)} for n in self.lengths]
        self.inverse = np.diag(1.0 / (capacity // self.lengths))
        self.x = self.inverse @ self.demand
        self.steps = 0  # since the inverse was computed anew
        self.spare = list(spare)
        self.spare_at = np.zeros((len(self.spare), m))
        for j, column in enumerate(self.spare):
            self.spare_at[j, [self.at[n] for n in column]] = list(column.values())

    def duals(self) -> np.ndarray:
        return self.inverse.sum(axis=0)  # each pattern costs 1

    def worthwhile(self) -> list[dict[int, int]]:
        """Up to ``BATCH`` of the spare columns that are worth more than they cost at
        the duals, from the whole range of their worths: those worth most are alike,
        and one of them spoils the others."""
        worth = self.spare_at @ self.duals()
        good = np.flatnonzero(worth > 1 + 1e-7)
        good = good[np.argsort(-worth[good], kind="stable")]
        some = np.unique(np.linspace(0, len(good) - 1, min(len(good), BATCH)).astype(int))
        return [self.spare[j] for j in good[some]]

    def refresh(self) -> None:
        """The inverse and the times from the basic patterns themselves: what many
        steps add up to drifts away from them."""
        basis = np.zeros(self.inverse.shape)
        for i, pattern in enumerate(self.patterns):
            for n, k in pattern.items():
                basis[self.at[n], i] = k
        self.inverse = np.linalg.inv(basis)
        self.x = np.maximum(self.inverse @ self.demand, 0.0)
        self.steps = 0

    def enter(self, columns: list[dict[int, int]]) -> bool:
        """Simplex steps over ``columns`` until none lowers the total; of those that
        do, the one that lowers it most enters first.  Whether the total fell."""
        before = float(self.x.sum())
        tableau = np.zeros((len(self.x), len(columns)))
        for j, pattern in enumerate(columns):
            for n, k in pattern.items():
                tableau[:, j] += k * self.inverse[:, self.at[n]]
        first, entered = tableau.copy(), {}
        open_ = np.ones(len(columns), bool)
        while True:
            saving = np.where(open_, tableau.sum(axis=0) - 1, 0.0)
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(tableau > TINY, self.x[:, None] / tableau, np.inf)
            rows = ratio.argmin(axis=0)
            theta = ratio[rows, np.arange(len(columns))]
            sound = tableau[rows, np.arange(len(columns))] > PIVOT
            gain = np.where((saving > 1e-9) & sound, saving * np.where(np.isfinite(theta), theta, 0.0), -1.0)
            j = int(gain.argmax())
            if gain[j] < 0:
                break
            r, d = int(rows[j]), tableau[:, j].copy()
            self.x = np.maximum(self.x - theta[j] * d, 0.0)
            self.x[r], self.patterns[r], entered[r] = theta[j], columns[j], j
            step = tableau[r] / d[r]
            tableau -= d[:, None] * step
            tableau[r] = step
            open_[j] = False
            self.steps += 1
        if entered:  # the inverse, for all steps at once
            rows, own = list(entered), first[:, list(entered.values())]
            change = own.copy()
            change[rows, np.arange(len(rows))] -= 1.0
            self.inverse -= change @ np.linalg.solve(own[rows], self.inverse[rows])
        if self.steps >= FRESH:
            self.refresh()
        return float(self.x.sum()) < before


def relaxed(counts: dict[int, int], capacity: int, gap: float = 1e-4) -> tuple[list[dict[int, int]], np.ndarray, float]:
    """Patterns, their fractional times and a lower bound of the number of patterns.

    Ends when the times' sum is within ``gap`` of the bound or a quarter of a
    pattern, or when no pattern is worth more than it costs (then the sum is the
    least there is).  Demands are raised by up to a millionth, each by another
    share, so that no step is without progress and the steps end."""
    lengths = sorted(n for n, c in counts.items() if c > 0)
    shares = np.random.default_rng(0).random(len(lengths))
    raised = {n: counts[n] * (1 + 1e-6 * float(s)) for n, s in zip(lengths, shares)}
    center = np.array(lengths) / capacity  # duals of the bound by total length
    bound = sum(n * c for n, c in raised.items()) / capacity
    ways = cuts(raised, capacity, whole=False)
    if sum(times for _, times in ways[0]) - bound <= max(gap * bound, 0.25):
        return [dict(pattern) for pattern, _ in ways[0]], np.array([times for _, times in ways[0]]), bound
    master = Master(raised, capacity, [dict(pattern) for way in ways for pattern, _ in way])
    demand, stalled = master.demand, math.inf
    while True:
        while float(master.x.sum()) - bound > max(gap * bound, 0.25) and (found := master.worthwhile()):
            if not master.enter(found):
                break
        duals, better = master.duals(), False
        for smooth in (SMOOTH, 0.0):
            prices = smooth * center + (1 - smooth) * np.maximum(duals, 0.0)
            best, choice = price(prices, master.lengths, capacity)
            worth = max(float(best[capacity]), 1.0)
            if float(prices @ demand) / worth > bound:
                bound, center = float(prices @ demand) / worth, prices / worth
            if float(master.x.sum()) - bound <= max(gap * bound, 0.25):
                if master.steps:  # stands only if it holds for the patterns themselves
                    master.refresh()
                    better = True
                    break
                return master.patterns, master.x, bound
            # The best pattern with each length, those worth most first.
            found: list[dict[int, int]] = []
            seen: set[tuple[tuple[int, int], ...]] = set()
            for i in np.argsort(-(prices + best[capacity - master.lengths]), kind="stable"):
                n = int(master.lengths[i])
                pattern = taken(choice, capacity - n)
                pattern[n] = pattern.get(n, 0) + 1
                key = tuple(sorted(pattern.items()))
                if key not in seen and sum(k * duals[master.at[q]] for q, k in key) > 1 + 1e-8:
                    seen.add(key)
                    found.append(pattern)
                    if len(found) == BATCH:
                        break
            better = bool(found) and master.enter(found)
            if better:
                break
        total = float(master.x.sum())
        if not better and master.steps and total < stalled - 1e-7 * total:  # once more without drift
            stalled = total
            master.refresh()
        elif not better:
            return master.patterns, master.x, bound


def solve(counts: dict[int, int], capacity: int, gap: float = 1e-4) -> list[tuple[Pattern, int]]:
    """(pattern, times) that hold every counted item exactly once.  Items as long as
    the capacity are patterns of their own."""
    left = {int(n): int(c) for n, c in counts.items() if c > 0}
    full = left.pop(capacity, 0)
    out: list[tuple[Pattern, int]] = [([(capacity, 1)], full)] if full else []
    if not left:
        return out
    patterns, x, _ = relaxed(left, capacity, gap)
    for i in np.argsort(-x, kind="stable"):
        pattern = patterns[i]
        times = min([math.floor(x[i] + 1e-7), *(left[n] // k for n, k in pattern.items())])
        if times > 0:
            for n, k in pattern.items():
                left[n] -= k * times
            out.append((sorted(pattern.items(), reverse=True), times))
    return out + [(pattern, int(times)) for pattern, times in cuts(left, capacity)[0]]
