"""Cutting stock by column generation: patterns of piece lengths that fill sequences.

The input is a histogram of lengths below the sequence length, so its size is bounded whatever the
corpus.  Lengths are rounded up to units; a linear program spreads the documents of every rounded
length over patterns.  A pattern that fills its sequence is free of cuts, a pattern with a gap is
filled up with tokens of documents that are cut for it.  Columns are priced by a knapsack over exact
sums.  Whole uses of patterns are then split into runs of equal true lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CUT_COST = 0.01        # of a document given to the gaps, against 1 for a gap
TOLERANCE = 1e-4       # cost a sequence at which a program ends
MAX_PIVOTS = 4000      # a program ended earlier is a worse plan, not a wrong one
ROUNDS = 3             # programs, each over what rounding left
MIN_GAP = 32           # smaller gaps are padded, larger ones filled with pieces of documents
CELLS = 1 << 17        # rounded lengths x units a program may have


def powers(size: int) -> list[int]:
    """The lengths a sequence may have without padding: powers of two below ``size``, and ``size``."""
    return sorted({1 << i for i in range(size.bit_length()) if 1 << i < size} | {size})


class Knapsack:
    """Most valuable multisets of lengths for every exact sum up to ``size``."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.lengths, self.size = lengths, size  # lengths ascend
        self.fits = np.searchsorted(lengths, np.arange(size + 1), side="right")

    def solve(self, values: np.ndarray):
        best = np.full(self.size + 1, -np.inf)
        best[0] = 0.0
        last = np.full(self.size + 1, -1)
        for s in range(1, self.size + 1):
            j = self.fits[s]
            if j:
                total = best[s - self.lengths[:j]] + values[:j]
                i = int(total.argmax())
                best[s], last[s] = total[i], i
        return best, last

    def items(self, last: np.ndarray, s: int) -> dict[int, int]:
        """Length index -> number of the multiset behind ``best[s]``."""
        found: dict[int, int] = {}
        while s > 0:
            i = int(last[s])
            found[i] = found.get(i, 0) + 1
            s -= int(self.lengths[i])
        return found


def linear_program(lengths: np.ndarray, counts: np.ndarray, size: int):
    """[(items, gap, uses)] of a basic solution, uses being fractions.

    Rows: every length's documents are in patterns or given to the gaps; tokens given fill the gaps.
    Revised simplex from the solution that gives all documents to the gaps of empty patterns.
    """
    m = len(lengths)
    knapsack = Knapsack(lengths, size)
    inverse = np.eye(m + 1)
    inverse[m, :m] = lengths / size
    inverse[m, m] = -1.0 / size
    tokens = float((lengths * counts).sum())
    held = np.append(counts.astype(float), tokens / size)
    columns: list = [("given", i) for i in range(m)] + [({}, size)]
    costs = np.append(np.full(m, CUT_COST), 1.0)
    duals = costs @ inverse
    gaps = size - np.arange(size + 1)
    for _ in range(MAX_PIVOTS):
        if costs @ held <= TOLERANCE * tokens / size:
            break
        values, gap_price = duals[:m], duals[m]
        best, last = knapsack.solve(values - 1e-9)  # of equal ones, those of fewer pieces
        reduced = (gaps > 0) - best + gap_price * gaps
        given = CUT_COST - values - gap_price * lengths
        s, i = int(reduced.argmin()), int(given.argmin())
        if min(reduced[s], given[i]) > -1e-6:
            break
        column = np.zeros(m + 1)
        if given[i] < reduced[s]:
            entering, cost = ("given", i), CUT_COST
            column[i], column[m] = 1, lengths[i]
        else:
            items = knapsack.items(last, s)
            entering, cost = (items, size - s), float(s < size)
            for i, n in items.items():
                column[i] = n
            column[m] = -(size - s)
        used = np.flatnonzero(column)
        step = inverse[:, used] @ column[used]
        up = np.flatnonzero(step > 1e-9)
        if not len(up):
            break
        ratio = held[up] / step[up]
        ties = up[ratio <= ratio.min() + 1e-12]
        r = int(ties[step[ties].argmax()])
        theta = held[r] / step[r]
        held -= theta * step
        held[r] = theta
        np.maximum(held, 0, out=held)
        duals = duals + (cost - duals @ column) / step[r] * inverse[r]
        inverse[r] /= step[r]
        others = np.flatnonzero(np.abs(step) > 1e-12)
        others = others[others != r]
        inverse[others] -= np.outer(step[others], inverse[r])
        columns[r], costs[r] = entering, cost
    return [(c[0], c[1], float(x)) for c, x in zip(columns, held) if c[0] != "given" and x > 1e-9 and c[0]]


def whole_patterns(lengths: np.ndarray, counts: np.ndarray, size: int):
    """[(items, uses)] with whole uses that never need more documents than there are.

    Every program's uses are rounded down, then up where documents are left; the next program runs on
    the rest.  Patterns with a gap come last, as long as what is left can fill them.
    """
    left = counts.astype(np.int64).copy()
    found: dict[tuple, int] = {}

    def use(items: dict[int, int], gap: int, times: int) -> int:
        times = min([times] + [int(left[i]) // n for i, n in items.items()])
        if gap:
            times = min(times, int((left * lengths).sum()) // size)
        if times > 0:
            for i, n in items.items():
                left[i] -= n * times
            key = tuple(sorted(items.items()))
            found[key] = found.get(key, 0) + times
        return max(times, 0)

    for last in range(ROUNDS, 0, -1):
        rows = np.flatnonzero(left)
        if not len(rows):
            break
        patterns = [({int(rows[i]): n for i, n in items.items()}, gap, x)
                    for items, gap, x in linear_program(lengths[rows], left[rows], size)]
        full = [p for p in patterns if not p[1]]
        done = sum(use(items, gap, int(x + 1e-6)) for items, gap, x in full)
        done += sum(use(items, gap, 1) for items, gap, x in sorted(full, key=lambda p: -(p[2] % 1)))
        if not done or last == 1:
            for items, gap, x in patterns:
                use(items, gap, int(np.ceil(x - 1e-6)))
            break
    return list(found.items())


def unit_of(lengths: np.ndarray, size: int) -> int:
    """The smallest power of two by which rounded lengths keep a program within ``CELLS``."""
    unit = 1
    while len(np.unique(-(-lengths // unit))) * (size // unit) > CELLS and size % (2 * unit) == 0:
        unit *= 2
    return unit


def exact_runs(histogram: dict[int, int], size: int):
    """[(true lengths of the pieces, times)]: sequences of equal content, documents staying whole.

    The documents of a rounded length are ranked by their true length and dealt to the slots of the
    patterns in that order, so that each slot meets few true lengths.
    """
    lengths = np.array(sorted(histogram, reverse=True), np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], np.int64)
    unit = unit_of(lengths, size)
    rounded = -(-lengths // unit)
    bins = np.unique(rounded)
    total = np.array([counts[rounded == b].sum() for b in bins])
    own = [(lengths[rounded == b], np.cumsum(counts[rounded == b])) for b in bins]
    taken = [0] * len(bins)
    runs = []
    for items, times in whole_patterns(bins, total, size // unit):
        slots = [i for i, n in sorted(items, reverse=True) for _ in range(n)]
        first, edges = [], {0, times}
        for i in slots:
            first.append(taken[i])
            ends = own[i][1] - taken[i]
            edges.update(ends[(ends > 0) & (ends < times)].tolist())
            taken[i] += times
        marks = sorted(edges)
        for a, b in zip(marks, marks[1:]):
            runs.append(([int(own[i][0][np.searchsorted(own[i][1], f + a, side="right")])
                          for i, f in zip(slots, first)], b - a))
    return runs


@dataclass
class PackPlan:
    """Where each document's remainder goes, by its length and its rank among those of the length.

    Documents of rank below ``placed`` stay whole; ``entry_*`` are the patterns that use a length, by
    length.  The others' tokens are laid on a line; ``line_*`` are runs of equal gaps on that line.
    """
    size: int
    sequences: int
    placed: np.ndarray        # by length
    place_base: np.ndarray    # by length: number of placed documents of smaller lengths
    entry_from: np.ndarray    # first placed document, over all lengths
    entry_each: np.ndarray    # documents of the length in one sequence
    entry_sequence: np.ndarray
    entry_offset: np.ndarray
    cut_base: np.ndarray      # by length: place on the line of the first document cut
    line_from: np.ndarray
    line_gap: np.ndarray
    line_sequence: np.ndarray
    line_offset: np.ndarray


def plan(histogram: dict[int, int], size: int) -> PackPlan:
    """The plan for ``histogram`` (length -> documents, lengths from 1 to size - 1).

    Gaps of ``MIN_GAP`` tokens or more are filled; where the documents left over are too few for that,
    the sequences with the largest gaps are given up.  What is left then fills whole sequences, and
    the last tokens sequences of powers of two, which need no padding.
    """
    runs = sorted(exact_runs(histogram, size), key=lambda r: -sum(r[0])) if histogram else []
    spare = sum(n * x for x, n in histogram.items()) - sum(sum(items) * times for items, times in runs)
    wanted = sum((size - sum(items)) * times for items, times in runs if size - sum(items) >= MIN_GAP)
    while runs and wanted > spare:
        items, times = runs.pop()
        gap = size - sum(items)
        given = min(times, -(-(wanted - spare) // size))
        spare += given * sum(items)
        wanted -= given * gap
        if given < times:
            runs.append((items, times - given))
    placed, base = np.zeros(size + 1, np.int64), 0
    entries, gaps = [], []
    for items, times in runs:
        offset = 0
        for x in sorted(set(items), reverse=True):
            n = items.count(x)
            entries.append((x, n * times, n, base, offset))
            placed[x] += n * times
            offset += n * x
        if size - offset >= MIN_GAP:
            gaps.append((size - offset, times, base, offset))
        base += times
    number = np.zeros(size + 1, np.int64)
    for x, n in histogram.items():
        number[x] = n
    cut = (number - placed) * np.arange(size + 1)
    rest = int(cut.sum()) - sum(g * t for g, t, _, _ in gaps)
    for width in sorted(powers(size), reverse=True):
        times = rest // width
        if times:
            gaps.append((width, times, base, 0))
            base += times
            rest -= width * times
    entries.sort(key=lambda e: e[0])
    entry_n = np.array([e[1] for e in entries], np.int64)
    line_n = np.array([g * t for g, t, _, _ in gaps], np.int64)

    def column(rows, i):
        return np.array([r[i] for r in rows], np.int64)

    return PackPlan(size, base, placed, np.cumsum(placed) - placed, np.cumsum(entry_n) - entry_n, column(entries, 2),
                    column(entries, 3), column(entries, 4), np.cumsum(cut) - cut, np.cumsum(line_n) - line_n,
                    column(gaps, 0), column(gaps, 2), column(gaps, 3))
