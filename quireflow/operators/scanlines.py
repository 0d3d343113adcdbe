"""Polygons drawn row by row with numpy, many at once: the work inside a task of ``raster``.

A drawn table has a line per run of pixels: its polygon (owner), a row number (row) in which a polygon's rows follow one another and two polygons have
a gap, and y, x0, x1. Whole numbers throughout. Memory is bounded by ``SIDE_ROWS``, sides times rows, beside the runs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Sides times rows that are looked at together at most; of one polygon with more, a band of rows after the other.
SIDE_ROWS = 1 << 18
#: Coordinates up to this have products that fit a long; polygons beyond are counted in Python's whole numbers.
WIDE = (1 << 30) - 1


def _ceil_div(a, b):
    return -(-a // b)


def sides_of(polygons: pa.Array) -> tuple[np.ndarray, ...]:
    """(owner, ax, ay, bx, by): the sides of closed polygons (lists of x, y); those with a null end are left out."""
    sizes = np.asarray(polygons.value_lengths().fill_null(0))
    points = polygons.flatten()
    x, y = (points.field(c) for c in ("x", "y"))
    known = ~np.asarray(points.is_null()) & ~np.asarray(x.is_null()) & ~np.asarray(y.is_null())
    x, y = (np.asarray(v.fill_null(0)).astype(np.int64) for v in (x, y))
    owner, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    after = np.arange(1, len(x) + 1)
    after[ends[sizes > 0] - 1] = (ends - sizes)[sizes > 0]
    both = known & known[after] if len(x) else known
    return tuple(v[both] for v in (owner, x, y, x[after] if len(x) else x, y[after] if len(x) else y))


def _chunks(n_sides: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int, int | None, int | None]]:
    """(first polygon, end, first row, last row) of what is drawn together; rows are null where polygons are whole."""
    cost = n_sides * np.maximum(high - low + 1, 0)
    first, held = 0, 0
    for i, c in enumerate(cost.tolist()):
        if held and held + c > SIDE_ROWS:
            yield first, i, None, None
            first, held = i, 0
        if c > SIDE_ROWS:
            band = max(SIDE_ROWS // int(n_sides[i]), 1)
            for y in range(int(low[i]), int(high[i]) + 1, band):
                yield i, i + 1, y, min(y + band - 1, int(high[i]))
            first = i + 1
        else:
            held += c
    if held:
        yield first, len(cost), None, None


def joined(row: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in order, those of a row that overlap or touch made one."""
    if not len(row):
        return row, x0, x1
    step = int(x1.max()) + 2
    start, end = row * step + x0, row * step + x1
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    s, e = start[new], end[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(end) - 1]))]
    return s // step, s % step, e - s // step * step


def _runs(sides: tuple[np.ndarray, ...], first: np.ndarray, last: np.ndarray, base: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, x0, x1) of sides (owner, ax, ay, bx, by): inside by the even-odd rule, or on the outline.

    first, last: each owner's rows; base: what is added to y for its row number. A side has its upper end and not its lower one, so a row
    through a corner meets each side as the even-odd rule needs. On the outline a side is walked along its longer direction and rounded in the other.
    """
    owner, ax, ay, bx, by = sides
    up = ay <= by
    tx, ty, ux, uy = np.where(up, ax, bx), np.where(up, ay, by), np.where(up, bx, ax), np.where(up, by, ay)
    top, bottom = np.maximum(ty, first[owner]), np.minimum(uy, last[owner])
    n_rows = np.maximum(bottom - top + 1, 0)
    at = np.repeat(np.arange(len(owner)), n_rows)
    y = np.arange(len(at)) - np.repeat(np.cumsum(n_rows) - n_rows, n_rows) + top[at]
    owner, tx, ty, ux, uy = (v[at] for v in (owner, tx, ty, ux, uy))
    row, wide_of = y + base[owner], width[owner]
    if len(at) and max(abs(tx).max(), abs(ux).max(), abs(ty).max(), abs(uy).max()) > WIDE:
        tx, ty, ux, uy, y = (v.astype(object) for v in (tx, ty, ux, uy, y))
    whole = lambda v: np.clip(v, -1, wide_of + 1).astype(np.int64)
    k, high, wide = y - ty, uy - ty, ux - tx
    moved, down = k * wide, np.maximum(high, 1)
    floor = moved // down
    rest = moved - floor * down
    crosses = np.flatnonzero(k < high)
    c_row, c_floor, c_part = row[crosses], (tx + floor)[crosses], (rest / down)[crosses].astype(float)
    c_left, c_right = whole(tx + floor + (rest > 0))[crosses], whole(tx + floor + 1)[crosses]
    order = np.lexsort((c_left, c_part, np.clip(c_floor, -(1 << 62), 1 << 62).astype(np.int64), c_row))
    c_row, c_left, c_right = c_row[order], c_left[order], c_right[order]
    begins = np.concatenate(([True], c_row[1:] != c_row[:-1])) if len(c_row) else np.zeros(0, bool)
    place = np.arange(len(c_row)) - np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(c_row) else c_row
    pair = np.flatnonzero((place[:-1] % 2 == 0) & (c_row[1:] == c_row[:-1])) if len(c_row) else np.zeros(0, np.int64)
    # longer down than across: one pixel a row
    n = abs(wide)
    steep = high >= n
    one = tx + (2 * moved + down) // (2 * down)
    # else those whose rounded row this is, counted from the side's left end, which is its upper or its lower one
    flat, j = high == 0, high - k
    from_upper = tx <= ux
    a = np.where(from_upper, np.maximum(_ceil_div(2 * n * k - n, 2 * down), 0), np.maximum((2 * n * j - n) // (2 * down) + 1, 0))
    b = np.where(from_upper, np.minimum(_ceil_div(2 * n * (k + 1) - n, 2 * down) - 1, n), np.minimum((2 * n * j + n) // (2 * down), n))
    left = np.minimum(tx, ux)
    x0 = whole(np.where(steep, one, left + np.where(flat, 0, a)))
    x1 = whole(np.where(steep, one, left + np.where(flat, n, b)) + 1)
    row, x0, x1 = np.concatenate((row, c_row[pair])), np.concatenate((x0, c_left[pair])), np.concatenate((x1, c_right[pair + 1]))
    limit = np.concatenate((wide_of, wide_of[crosses][order][pair]))
    x0, x1 = np.maximum(x0, 0), np.minimum(x1, limit)
    some = x0 < x1
    return joined(row[some], x0[some], x1[some])


def drawn(polygons: pa.Array, width: pa.Array, height: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """(owner, row, y, x0, x1) of the polygons' runs, in order, some at a time; a polygon of many sides and rows may come in parts, rows in order."""
    sides = sides_of(polygons)
    owner, n = sides[0], len(polygons)
    width, height = (np.asarray(v.fill_null(0)).astype(np.int64) for v in (width, height))
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    for ends in (sides[2], sides[4]):
        np.minimum.at(low, owner, ends)
        np.maximum.at(high, owner, ends)
    n_sides = np.bincount(owner, minlength=n)
    low, high = np.where(n_sides > 0, np.maximum(low, 0), 0), np.where(n_sides > 0, np.minimum(high, height - 1), -1)
    # a row between any two polygons stays free
    rows = np.maximum(high - low + 1, 0) + 1
    base = np.cumsum(rows) - rows - low
    starts = np.concatenate(([0], np.cumsum(n_sides)))
    for i, end, top, bottom in _chunks(n_sides, low, high):
        own = tuple(v[starts[i] : starts[end]] for v in sides)
        row, x0, x1 = _runs(own, low if top is None else np.full(n, top), high if bottom is None else np.full(n, bottom), base, width)
        of = np.searchsorted(base + low, row, side="right") - 1
        yield of, row, row - base[of], x0, x1


def all_drawn(polygons: pa.Array, width: pa.Array, height: pa.Array) -> tuple[np.ndarray, ...]:
    parts = list(drawn(polygons, width, height))
    return tuple(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(5))


def areas(owner: np.ndarray, x0: np.ndarray, x1: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, np.int64)
    np.add.at(total, owner, x1 - x0)
    return total


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches by links u, v."""
    label = np.arange(n)
    while len(u):
        np.minimum.at(label, label[u], label[v])
        np.minimum.at(label, label[v], label[u])
        while not np.array_equal(label, label[label]):
            label = label[label]
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    return label


def hole_sizes(owner: np.ndarray, row: np.ndarray, x0: np.ndarray, x1: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(holes, their pixels) of each of n masks of merged runs in order; a hole is background that no path of four neighbours joins with the border.

    Gaps between the runs of a row are linked with those of the next row that they touch. A gap is open if it touches a row without
    runs, or what lies beside a row's runs; so is a component with an open gap.
    """
    between = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    if not len(between):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    g_owner, g_row, a, b = owner[between], row[between], x1[between], x0[between + 1]
    begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    line, least, most = row[begin], x0[begin], x1[np.concatenate((begin[1:] - 1, [len(row) - 1]))]
    out = np.zeros(len(a), bool)
    for other in (g_row - 1, g_row + 1):
        at = np.minimum(np.searchsorted(line, other), len(line) - 1)
        out |= (line[at] != other) | (a < least[at]) | (b > most[at])
    step = int(x1.max()) + 2
    start, end = g_row * step + a, g_row * step + b
    lo, hi = np.searchsorted(end, start + step, side="right"), np.searchsorted(start, end + step, side="left")
    many = np.maximum(hi - lo, 0)
    u = np.repeat(np.arange(len(a)), many)
    v = np.arange(len(u)) - np.repeat(np.cumsum(many) - many, many) + lo[u]
    label = roots(len(a), u, v)
    is_open = np.zeros(len(a), bool)
    np.logical_or.at(is_open, label, out)
    shut = ~is_open[label]
    first = shut & (label == np.arange(len(a)))
    return np.bincount(g_owner[first], minlength=n), areas(g_owner[shut], a[shut], b[shut], n)
