"""Sums of distances to all of very many points, by trees of boxes over them; for up to three coordinates.

Seen from far enough, the points of a box can be replaced by a fixed grid of points with weights, and what is asked of many points of a
box can be asked of such a grid and interpolated: the distance is smooth there, and Chebyshev interpolation converges with the power of
the grid's size. Every point counts. With the gaps and grids below, a distance between two points of boxes that only just lie apart is off by
less than 1e-7 of itself (1e-5 for three coordinates), sums of them by a hundredth of that; on one coordinate such sums are exact. Between
boxes that are near each other, distances are taken point by point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

GRID = {1: 2, 2: 10, 3: 7}  # points of a grid on each axis, by the number of coordinates
GAP = {1: 1e-9, 2: 2.0, 3: 2.0}  # boxes are far from each other if the gap between them is this many times the larger half side
LEAF = {1: 512, 2: 256, 3: 512}  # points of a leaf: with fewer, grids cost more than points
_COARSER = 4  # few points are only cut up further for boxes smaller than theirs by this
_CELLS = 1 << 16  # distances that are taken at once: they stay in a core's cache


@dataclass(frozen=True)
class Forest:
    """A tree of boxes for each code. Nodes have two children or are a leaf; ``grid`` has the weights of the points that stand for them."""

    low: np.ndarray
    high: np.ndarray
    half: np.ndarray
    grid: np.ndarray
    first: np.ndarray  # a child, or -1 in a leaf; the other child comes next
    code: np.ndarray
    leaf: np.ndarray  # the number of the leaf, or -1
    roots: dict[int, int]


def order(z: np.ndarray, bits: int) -> np.ndarray:
    """Places along a curve that keeps neighbours together, of points with coordinates between 0 and 1."""
    cells = np.clip(z * 2.0**bits, 0, 2**bits - 1).astype(np.int64)
    key, width = np.zeros(len(z), np.int64), z.shape[1]
    for bit in range(bits):
        for j in range(width):
            key |= (cells[:, j] >> bit & 1) << (bit * width + j)
    return key


def leaves(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points in which leaves of at most ``most`` neighbours follow each other, and where these begin."""
    found, open_ = [], [np.arange(len(x))]
    while open_:
        rows = open_.pop()
        if len(rows) <= most:
            found.append(rows)
        else:
            open_ += _halves(x, rows)[::-1]
    return np.concatenate(found), np.cumsum([0, *map(len, found[:-1])])


def _halves(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    part = x[rows]
    side = part[:, np.argmax(part.max(axis=0) - part.min(axis=0))]
    sorted_ = rows[np.argsort(side, kind="stable")]  # the same halves on every machine
    return [sorted_[: len(rows) // 2], sorted_[len(rows) // 2 :]]


def grid_weights(x: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The weights of the grid points of a box that stand for weighted points in it."""
    return weight @ _interpolation(x, low, high)


def forest(code: np.ndarray, low: np.ndarray, high: np.ndarray, grid: np.ndarray) -> Forest:
    """Trees over leaves, given by code, box and weights; each node is halved across its longest side."""
    at = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(code[at]) != 0])
    stops, ids, made = np.r_[starts[1:], len(at)], np.arange(len(starts)), len(starts)
    roots = dict(zip(code[at[starts]].tolist(), ids.tolist()))
    total, width, middles = 2 * len(at) - len(starts), low.shape[1], low + high
    f = Forest(*(np.empty((total, width)) for _ in "lh"), np.empty(total), np.zeros((total, grid.shape[1])), np.full(total, -1), np.empty(total, np.int64), np.full(total, -1), roots)
    inner = []
    while len(ids):
        rows = np.concatenate([np.arange(a, b) for a, b in zip(starts, stops)])
        begins, lengths = np.cumsum(stops - starts) - (stops - starts), stops - starts
        f.low[ids], f.high[ids] = np.minimum.reduceat(low[at[rows]], begins), np.maximum.reduceat(high[at[rows]], begins)
        f.code[ids] = code[at[starts]]
        single = lengths == 1
        f.leaf[ids[single]], f.grid[ids[single]] = at[starts[single]], grid[at[starts[single]]]
        node = np.repeat(np.arange(len(ids)), lengths)
        axis = np.argmax(f.high[ids] - f.low[ids], axis=1)[node]
        at[rows] = at[rows][np.lexsort((middles[at[rows], axis], node))]
        starts, stops, ids = starts[~single], stops[~single], ids[~single]
        f.first[ids] = made + 2 * np.arange(len(ids))
        inner += [ids] if len(ids) else []
        halves = (starts + stops) // 2
        starts, stops = np.c_[starts, halves].ravel(), np.c_[halves, stops].ravel()
        ids = made + np.arange(2 * len(ids))
        made += len(ids)
    f.half[:] = (f.high - f.low).max(axis=1) / 2
    for ids in reversed(inner):
        for child in (f.first[ids], f.first[ids] + 1):
            f.grid[ids] += _handed_up(f, child, ids)
    return f


def _handed_up(f: Forest, child: np.ndarray, parent: np.ndarray) -> np.ndarray:
    width = f.low.shape[1]
    size, room = GRID[width], np.where(f.high[parent] > f.low[parent], f.high[parent] - f.low[parent], 1)
    weights = f.grid[child].reshape(len(child), *[size] * width)
    for j in range(width):
        places = (f.low[child, j] + f.high[child, j])[:, None] / 2 + (f.high[child, j] - f.low[child, j])[:, None] / 2 * _nodes(size)
        z = (2 * places - (f.low[parent, j] + f.high[parent, j])[:, None]) / room[:, j, None]
        weights = np.einsum("ni...,nij->n...j", weights, _basis(z.ravel(), size).reshape(len(child), size, size))
    return weights.reshape(len(child), f.grid.shape[1])


def walk(f: Forest, x: np.ndarray, nodes: np.ndarray, few: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of ``x`` with the nodes far from them and the leaves near them: each row meets every point below ``nodes`` once.

    Where boxes are too near, the larger one is cut: a node into its children, rows into halves. Only leaves that are no smaller than the box of
    the rows, or not by much if these are ``few``, are met point by point.
    """
    gap, open_ = GAP[x.shape[1]], [(np.arange(len(x)), nodes)]
    while open_:
        rows, pending = open_.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        half = (high - low).max() / 2
        least = half / (_COARSER if len(rows) <= few else 1)
        far, near, held = [], [], []
        while len(pending):
            apart = np.sqrt((np.maximum(0, np.maximum(f.low[pending] - high, low - f.high[pending])) ** 2).sum(axis=1))
            size = np.maximum(f.half[pending], half)
            enough = (apart >= gap * size) & ((apart > 0) | (size == 0))
            far.append(pending[enough])
            pending = pending[~enough]
            smaller = f.half[pending] < least
            held.append(pending[smaller])
            pending = pending[~smaller]
            leaf = f.first[pending] < 0
            near.append(pending[leaf])
            children = f.first[pending[~leaf]]
            pending = np.concatenate([children, children + 1])
        yield rows, np.concatenate(far), np.concatenate(near)
        if any(map(len, held)):
            open_ += [(part, np.concatenate(held)) for part in _halves(x, rows)]


def distances_to(f: Forest, x: np.ndarray, nodes: np.ndarray, few: int, points_of) -> dict[int, np.ndarray]:
    """For each code below ``nodes`` the distances from the rows of ``x`` to its points added up; ``points_of`` gives a leaf's points and their weights."""
    totals = {int(code): np.zeros(len(x)) for code in f.code[nodes]}
    for rows, far, near in walk(f, x, nodes, few):
        part = x[rows]
        for code in np.unique(f.code[near]):
            points, weights = zip(*map(points_of, f.leaf[near[f.code[near] == code]]))
            totals[int(code)][rows] += _weighted(part, np.concatenate(points), np.concatenate(weights))
        if not len(far):
            continue
        low, high = part.min(axis=0), part.max(axis=0)
        by_grid = len(rows) > f.grid.shape[1]
        asked, shares = (_grid(low[None], high[None])[0], _interpolation(part, low, high)) if by_grid else (part, None)
        for code in np.unique(f.code[far]):
            these = far[f.code[far] == code]
            found = _weighted(asked, _grid(f.low[these], f.high[these]).reshape(-1, x.shape[1]), f.grid[these].ravel())
            totals[int(code)][rows] += shares @ found if by_grid else found
    return totals


def _weighted(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weighted sum of the distances from each row of ``a`` to all of ``b``."""
    totals, columns = np.zeros(len(a)), np.ascontiguousarray(b.T)
    across = min(len(b), _CELLS // 16)
    stripe = max(1, _CELLS // max(1, across))
    room = np.empty((2, stripe * across))
    for start in range(0, len(b), max(1, across)):
        some, share = columns[:, start : start + across], weight[start : start + across]
        for at in range(0, len(a), stripe):
            part = a[at : at + stripe]
            squares, more = (r[: len(part) * len(share)].reshape(len(part), -1) for r in room)
            np.square(np.subtract(part[:, :1], some[0], out=squares), out=squares)
            for j in range(1, a.shape[1]):
                squares += np.square(np.subtract(part[:, j, None], some[j], out=more), out=more)
            totals[at : at + stripe] += np.sqrt(squares, out=squares) @ share
    return totals


def _nodes(size: int) -> np.ndarray:
    return np.cos(np.pi * (np.arange(size) + 0.5) / size)


def _basis(z: np.ndarray, size: int) -> np.ndarray:
    """The polynomials that are 1 at one Chebyshev point and 0 at the others, at places between -1 and 1."""
    degrees = np.arange(size)
    here, there = (np.cos(degrees * np.arccos(np.clip(p, -1, 1))[:, None]) for p in (z, _nodes(size)))
    return (2 * here @ there.T - 1) / size


def _interpolation(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The share of each point of a box's grid in the value at each row of ``x``."""
    room, shares = np.where(high > low, high - low, 1), np.ones((len(x), 1))
    for j in range(x.shape[1]):
        axis = _basis((2 * x[:, j] - low[j] - high[j]) / room[j], GRID[x.shape[1]])
        shares = (shares[:, :, None] * axis[:, None, :]).reshape(len(x), -1)
    return shares


def _grid(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The grid points of boxes: boxes, points, coordinates."""
    width = low.shape[1]
    unit = np.stack(np.meshgrid(*[_nodes(GRID[width])] * width, indexing="ij"), axis=-1).reshape(-1, width)
    return (low + high)[:, None] / 2 + (high - low)[:, None] / 2 * unit
