"""A cover tree over a block of whole vectors, with cumulative sums, and the assignment of its points to a codebook.

The points of a block are put in the order of a walk through the tree, so every subtree is a range of rows and its
vector sum is the difference of two cumulative sums. A node has a centre (one of its points) and a radius (the
distance of its farthest point). Its children's centres are more than half the radius apart, and each point goes to
the first centre within half the radius; the first child keeps the node's own centre.

Assignment walks down from the root. With ``d1`` the distance from a node's centre to the nearest entry, an entry
farther than ``d1 + 2 * radius`` cannot be nearest to any point of the subtree. Where one entry is left, the whole
subtree goes to it; only ambiguous nodes descend, with the entries left, and the points of a small node are compared
exactly. Bounds are taken with a margin for rounding; every decision between entries is made on exact integers.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

from .vectors import squared, squared_pairs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = 16
_SLACK = 1 + 1e-9
_FAR = np.iinfo(np.int64).max


@dataclass
class CoverTree:
    """``points`` in walk order, ``order`` (row of each in the block), and one entry a node, children adjoining."""

    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray


def _net(points: np.ndarray, rows: np.ndarray, centre: int, cover: float) -> list[tuple[int, np.ndarray]]:
    """``(centre, its rows)``: centres more than ``cover`` apart, each row with the first centre within ``cover``."""
    out, left, limit = [], rows, cover * cover
    while len(left):
        near = squared_pairs(points[left], points[centre][None, :]) <= limit
        near[left == centre] = True
        out.append((centre, left[near]))
        left = left[~near]
        if len(left):
            centre = int(left[0])
    return out


def build(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    n = len(points)
    order = np.empty(n, np.int64)
    start, end, centre, radius, child, children = [], [], [], [], [], []

    def node(at: int, own: int, rows: np.ndarray) -> None:
        start.append(at)
        end.append(at + len(rows))
        centre.append(own)
        far = squared_pairs(points[rows], points[own][None, :]).max() if len(rows) > 1 else 0
        radius.append(float(far) ** 0.5 * _SLACK)
        child.append(0)
        children.append(0)

    members = [np.arange(n)] if n else []
    if n:
        node(0, 0, members[0])
    k = 0
    while k < len(start):
        rows = members[k]
        if len(rows) > leaf and radius[k] > 0:
            child[k], at = len(start), start[k]
            for own, some in _net(points, rows, centre[k], radius[k] / 2):
                node(at, own, some)
                members.append(some)
                at += len(some)
            children[k] = len(start) - child[k]
        else:
            order[start[k] : end[k]] = rows
        members[k] = rows[:0]
        k += 1
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    whole = [np.array(x, np.int64) for x in (start, end, child, children)]
    return CoverTree(
        points[order], order, whole[0], whole[1], place[np.array(centre, np.int64)], np.array(radius), whole[2], whole[3]
    )


def _distances(points: np.ndarray, entries: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Squared distances, of the pairs still open only where these are few."""
    if open_.mean() > 0.2:
        return np.where(open_, squared(points, entries), _FAR)
    out = np.full(open_.shape, _FAR)
    a, b = np.nonzero(open_)
    out[a, b] = squared_pairs(points[a], entries[b])
    return out


def assign(tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(start, end, entry)`` ranges over the walk order, each with its nearest entry (ties to the lower index), and
    how many points were settled as part of a whole subtree of several."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    in_bulk = 0
    at = np.zeros(min(len(tree.start), 1), np.int64)
    open_ = np.ones((len(at), len(entries)), bool)
    while len(at):
        d = _distances(tree.points[tree.centre[at]], entries, open_)
        nearest = d.argmin(1)
        best = d[np.arange(len(at)), nearest]
        r = tree.radius[at]
        reach = (np.sqrt(best.astype(np.float64)) + 2 * r) * _SLACK
        open_ &= np.sqrt(d.astype(np.float64)) <= reach[:, None]
        done = (open_.sum(1) == 1) | (r == 0)
        found.append((tree.start[at[done]], tree.end[at[done]], nearest[done]))
        size = tree.end[at[done]] - tree.start[at[done]]
        in_bulk += int(size[size > 1].sum())
        at, open_ = at[~done], open_[~done]
        small = tree.children[at] == 0
        if small.any():
            rows, owner = _expand(tree.start[at[small]], tree.end[at[small]])
            e = _distances(tree.points[rows], entries, open_[small][owner]).argmin(1)
            found.append((rows, rows + 1, e))
        at, open_ = at[~small], open_[~small]
        kids, owner = _expand(tree.child[at], tree.child[at] + tree.children[at])
        at, open_ = kids, open_[owner]
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, 0
    a, b, e = (np.concatenate(x) for x in zip(*found, strict=True))
    return a, b, e, in_bulk


def _expand(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    size = end - start
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + start[owner], owner


def sums(tree: CoverTree, ranges: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: number of points and their vector sum, from differences of the cumulative sums."""
    a, b, e = ranges
    running = np.zeros((len(tree.points) + 1, tree.points.shape[1]), np.int64)
    np.cumsum(tree.points, axis=0, out=running[1:])
    count, total = np.zeros(k, np.int64), np.zeros((k, tree.points.shape[1]), np.int64)
    np.add.at(count, e, b - a)
    np.add.at(total, e, running[b] - running[a])
    return count, total


def spread(tree: CoverTree, ranges: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The entry of every row of the block, in the block's own order."""
    a, b, e = ranges
    rows, owner = _expand(a, b)
    out = np.empty(len(tree.points), np.int64)
    out[tree.order[rows]] = e[owner]
    return out
